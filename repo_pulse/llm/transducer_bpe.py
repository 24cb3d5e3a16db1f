"""BPE encoding and decoding with a lexicon of frequent words and exact merges for the rest."""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repo_pulse.llm.arrow_text import binary_array, group_sums, pieces, ranges, texts_of, words_of
from repo_pulse.llm.bpe import Merges, merges
from repo_pulse.llm.frequent import frequent, word_counts
from repo_pulse.llm.lexicon import compile_lexicon, mapped
from repo_pulse.llm.scratch import new_path, plain, written
from repo_pulse.llm.tokenizing import Numbered, assemble

# Words in the lexicon at most: it is compiled on the driver and mapped by every worker.
LEXICON_WORDS = 100_000
# Longer words stay out of it, so its size is bounded too.
LEXICON_BYTES = 40


def _lower(text: str) -> str:
    """Lower case character by character, without the rule for a sigma at a word's end."""
    return "".join(c.lower() for c in text) if "Σ" in text else text.lower()


def encode_units(units: list[bytes], table: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts without ASCII white space, by normalizing, splitting and merging.

    Returns the number of ids of each (0 for a text of wide white space only), and all ids.
    """
    special = [s for s in table.special if any(s.encode() in u for u in units)]
    if special:
        split = [_split_special(u.decode(), table) for u in units]
    else:
        split = [[u.decode()] for u in units]
    flat = [part for parts in split for part in parts]
    text = "\n".join("" if part in table.special else part for part in flat)
    found = table.pattern.findall(_lower(unicodedata.normalize("NFC", text)))
    line = np.fromiter((t == "\n" for t in found), dtype=bool, count=len(found))
    part_of = np.cumsum(line)[~line]
    tokens = [t.encode() for t in found if t != "\n"]
    different = {t: i for i, t in enumerate(dict.fromkeys(tokens))}
    sizes, ids = table.encode_words(list(different))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    which = np.fromiter((different[t] for t in tokens), dtype=np.int64, count=len(tokens))
    out = ids[ranges(ends[which], sizes[which])]
    per_part = np.bincount(part_of, weights=sizes[which], minlength=len(flat)).astype(np.int64)
    if special:
        at = np.cumsum(per_part) - per_part
        marks = [i for i, part in enumerate(flat) if part in table.special]
        out = np.insert(out, at[marks], [table.special[flat[i]] for i in marks])
        per_part[marks] = 1
    bounds = np.concatenate([[0], np.cumsum([len(parts) for parts in split])]).astype(np.int64)
    return group_sums(per_part, bounds), out


def _split_special(text: str, table: Merges) -> list[str]:
    """The text cut around special tokens, which are matched before normalizing."""
    parts, rest = [], text
    while rest:
        places = [(rest.find(s), -len(s), s) for s in table.special if s in rest]
        if not places:
            parts.append(rest)
            break
        at, _, token = min(places)
        parts += [rest[:at], token] if at else [token]
        rest = rest[at + len(token) :]
    return parts or [""]


def build_lexicon(docs: DataFrame, tokenizer: str, size: int = LEXICON_WORDS) -> str:
    """Compile the corpus's most frequent words; returns the file's name for `SparkFiles`.

    Words of all documents are counted. The file is written to the shared folder, and each
    executor fetches it once.
    """
    spark = docs.sparkSession
    texts = plain(docs, "text").select("text")
    counts = written(word_counts(texts), "word-counts")
    counts = counts.filter(F.octet_length("word") <= LEXICON_BYTES)
    words = sorted(bytes(row.word) for row in frequent(counts, size).select("word").collect())
    sizes, ids = encode_units(words, merges(tokenizer)) if words else ([], [])
    return _publish(spark, compile_lexicon(words, np.array(sizes, dtype=np.int64), ids))


def _publish(spark: SparkSession, content: bytes) -> str:
    path = new_path(spark, "lexicon") + ".bin"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = system.create(target)
    stream.write(bytearray(content))
    stream.close()
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1]


def encode_and_decode(docs: DataFrame, tokenizer: str, lexicon: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded, ids_sha256, decoded_sha256) of each row.

    `decoded` comes from the ids alone: their tokens joined by blanks, special tokens included.
    A null text counts as empty: no ids, an empty decoded text. Null and repeated doc_ids and
    repeated texts keep a row each; other columns are ignored; an empty table gives no rows.
    """
    return plain(docs, "doc_id", "text").select("doc_id", "text").mapInArrow(
        lambda batches: _run(batches, tokenizer, lexicon, digests=False),
        "doc_id bigint, n_tokens bigint, ids array<int>, decoded string",
    )


def digests(docs: DataFrame, tokenizer: str, lexicon: str) -> DataFrame:
    """The same rows with SHA-256 of the ids (32-bit little-endian) and of the decoded text."""
    return plain(docs, "doc_id", "text").select("doc_id", "text").mapInArrow(
        lambda batches: _run(batches, tokenizer, lexicon, digests=True),
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )


def _run(
    batches: Iterator[pa.RecordBatch], tokenizer: str, lexicon: str, digests: bool
) -> Iterator[pa.RecordBatch]:
    table, known = merges(tokenizer), mapped(SparkFiles.get(lexicon))
    strings = pa.array(table.strings, pa.string())

    def lookup(units: list[bytes]) -> Numbered:
        raw = binary_array(
            np.frombuffer(b"".join(units), dtype=np.uint8),
            np.concatenate([[0], np.cumsum([len(u) for u in units])]).astype(np.int64),
        )
        data = np.frombuffer(raw.buffers()[2], dtype=np.uint8)
        number = known.numbers(data, np.frombuffer(raw.buffers()[1], dtype=np.int64))
        unseen = np.flatnonzero(number < 0)
        sizes, values = encode_units([units[i] for i in unseen], table)
        number[unseen] = len(known.ends) - 1 + np.arange(len(unseen))
        ends = np.concatenate([known.ends, known.ends[-1] + np.cumsum(sizes)])
        return number, ends, np.concatenate([known.ids, values.astype(np.int32)])

    for batch in pieces(batches):
        words = words_of(texts_of(batch.column(1)))
        if len(words):
            ids, ends = assemble(words.array(), words.of_text, lookup)
        else:
            ids, ends = np.zeros(0, np.int32), np.zeros(batch.num_rows + 1, np.int64)
        tokens = strings.take(pa.array(ids))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tokens)
        decoded = pc.binary_join(lists, " ")
        sizes = pa.array(np.diff(ends))
        if digests:
            raw = memoryview(np.ascontiguousarray(ids, dtype="<i4")).cast("B")
            of_ids = [
                hashlib.sha256(raw[4 * a : 4 * b]).hexdigest()
                for a, b in zip(ends[:-1], ends[1:], strict=True)
            ]
            of_text = [hashlib.sha256(t.as_buffer()).hexdigest() for t in decoded]
            columns = {
                "doc_id": batch.column(0),
                "n_tokens": sizes,
                "ids_sha256": pa.array(of_ids, pa.string()),
                "decoded_sha256": pa.array(of_text, pa.string()),
            }
        else:
            columns = {
                "doc_id": batch.column(0),
                "n_tokens": sizes,
                "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                "decoded": decoded,
            }
        yield pa.RecordBatch.from_pydict(columns)
