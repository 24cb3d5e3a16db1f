"""Personal data: patterns, and terms around them that reveal the same thing.

E-mail and IP addresses, card and phone numbers are found by pattern; each different one is a
protected entity. Any word of a document that holds an entity may disclose it, to the degree of
their pointwise mutual information, PMI(e; t) = log2(N n(e,t) / (n(e) n(t))), all counts being of
documents, against the information of the entity itself, IC(e) = log2(N / n(e)). In documents
that hold the entity, terms from half of IC(e) on are generalised, terms from nine tenths of it on
are removed. Terms must stand in documents with several different contexts of the entity, which
are the words around its mentions: copies of one context count once, so the words of a document that is copied often do not become suspects.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repo_pulse.llm.arrow_text import pieces, texts_of, words_of
from repo_pulse.llm.scratch import plain, written

# The kinds in the order they are listed, and what replaces them in a text.
BASE_KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("generalised", "removed")
MARKS = {
    "email": "[EMAIL]",
    "ip": "[IP]",
    "card": "[CARD]",
    "phone": "[PHONE]",
    "generalised": "[TERM]",
    "removed": "",
}

# The patterns. A match of digits can start at a run's first digit only, which the
# look-behind says to avoid trying the others.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
WINDOW_WORDS = 5
MIN_CONTEXTS = 3
GENERALISE_FROM = 0.5
REMOVE_FROM = 0.9
# Bits of the filter that tells which terms are worth counting; it is broadcast.
FILTER_BITS = 1 << 22
# Terms whose counts a task holds before it passes them on.
HELD_TERMS = 1 << 17

SPAN = "array<struct<kind: string, start: int, end: int>>"
MENTION = "array<struct<entity: bigint, context: bigint>>"


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", at + 1)


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            yield m.span()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        digits = re.sub(r"[^0-9]", "", m[0]) if m.end() - m.start() < 40 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            yield m.span()


FINDERS = dict(zip(BASE_KINDS, (emails, ips, cards, phones), strict=True))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans of the four kinds, by kind and start, in code points."""
    return [(kind, *span) for kind in BASE_KINDS for span in FINDERS[kind](text)]


def spelled(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def words_outside(
    text: str, spans: list[tuple[str, int, int]]
) -> list[tuple[int, int, str]]:
    """Words that no span touches: lower case, without punctuation around them, with places."""
    taken = sorted((start, end) for _, start, end in spans)
    starts = [start for start, _ in taken]
    reach = list(np.maximum.accumulate([end for _, end in taken])) if taken else []
    found = []
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
        i = bisect_left(starts, m.end())
        if i and reach[i - 1] > m.start():
            continue
        word = m[0].lstrip(PUNCTUATION)
        start = m.end() - len(word)
        word = word.rstrip(PUNCTUATION)
        found.append((start, start + len(word), word.lower()))
    return found


def is_term(word: str) -> bool:
    return any(map(str.isalnum, word))


def mentions(text: str, spans: list[tuple[str, int, int]]) -> tuple[list[dict], list[str]]:
    """Each span with its entity and a hash of the words around it; and the terms of the text."""
    words = words_outside(text, spans)
    starts = [start for start, _, _ in words]
    found = []
    for kind, start, end in spans:
        i = bisect_left(starts, start)
        near = [w for _, _, w in words[max(i - WINDOW_WORDS, 0) : i + WINDOW_WORDS]]
        exact = text[start:end].lower()
        value = re.sub(r"[^0-9]", "", exact) if kind in ("card", "phone") else exact
        found.append({"entity": _hash(f"{kind}:{value}"), "context": _hash(" ".join(near))})
    return found, sorted(set(filter(is_term, (w for _, _, w in words)))) if spans else []


def _hash(text: str) -> int:
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42)
    return value - (1 << 64) if value >> 63 else value


def _suspects(column: pa.Array) -> np.ndarray:
    """Whether a text holds a digit or an at sign, without which it has no span."""
    texts = texts_of(column)
    sign = ((texts.data >= 0x30) & (texts.data <= 0x39)) | (texts.data == 0x40)
    places = np.flatnonzero(sign)
    return np.diff(np.searchsorted(places, texts.offsets)) > 0


def detect(docs: DataFrame) -> DataFrame:
    """The rows of docs with `_spans` (base spans), `_mentions` and `_words` (terms of a text with
    spans) beside their own columns."""
    more = f"_spans {SPAN}, _mentions {MENTION}, _words array<string>"
    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(more).fields])
    place = docs.columns.index("text")
    span_type = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    )
    mention_type = pa.list_(pa.struct([("entity", pa.int64()), ("context", pa.int64())]))
    word_type = pa.list_(pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = batch.column(place)
            spans: list[list] = [[] for _ in range(batch.num_rows)]
            around: list[list] = [[] for _ in range(batch.num_rows)]
            terms: list[list] = [[] for _ in range(batch.num_rows)]
            for i in np.flatnonzero(_suspects(texts)):
                text = texts[i].as_py() or ""
                found = base_spans(text)
                spans[i] = [{"kind": k, "start": s, "end": e} for k, s, e in found]
                around[i], terms[i] = mentions(text, found)
            own = [pa.array(spans, span_type), pa.array(around, mention_type)]
            own.append(pa.array(terms, word_type))
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], schema.names)

    return docs.mapInArrow(run, schema)


def document_counts(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, documents) for the given terms: how many of all texts hold each.

    A task counts terms over all texts it reads and gives one row for each, or one for each
    HELD_TERMS of them. A filter of fixed size, made of the terms' hashes, keeps other words out
    of the shuffle; the join at the end is exact.
    """
    bits = F.pmod(F.xxhash64("term"), F.lit(FILTER_BITS))
    places = terms.select(bits.alias("bit")).distinct().toArrow()["bit"].to_numpy()
    wanted = np.zeros(FILTER_BITS, dtype=bool)
    wanted[places] = True
    shared = texts.sparkSession.sparkContext.broadcast(np.packbits(wanted))

    def rows(held: Counter) -> pa.RecordBatch:
        columns = [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["term", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bit = np.unpackbits(shared.value).astype(bool)
        held: Counter = Counter()
        for batch in pieces(batches):
            words = words_of(texts_of(batch.column(0)))
            coded = words.array().dictionary_encode()
            shown = pc.utf8_lower(coded.dictionary.cast(pa.large_string()))
            shown = pc.utf8_trim(shown, characters=PUNCTUATION).dictionary_encode()
            names = shown.dictionary
            hashes = (xxhash.xxh64_intdigest(w.as_buffer(), 42) for w in names)
            hashes = np.fromiter(hashes, dtype=np.uint64, count=len(names))
            kept = bit[hashes.view(np.int64) % FILTER_BITS]
            term = shown.indices.to_numpy()[coded.indices.to_numpy()]
            text = np.repeat(np.arange(batch.num_rows), words.counts())
            hit = kept[term]
            # Each term once for each text.
            pairs = np.unique(text[hit] * max(len(names), 1) + term[hit])
            n = np.bincount(pairs % max(len(names), 1), minlength=len(names))
            some = np.flatnonzero(n)
            terms_here = names.take(pa.array(some)).to_pylist()
            held.update(dict(zip(terms_here, n[some].tolist(), strict=True)))
            if len(held) > HELD_TERMS:
                yield rows(held)
                held = Counter()
        yield rows(held)

    partial = texts.mapInArrow(run, "term string, n bigint")
    counts = partial.groupBy("term").agg(F.sum("n").alias("documents"))
    return terms.select("term").join(counts, "term")


def disclosing(found: DataFrame, texts: DataFrame, rows: int) -> DataFrame:
    """(entity, term, kind): the terms to hide in documents that hold the entity."""
    mentioned = found.filter(F.size("_mentions") > 0)
    each = mentioned.select(F.explode("_mentions").alias("m")).select("m.entity", "m.context")
    # A term has no more contexts than its entity: only entities with enough of them are looked at.
    enough = each.distinct().groupBy("entity").count().filter(F.col("count") >= MIN_CONTEXTS)
    enough = written(enough.select("entity"), "entities")
    rowwise = mentioned.select(F.explode("_mentions").alias("m"), "_words")
    rowwise = rowwise.select("m.entity", "m.context", "_words").join(enough, "entity", "left_semi")
    # Words are exploded last, and (entity, term) is counted in each task before the shuffle.
    contexts = rowwise.select("entity", "context", F.explode("_words").alias("term")).distinct()
    supported = contexts.groupBy("entity", "term").count().filter(F.col("count") >= MIN_CONTEXTS)
    held = mentioned.select(
        F.explode(F.array_distinct("_mentions.entity")).alias("entity"), "_words"
    ).join(enough, "entity", "left_semi")
    together = held.select("entity", F.explode("_words").alias("term")).groupBy("entity", "term")
    together = together.agg(F.count("*").alias("both"))
    supported = supported.drop("count").join(together, ["entity", "term"])
    supported = written(supported, "supported-terms")
    holding = held.groupBy("entity").agg(F.count("*").alias("of_entity"))
    documents = document_counts(texts, supported.select("term").distinct())
    pmi = F.log2(F.lit(float(rows)) * F.col("both") / (F.col("of_entity") * F.col("documents")))
    information = F.log2(F.lit(float(rows)) / F.col("of_entity"))
    rated = supported.join(holding, "entity").join(documents, "term")
    rated = rated.filter(information > 0).withColumn("share", pmi / information)
    kind = F.when(F.col("share") >= REMOVE_FROM, "removed").otherwise("generalised")
    return rated.filter(F.col("share") >= GENERALISE_FROM).select(
        "entity", "term", kind.alias("kind")
    )


def _found(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Detected rows, written once, with a number for each row and the terms to hide in it."""
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    own = ["_row", *keep, "_spans", "_mentions", "_words"]
    found = written(detect(numbered).select(*own), "pii")
    hidden = disclosing(found, docs.select("text"), found.count())
    in_row = found.select("_row", F.explode("_mentions.entity").alias("entity")).distinct()
    terms = in_row.join(hidden, "entity").groupBy("_row")
    terms = terms.agg(F.collect_set(F.struct("kind", "term")).alias("_terms"))
    return found.drop("_words").join(terms, "_row", "left")


def _all_spans(text: str, spans: list[dict], terms: list[dict] | None) -> list:
    base = [(s["kind"], s["start"], s["end"]) for s in spans]
    if not terms:
        return base
    kinds: dict[str, str] = {}
    for t in terms:
        kinds[t["term"]] = max(t["kind"], kinds.get(t["term"], ""))
    more = [(kinds[t], a, b) for a, b, t in words_outside(text, base) if t in kinds]
    return base + [s for kind in TERM_KINDS for s in more if s[0] == kind]


def replaced(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with a mark in place of each span; spans that overlap get the first one's mark."""
    out, free = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= free:
            out += [text[free:start], MARKS[kind]]
        free = max(free, end)
    return "".join([*out, text[free:]])


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms) of each row.

    Places count code points, ends are exclusive. A null or empty text has no spans; null and
    repeated doc_ids keep a row each, and repeated texts count as documents but not as further
    contexts. Other columns are ignored, an empty table gives no rows.
    """
    # Only texts with a span are looked at again.
    docs = plain(docs, "doc_id", "text")
    asked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    suspect = F.when(F.size("_spans") > 0, F.col("text")).alias("text")
    found = _found(asked, ["doc_id", suspect])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                base = [(s["kind"], s["start"], s["end"]) for s in row["_spans"]]
                spans = _all_spans(row["text"] or "", row["_spans"], row["_terms"])
                kinds = [kind for kind, _, _ in base]
                rows.append(
                    {"doc_id": row["doc_id"]}
                    | {f"n_{kind}": kinds.count(kind) for kind in BASE_KINDS}
                    | {
                        "base_sha256": hashlib.sha256(spelled(base).encode()).hexdigest(),
                        "spans": spelled(spans),
                        "n_terms": len(spans) - len(base),
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    arrow = pa.schema(
        [("doc_id", pa.int64())]
        + [(f"n_{kind}", pa.int64()) for kind in BASE_KINDS]
        + [("base_sha256", pa.string()), ("spans", pa.string()), ("n_terms", pa.int64())]
    )
    counts = ", ".join(f"n_{kind} bigint" for kind in BASE_KINDS)
    return found.select("doc_id", "text", "_spans", "_terms").mapInArrow(
        run, f"doc_id bigint, {counts}, base_sha256 string, spans string, n_terms bigint"
    )


def sanitised(docs: DataFrame) -> DataFrame:
    """The rows and columns of docs with every span replaced by its mark; others as they are."""
    original, docs = docs.columns, plain(docs, "doc_id", "text")
    names = docs.columns
    found = _found(docs, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.select(["text", "_spans", "_terms"]).to_pylist()
            texts = [
                replaced(r["text"], _all_spans(r["text"], r["_spans"], r["_terms"]))
                for r in columns
            ]
            place = names.index("text")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(texts, pa.string()) if i == place else batch.column(i)
                    for i in range(len(names))
                ],
                names,
            )

    clean = found.filter(F.size("_spans") == 0).select(*names)
    held = found.filter(F.size("_spans") > 0).select(*names, "_spans", "_terms")
    return clean.union(held.mapInArrow(run, docs.schema)).toDF(*original)
