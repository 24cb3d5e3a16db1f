"""Quality of documents by the votes of their nearest labelled neighbours.

A document is a weighted histogram of its words, their shapes and lengths, and how they repeat.
A bounded sample of labelled documents gives the weights and a latent space (the leading singular
vectors). The sample's vectors are broadcast; every document is compared with all of them, in
blocks, and its most similar neighbours vote, each with the weight of its similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repo_pulse.llm.arrow_text import binary_array, pieces, texts_of, words_of
from repo_pulse.llm.scratch import plain

# Labelled documents of each class that are learnt from, about; this bounds what is broadcast.
PER_CLASS = 2_000
LATENT = 64
NEIGHBOURS = 25
# Similarities count with this power, so the nearest neighbours decide.
SHARPNESS = 8
BLOCK = 1024

# Parts of a document's histogram.
WORD_DIMS, SHAPE_DIMS, LENGTH_DIMS, REPEAT_DIMS, VARIETY_DIMS = 256, 512, 24, 3, 16
DIMS = WORD_DIMS + SHAPE_DIMS + LENGTH_DIMS + REPEAT_DIMS + VARIETY_DIMS

# Classes of bytes in a word's shape: capitals, other letters and digits are one class each, every
# other byte is its own; a run of one class counts once.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[0x30:0x3A] = ord("0")
SHAPE[0x41:0x5B] = ord("A")
SHAPE[0x61:0x7B] = SHAPE[0x80:] = ord("a")


def _hashed(array: pa.Array, dims: int) -> np.ndarray:
    digest = xxhash.xxh32_intdigest
    return np.fromiter((digest(w.as_buffer()) % dims for w in array), np.int64, count=len(array))


def histograms(column: pa.Array) -> np.ndarray:
    """A row for each text: square roots of the shares of its words; zeros without words."""
    texts = texts_of(column)
    words = words_of(texts)
    total, n = len(texts), words.counts()
    out = np.zeros(total * DIMS)
    if not len(words):
        return out.reshape(total, DIMS).astype(np.float32)
    text = np.repeat(np.arange(total), n)
    coded = words.array().dictionary_encode()
    number = coded.indices.to_numpy()

    def add(first: int, dim: np.ndarray, at: np.ndarray | slice = slice(None)) -> None:
        out.__iadd__(np.bincount(text[at] * DIMS + first + dim, minlength=len(out)))

    lowered = pc.ascii_lower(coded.dictionary.cast(pa.large_string()))
    add(0, _hashed(lowered, WORD_DIMS)[number])
    first = WORD_DIMS
    kinds = SHAPE[words.data]
    kept = np.ones(len(kinds), dtype=bool)
    kept[1:] = kinds[1:] != kinds[:-1]
    kept[words.offsets[:-1]] = True
    ends = np.concatenate([[0], np.cumsum(kept)])[words.offsets]
    shapes = binary_array(kinds[kept], ends).dictionary_encode()
    add(first, _hashed(shapes.dictionary, SHAPE_DIMS)[shapes.indices.to_numpy()])
    first += SHAPE_DIMS
    add(first, np.minimum(np.diff(words.offsets), LENGTH_DIMS) - 1)
    first += LENGTH_DIMS
    for back in range(1, REPEAT_DIMS + 1):
        same = np.zeros(len(number), dtype=bool)
        same[back:] = (number[back:] == number[:-back]) & (text[back:] == text[:-back])
        add(first, np.full(int(same.sum()), back - 1), same)
    first += REPEAT_DIMS
    # How many of the words are different, as one dimension that all words of a text go to.
    pairs = np.unique(text * len(coded.dictionary) + number)
    different = np.bincount(pairs // len(coded.dictionary), minlength=total)
    variety = (different * (VARIETY_DIMS - 1)) // np.maximum(n, 1)
    add(first, variety[text])
    shares = out.reshape(total, DIMS) / np.maximum(n, 1)[:, None]
    return np.sqrt(shares).astype(np.float32)


@dataclass
class Voters:
    """Weights of the dimensions, latent directions, and the labelled vectors with their votes."""

    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    stands_for: np.ndarray  # labelled documents that each vector stands for
    prior: float

    def latent(self, rows: np.ndarray) -> np.ndarray:
        x = (rows * self.weights) @ self.directions
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Share of the neighbours' weight that votes for label 1; the prior without any."""
        out = np.full(len(rows), self.prior)
        k = min(NEIGHBOURS, len(self.vectors))
        for at in range(0, len(rows) if k else 0, BLOCK):
            near = self.latent(rows[at : at + BLOCK]) @ self.vectors.T
            best = np.argpartition(near, -k, axis=1)[:, -k:]
            near = np.maximum(np.take_along_axis(near, best, axis=1), 0)
            weight = near**SHARPNESS * self.stands_for[best]
            total = weight.sum(axis=1)
            votes = (weight * self.labels[best]).sum(axis=1)
            out[at : at + BLOCK] = np.where(
                total > 0, votes / np.maximum(total, 1e-300), self.prior
            )
        return np.clip(out, 0.0, 1.0)


def fit(rows: np.ndarray, labels: np.ndarray, stands_for: np.ndarray) -> Voters:
    """Inverse document frequencies and singular vectors of the labelled rows."""
    if not len(rows):
        none = np.zeros((0, 1))
        return Voters(np.ones(DIMS), np.zeros((DIMS, 1)), none, labels, stands_for, 0.5)
    holding = (rows > 0).sum(axis=0)
    weights = np.log((1 + len(rows)) / (1 + holding)) + 0.1
    x = (rows * weights).astype(np.float64)
    _, directions = np.linalg.eigh(x.T @ x)
    prior = float(np.average(labels, weights=stands_for))
    voters = Voters(weights, directions[:, -LATENT:], x[:0], labels, stands_for, prior)
    voters.vectors = voters.latent(rows)
    return voters


def is_held_out(doc_id: Column) -> Column:
    """Documents whose crc32 of the id as text leaves 2 when divided by 4; null is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame) -> Voters:
    """Voters from a sample of the labelled documents that are not held out.

    About PER_CLASS labels of each class are chosen by a hash of the doc_id, so their number does
    not grow with the table. Labels repeated for a doc_id count as their mean, rounded.
    """
    labels = plain(labels, "doc_id", "quality")
    usable = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    usable = usable.filter(~is_held_out(F.col("doc_id")))
    usable = usable.groupBy(F.col("doc_id").cast("bigint").alias("_labelled")).agg(
        F.round(F.avg("quality")).cast("int").alias("_quality")
    )
    counts = {r["_quality"]: r["count"] for r in usable.groupBy("_quality").count().collect()}
    place = F.pmod(F.xxhash64("_labelled", F.lit("voters")), F.lit(1 << 30))
    share = F.lit(0)
    for quality, count in counts.items():
        kept = int(min(1.0, PER_CLASS / count) * (1 << 30))
        share = F.when(F.col("_quality") == quality, F.lit(kept)).otherwise(share)
    chosen = F.broadcast(usable.filter(place < share))
    held = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_labelled"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = histograms(batch.column(0))
            ends = np.arange(len(rows) + 1, dtype=np.int32) * DIMS
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays(
                [lists, batch.column(1), batch.column(2)], ["row", "quality", "doc_id"]
            )

    found = held.select("text", "_quality", "doc_id").mapInArrow(
        run, "row array<float>, quality int, doc_id bigint"
    )
    # In a fixed order, so that the singular vectors do not depend on which task ends first.
    found = found.toArrow().sort_by("doc_id")
    rows = found["row"].combine_chunks().flatten().to_numpy().reshape(-1, DIMS)
    quality = found["quality"].to_numpy()
    drawn = {int(q): int((quality == q).sum()) for q in np.unique(quality)}
    stands_for = np.array([counts[int(q)] / drawn[int(q)] for q in quality])
    return fit(rows, quality.astype(np.float64), stands_for)


def score(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (default: doc_id) of each row, and (held_out, score).

    `keep` takes the names that `plain(docs, "doc_id", "text")` gives.

    Scores lie between 0 and 1, higher where label 1 is likelier. A null or empty text, like any
    without words, gets the share of label 1 among the learnt rows (a half without labels). Null
    and repeated doc_ids keep a row each; other columns are ignored; an empty table gives no rows.
    """
    keep, docs = keep or ["doc_id"], plain(docs, "doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))
    held_out = is_held_out(F.col("doc_id")).alias("held_out")
    asked = docs.select(*keep, F.col("text").alias("_text"), held_out)
    schema = docs.select(*keep, held_out).schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            scores = shared.value.scores(histograms(batch.column(len(keep))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], batch.column(len(keep) + 1), pa.array(scores)],
                schema.names,
            )

    return asked.mapInArrow(run, schema)
