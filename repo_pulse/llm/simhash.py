"""SimHash near-duplicates by a range join on bit counts of fingerprint segments.

A fingerprint is cut into 32 segments of 2 bits, and its cell is the vector of their bit counts.
Fingerprints at Hamming distance d lie in cells at Manhattan distance at most d, so cells that are
too far apart need no look. A range join finds the fingerprints with another one near enough in
the grid: both sides are put into all cells within half the distance, where close ones must meet.
The exact check does the same with whole fingerprints: all that meet at a 64-bit value lie within
the distance, so tying each to the smallest of them keeps every link without listing pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repo_pulse.llm.arrow_text import group_sums, lower_ascii, pieces, texts_of, words_of
from repo_pulse.llm.components import components
from repo_pulse.llm.scratch import plain, written

SEED = 42
# Longer segments make fewer cells: with 4 bits, 8 % of the fingerprints of 256,000 documents had
# a neighbour in the grid by chance, and the share grew with the number of documents.
SEGMENTS = 32
LOW_BITS = 0x5555555555555555


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, bounds: np.ndarray, size: int):
    """XXH64 of each text's shingles of `size` words, and where each text's shingles end.

    A text with fewer words has one shingle, all of it; a text without words has none.
    """
    lengths, words = np.diff(offsets), len(offsets) - 1
    joined = np.full(len(data) + words, 0x20, dtype=np.uint8)
    joined[np.arange(len(data)) + np.repeat(np.arange(words), lengths)] = data
    starts = offsets[:-1] + np.arange(words)
    ends = starts + lengths
    counts = np.diff(bounds)
    shingles = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
    ends_of = np.concatenate([[0], np.cumsum(shingles)])
    first = np.arange(ends_of[-1]) + np.repeat(bounds[:-1] - ends_of[:-1], shingles)
    last = np.minimum(first + size, np.repeat(bounds[1:], shingles)) - 1
    raw, digest = memoryview(joined), xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(raw[a:b], SEED) for a, b in zip(starts[first], ends[last], strict=True)),
        dtype=np.uint64,
        count=len(first),
    )
    return hashes, ends_of


def fingerprints(docs: DataFrame, shingle_words: int, *more: str) -> DataFrame:
    """(doc_id, fingerprint as a signed 64-bit number) of each row, and columns besides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = texts_of(batch.column(1))
            texts.data = lower_ascii(texts.data)
            words = words_of(texts)
            hashes, ends = shingle_hashes(
                words.data, words.offsets, words.of_text, shingle_words
            )
            total, found = np.diff(ends), np.zeros(batch.num_rows, dtype=np.uint64)
            for bit in range(64):
                ones = group_sums(((hashes >> np.uint64(bit)) & np.uint64(1)).astype(int), ends)
                found |= (2 * ones > total).astype(np.uint64) << np.uint64(bit)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]],
                ["doc_id", "fingerprint", *more],
            )

    asked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *more)
    schema = T.StructType([asked.schema["doc_id"], T.StructField("fingerprint", T.LongType())])
    return asked.mapInArrow(run, T.StructType([*schema.fields, *asked.schema.fields[2:]]))


def cell_of(fingerprint: Column) -> Column:
    """Bit counts of the segments (0, 1 or 2), each in two bits of one number."""
    low = fingerprint.bitwiseAND(LOW_BITS)
    high = F.shiftrightunsigned(fingerprint, 1).bitwiseAND(LOW_BITS)
    return F.shiftleft(low.bitwiseAND(high), 1).bitwiseOR(low.bitwiseXOR(high))


def cells_near(cell: Column, radius: int) -> Column:
    """All cells within a Manhattan distance."""
    cells = F.array(cell)
    for _ in range(radius):
        cells = F.array_distinct(F.flatten(F.transform(cells, _steps)))
    return cells


def _steps(cell: Column) -> Column:
    """A cell and those one step away: a segment's count goes 0 - 1 - 2 or back."""
    out = [cell]
    for k in range(SEGMENTS):
        count = F.shiftrightunsigned(cell, 2 * k).bitwiseAND(3)
        out.append(F.when(count < 2, cell.bitwiseXOR(signed(1 << 2 * k))))
        out.append(F.when(count > 0, cell.bitwiseXOR(signed(3 << 2 * k))))
    return F.array_compact(F.array(*out))


def signed(value: int) -> Column:
    """An unsigned 64-bit number as Spark's signed one."""
    return F.lit(value - (1 << 64) if value >> 63 else value)


def masks(radius: int) -> Column:
    """The 64-bit numbers with at most so many ones."""
    values = [
        sum(1 << bit for bit in bits)
        for ones in range(radius + 1)
        for bits in combinations(range(64), ones)
    ]
    return F.array(*map(signed, values))


def links(different: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): enough links between different fingerprints to tie all within `max_bits`.

    The answer has the same components as all pairs, but no group is paired with itself.
    """
    if max_bits % 2:
        raise ValueError("max_bits must be even: both sides meet half way")
    radius = max_bits // 2
    value = F.col("fingerprint")
    in_cells = different.select(
        value, F.explode(cells_near(cell_of(value), radius)).alias("cell")
    ).withColumn("meeting", F.count("*").over(Window.partitionBy("cell")))
    candidates = written(
        in_cells.filter("meeting > 1").select("fingerprint").distinct(), "candidates"
    )
    meeting = candidates.select(
        value.alias("a"), F.explode(F.transform(masks(radius), value.bitwiseXOR)).alias("at")
    ).withColumn("b", F.min("a").over(Window.partitionBy("at")))
    distance = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return meeting.filter((F.col("a") != F.col("b")) & (distance <= max_bits)).select("a", "b")


def _components(found: DataFrame, max_bits: int) -> DataFrame:
    """(fingerprint, component_id) of each different fingerprint."""
    different = found.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    different = written(different, "different")
    roots = components(links(different.select("fingerprint"), max_bits))
    tied = different.join(roots, different.fingerprint == roots.node, "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    smallest = tied.groupBy("root").agg(F.min("first").alias("component_id"))
    return tied.join(smallest, "root").select("fingerprint", "component_id", "root")


def near_duplicates(docs: DataFrame, shingle_words: int, max_bits: int) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row.

    Rows with one fingerprint, and fingerprints that differ in at most `max_bits` bits, are linked;
    `component_id` is the smallest doc_id that links reach. A null or empty text has fingerprint
    zero and is linked like any other. Rows with a null doc_id take part, and name a component
    only if it has no other (null then). Repeated rows each give a row. Other columns are ignored,
    an empty table gives no rows.
    """
    docs = plain(docs, "doc_id", "text")
    found = written(fingerprints(docs, shingle_words), "fingerprints")
    named = _components(found, max_bits)
    return found.join(named, "fingerprint").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(docs: DataFrame, shingle_words: int, max_bits: int) -> DataFrame:
    """One row of each component, with all columns: the first by doc_id, nulls last.

    Of rows with the same doc_id the first by the order of the table's parts stays.
    """
    original, docs = docs.columns, plain(docs, "doc_id", "text")
    numbered = written(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")
    found = written(
        fingerprints(numbered, shingle_words, "row").withColumnRenamed("doc_id", "own_id"),
        "fingerprints",
    )
    named = _components(found.withColumnRenamed("own_id", "doc_id"), max_bits)
    first = F.min(F.struct(F.col("own_id").isNull(), "own_id", "row"))
    kept = found.join(named, "fingerprint").groupBy("root").agg(first.alias("first"))
    kept = kept.select(F.col("first.row").alias("row"))
    return numbered.join(kept, "row", "left_semi").select(*docs.columns).toDF(*original)
