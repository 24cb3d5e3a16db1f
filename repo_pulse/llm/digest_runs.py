"""Exact duplicates by a tree-merge of sorted digest runs.

Each part of the table becomes a run: its distinct texts as entries (digest, proof, largest
doc_id, rows), sorted by digest. Runs are dealt to shards by digest and merged in binomial rounds:
in round r, runs whose numbers agree above the lowest r * FAN_BITS bits meet and are merged as
sorted streams, equal entries becoming one. After the last round a shard holds one run. A text
that a third of all rows share costs one entry for each run, never a group in one task.

Equal digests alone do not merge: the proof, the text's length and a second hash of another
family, must agree at every level as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repo_pulse.llm.scratch import plain, written

# Runs that meet in a round: 2 ** FAN_BITS.
FAN_BITS = 3
# Rows a shard holds on average; it bounds no group, entries of one digest just share a shard.
SHARD_ROWS = 4096
# Rows sorted in a task's memory at a time; a longer part becomes several pieces of one run.
PIECE_ROWS = 1 << 17

DIGEST_BYTES = 32

ENTRY = "shard int, run int, digest binary, proof binary, doc_id bigint, n bigint"
KEYS = ["shard", "run", "digest", "proof"]


def merged(entries: pa.Table) -> pa.Table:
    """Equal entries as one with the largest doc_id and all rows, sorted by digest."""
    found = entries.group_by(KEYS).aggregate([("doc_id", "max"), ("n", "sum")])
    found = found.rename_columns([*KEYS, "doc_id", "n"])
    return found.sort_by([(key, "ascending") for key in KEYS])


def sorted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a part as sorted entries, a bounded number of rows at a time."""
    waiting, rows = [], 0
    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows >= PIECE_ROWS:
            yield from merged(pa.Table.from_batches(waiting)).to_batches()
            waiting, rows = [], 0
    if rows:
        yield from merged(pa.Table.from_batches(waiting)).to_batches()


def merged_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted entries of several runs as those of one; the last entry waits for its equals."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = merged(table if last is None else pa.concat_tables([last, table]))
        last = table.slice(table.num_rows - 1)
        yield from table.slice(0, table.num_rows - 1).to_batches()
    if last is not None:
        yield from last.to_batches()


def digests(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """(doc_id, text_sha256, digest, proof, run) of each row; a null text counts as empty."""
    text = F.coalesce("text", F.lit(""))
    size = F.lpad(F.hex(F.octet_length(text).cast("bigint")), 16, "0")
    other = F.lpad(F.hex(F.xxhash64(text)), 16, "0")
    hashed = docs.select("doc_id", F.unhex(F.sha2(text, 256)).alias("sha"), size.alias("size"),
                         other.alias("other"))
    return hashed.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        F.substring("sha", 1, digest_bytes).alias("digest"),
        F.unhex(F.concat("size", "other")).alias("proof"),
        F.spark_partition_id().alias("run"),
    )


def tree_merge(rows: DataFrame, fan_bits: int = FAN_BITS) -> DataFrame:
    """(digest, proof, keep_id, group_size) of each different text.

    `rows` has digest, proof, doc_id and the number of its run, from 0. Rounds follow the number of
    runs, shards the number of rows, so every task merges a bounded share.
    """
    total, last = rows.agg(F.count("*"), F.max("run")).first()
    shards = (total // SHARD_ROWS) + 1
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")
    entries = rows.select(
        shard.alias("shard"), "run", "digest", "proof", "doc_id", F.lit(1).cast("bigint").alias("n")
    ).mapInArrow(sorted_runs, ENTRY)
    while True:
        meeting = F.shiftright("run", fan_bits).alias("run")
        entries = (
            entries.select("shard", meeting, "digest", "proof", "doc_id", "n")
            .repartition("shard", "run")
            .sortWithinPartitions(*KEYS)
            .mapInArrow(merged_runs, ENTRY)
        )
        last = (last or 0) >> fan_bits
        if not last:
            break
    return entries.select(
        "digest", "proof", F.col("doc_id").alias("keep_id"), F.col("n").alias("group_size")
    )


def duplicates(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of each row.

    Texts are equal when they are identical; null counts as empty. Of equal texts the largest
    doc_id stays. Rows that repeat a doc_id with its text are one document and marked alike. A
    null doc_id takes part, and stays only where its text has no other (keep_id is null then). Other
    columns are ignored, whatever their names; an empty table gives no rows.
    """
    rows = written(digests(plain(docs, "doc_id", "text"), digest_bytes), "digests")
    groups = tree_merge(rows.drop("text_sha256"))
    return rows.join(groups, ["digest", "proof"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The table's rows whose doc_id stays, with all columns; repeated rows of it stay as well."""
    original, docs = docs.columns, plain(docs, "doc_id", "text")
    stays = duplicates(docs).filter("kept").select(
        F.col("doc_id").alias("own_id"), "text_sha256"
    ).distinct()
    sha = F.sha2(F.coalesce("text", F.lit("")), 256)
    same = docs.doc_id.eqNullSafe(stays.own_id) & (sha == stays.text_sha256)
    return docs.join(stays, same, "left_semi").toDF(*original)
