"""Token ids of documents as Parquet list columns, sorted by document, for selective reads."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repo_pulse.llm.arrow_text import pieces
from repo_pulse.llm.scratch import plain
from repo_pulse.llm.tokenizing import crc32_of, encoder, with_last

SCHEMA = "doc_id bigint, n_tokens bigint, ids array<int>"

# Bytes of text encoded at a time: in larger pieces more words repeat.
ENCODED_BYTES = 6 << 20

# Ids repeat, so they are dictionary-encoded; ascending doc_ids and lengths are delta-encoded.
# Small pages with column and offset indexes (Parquet's default) let a filter on doc_id skip pages.
WRITER = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(128 << 10),
    "parquet.page.row.count.limit": "500",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}


PLACED = "part int, " + SCHEMA


def cuts(docs: DataFrame, parts: int) -> np.ndarray:
    """doc_ids that cut the documents into about as many equal parts, from a pass over the ids."""
    shares = [k / parts for k in range(1, parts)]
    if not shares:
        return np.zeros(0, dtype=np.int64)
    found = docs.agg(F.percentile_approx("doc_id", shares).alias("cuts")).first()["cuts"]
    return np.array(found or [], dtype=np.int64)


def encode(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, n_tokens, ids) of each row, `end_id` behind each text, sorted by doc_id.

    Texts are encoded where they are read, so a task's memory of words serves whole files, and only
    ids are dealt to ranges of doc_ids. A null text counts as empty and gives the end id alone. A
    null doc_id sorts first, and rows with the same doc_id follow each other in the order of their
    ids. Columns besides doc_id and text are ignored, an empty table gives no rows.
    """
    docs = plain(docs, "doc_id", "text")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends_of_parts = cuts(docs, parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer, drops_space=True)
        for batch in pieces(batches, size=ENCODED_BYTES):
            ids, ends = with_last(*coder.encode(batch.column(1)), end_id)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            doc_ids = batch.column(0)
            known = pc.fill_null(doc_ids, np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            part = np.searchsorted(ends_of_parts, known).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), doc_ids, pa.array(np.diff(ends)), lists],
                ["part", "doc_id", "n_tokens", "ids"],
            )

    placed = docs.mapInArrow(run, PLACED).repartitionById(parts, F.col("part"))
    return placed.sortWithinPartitions("doc_id", "ids").drop("part")


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Write the ids of all documents: a file for each range of doc_ids, in ascending order."""
    encode(docs, tokenizer, end_id).write.options(**WRITER).parquet(path)


def read(spark: SparkSession, path: str, doc_ids: tuple[int, int] | None = None) -> DataFrame:
    """The table, or the documents from the first to the second id; only their pages are read."""
    stored = spark.read.schema(SCHEMA).parquet(path)
    return stored if doc_ids is None else stored.filter(F.col("doc_id").between(*doc_ids))


def starts(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, row_index, start): the ids of all documents before each row, from lengths alone.

    Lengths are summed for each file first; the running sum over files has a row for each file.
    """
    lengths = _with_places(read(spark, path)).select("file_name", "row_index", "n_tokens")
    files = lengths.groupBy("file_name").agg(F.sum("n_tokens").alias("of_file"))
    # By the number in the name: the names of more than 99,999 files don't sort like it.
    number = F.regexp_extract("file_name", r"part-(\d+)", 1).cast("bigint")
    before = Window.orderBy(number, "file_name").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(
        "file_name", F.coalesce(F.sum("of_file").over(before), F.lit(0)).alias("before_file")
    )
    inside = (
        Window.partitionBy("file_name")
        .orderBy("row_index")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    running = lengths.withColumn("in_file", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    start = (F.col("before_file") + F.col("in_file")).alias("start")
    return running.join(files, "file_name").select("file_name", "row_index", start)


def _with_places(stored: DataFrame) -> DataFrame:
    return stored.select("*", F.col("_metadata.file_name"), F.col("_metadata.row_index"))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each stored row, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            ends = lists.offsets.to_numpy().astype(np.int64)
            crcs = crc32_of(lists.values.to_numpy(), ends)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("file_name"),
                    batch.column("row_index"),
                    pa.array(np.diff(ends)),
                    pa.array(crcs),
                ],
                ["doc_id", "file_name", "row_index", "n_tokens", "ids_crc32"],
            )

    rows = _with_places(read(spark, path)).drop("n_tokens")
    rows = rows.mapInArrow(
        run,
        "doc_id bigint, file_name string, row_index bigint, n_tokens bigint, ids_crc32 bigint",
    )
    places = ["file_name", "row_index"]
    return rows.join(starts(spark, path), places).drop(*places)
