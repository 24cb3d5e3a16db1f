"""Incremental loads: new archives as they land, and the dates they touch.

The stream carries files, not lines: file discovery and its checkpoint are Spark's, the load of a
micro-batch is the batch job, which takes the batch as it is. Its loads bear the batch's id, so a
batch that is replayed after a failure goes on behind the last load it had committed. A bad archive
goes to the rejects table and the stream goes on. Every batch also takes archives that were rejected
before and have changed since, and so does the start of a stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from repo_pulse.plans import jobs
from repo_pulse.sources import archive
from repo_pulse.sources.lakehouse import LOAD_SOURCES, Lakehouse

_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def repaired(lake: Lakehouse, raw_root: str) -> DataFrame | None:
    """Landed archives whose name was rejected and whose version is not known; None if nothing was
    rejected. Only the folders of rejected archives are listed."""
    rejects = lake.open_rejects("bronze").unionByName(lake.open_rejects("silver"))
    names = rejects.select("source_file").distinct()
    hours = lake.spark.table(lake.manifests).join(names, "source_file", "left_semi")
    days = hours.where("archive_date IS NOT NULL").select("archive_date").distinct().collect()
    if not days:
        return None
    landed = archive.inventory(lake.spark, raw_root, sorted(row.archive_date for row in days))
    return lake.pending_archives(landed.join(names, "source_file", "left_semi"))


def _on_arrival(
    lake: Lakehouse,
    raw_root: str,
    checkpoint: str,
    max_files: int,
    handle: Callable[[DataFrame, str | None], None],
) -> StreamingQuery:
    """Call `handle` with the archives of each micro-batch, at most `max_files` of them, and the
    batch's id; ends when everything that had landed is handled. File content is not read here."""
    if not 0 < max_files <= LOAD_SOURCES:
        raise ValueError(f"max_files must be from 1 to {LOAD_SOURCES}")
    arrivals = (
        lake.spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("pathGlobFilter", "*.gz")
        .option("maxFilesPerTrigger", max_files)
        .load(f"{archive.zone(raw_root)}/archive_date=*/archive_hour=*")
        .select("path", "modificationTime", "length")
    )

    def handed_over(files: DataFrame, name: str) -> DataFrame:
        """A list of files, by way of a folder beside the checkpoint."""
        folder = f"{checkpoint.rstrip('/')}-arrivals/{name}"
        files.write.mode("overwrite").parquet(folder)
        return lake.spark.read.schema(files.schema).parquet(folder)

    def take_repaired() -> None:
        changed = repaired(lake, raw_root)
        if changed is None:
            return
        # Written down as they are now: once loaded they are no longer new.
        changed = handed_over(changed, "repaired")
        if not changed.isEmpty():
            handle(changed, None)

    def each(batch: DataFrame, batch_id: int) -> None:
        # A batch belongs to a session of its own, which knows neither the views nor what is cached
        # of the tables in the lake's.
        handle(archive.described(handed_over(batch, str(batch_id))), f"{checkpoint}#{batch_id}")
        take_repaired()

    take_repaired()
    return (
        arrivals.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _load_bronze(lake: Lakehouse, raw_root: str, archives: DataFrame, origin: str | None) -> None:
    if origin is None or not lake.is_committed("bronze", origin):
        jobs.load_bronze(lake, raw_root, archives, "quarantine", origin)


def stream_bronze(
    lake: Lakehouse, raw_root: str, checkpoint: str, max_files: int = 2000
) -> StreamingQuery:
    """Load new archives into Bronze, each version exactly once."""

    def handle(archives: DataFrame, origin: str | None) -> None:
        _load_bronze(lake, raw_root, archives, origin)

    return _on_arrival(lake, raw_root, checkpoint, max_files, handle)


def stream_refresh(
    lake: Lakehouse,
    raw_root: str,
    checkpoint: str,
    repository_index: DataFrame,
    max_files: int = 2000,
) -> StreamingQuery:
    """Load new archives up to Silver and rebuild every date they touch, late ones included.

    The touched dates come from the ledger. A date is rebuilt as a whole, so no state and no
    watermark is kept.
    """

    def handle(archives: DataFrame, origin: str | None) -> None:
        _load_bronze(lake, raw_root, archives, origin)
        if origin is None or not lake.is_committed("silver", origin):
            jobs.load_silver(lake, archives, "quarantine", origin)
        jobs.refresh(lake, repository_index)

    return _on_arrival(lake, raw_root, checkpoint, max_files, handle)
