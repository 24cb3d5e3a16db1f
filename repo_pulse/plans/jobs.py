"""The jobs: loads, builds, whole days, backfills, checks and publication.

Each job handles all its archives or dates in one set of Spark jobs and can be run again at
any time: finished sources are skipped, dates are rebuilt as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repo_pulse.operators import bronze, gold, quality, silver
from repo_pulse.sources import archive
from repo_pulse.sources.lakehouse import (
    LINE,
    LOAD_SOURCES,
    ROW_ID,
    SHOWN,
    UNREADABLE,
    VERSION,
    Lakehouse,
    sources_frame,
    without_lines,
)
from repo_pulse.sources.serving import JdbcServing

# Fixed value: the first daily partition.
FIRST_DATE = date(2015, 1, 1)

# Why hours are refused.
NO_HOURS = "at least one archive hour is required"
NAIVE_HOURS = "archive hours must be timezone-aware"
SEVERAL_DATES = "all archive hours must belong to the same UTC date"

# How Spark says that a file could not be read, whatever the exception around it.
FILE_ERRORS = ("FAILED_READ_FILE", "java.util.zip", "java.io.EOFException", "not in gzip format")


class QualityError(ValueError):
    """A blocking check failed."""


@dataclass(frozen=True)
class RunSummary:
    """Counts of one run, in archives and rows. `reused_archive_count` counts the archives that
    were finished before, `rejected_count` what the run left out (see the rejects table)."""

    archive_count: int
    bronze_rows: int
    silver_rows: int
    gold_rows: int
    reused_archive_count: int = 0
    rejected_count: int = 0


def load_bronze(
    lake: Lakehouse,
    raw_root: str,
    archives: DataFrame,
    mode: str = "fail",
    origin: str | None = None,
) -> int:
    """Load the archives (columns of `archive.inventory`) whose version is not known yet; returns
    the rows that became visible.

    An archive is known by name, modification time and length: a repaired one is loaded again and
    takes the old one's place, an unchanged bad one is not tried twice. When a name occurs in
    several folders, one of them is taken. Bad, unreadable and empty archives go to the rejects
    table and the others are committed; with mode `fail`, LoadError is raised after that if any
    of the given archives could not be read or had a bad line. `origin` names the stream batch.
    """
    committed = 0
    while True:
        load = lake.next_load("bronze")
        pending = lake.pending_archives(archives)
        one = F.min_by(F.struct("archive_date", "hour", "modificationTime", "length"), "path")
        pending = pending.groupBy("source_file").agg(one.alias("file")).select(
            "source_file",
            "file.archive_date",
            F.hour("file.hour").cast("bigint").alias("archive_hour"),
            F.col("file.modificationTime").alias("modified_at"),
            "file.length",
        )
        listed = lake.plan("bronze", load, pending)
        if listed:
            rows = _write_bronze(lake, raw_root, load)
            if rows is None:
                continue
            committed += lake.commit_bronze(load, rows, origin)
        if listed < LOAD_SOURCES:
            break
    if mode == "fail":
        # An empty archive is no error of this layer.
        found = lake.rejected_of(_versions(archives)).where("layer = 'bronze'")
        found = found.where("first_error_line IS NOT NULL OR reason LIKE '%cannot be read'")
        lake.require_none(found)
    return committed


def _versions(archives: DataFrame) -> DataFrame:
    return archives.withColumnRenamed("modificationTime", "modified_at").select(*VERSION)


def _write_bronze(lake: Lakehouse, raw_root: str, load: int) -> int | None:
    """Parse the archives of a load and write their rows, visible to nobody yet; returns the rows.

    When Spark could not read a file, all files of the load are unpacked once to find every broken
    one. These are rejected and None is returned: the others make up the next load, so a batch is
    written twice, however many are broken. Any other failure is passed on.
    """
    manifest = lake.manifest("bronze", load)
    days = manifest.select("archive_date").distinct().collect()
    dates = sorted(row.archive_date for row in days)
    skip = [row.source_file for row in lake.broken_neighbours(load).collect()]
    lines = archive.read_planned(lake.spark, raw_root, manifest, dates, skip)
    parsed = bronze.parse_events(lines, located=False).withColumnRenamed(LINE, ROW_ID)
    try:
        return lake.write_load("bronze", load, parsed)[0]
    except Exception as error:
        if not any(sign in str(error) for sign in FILE_ERRORS):
            raise
        found = archive.unreadable(lake.spark, raw_root, manifest, dates)
        try:
            if found.isEmpty():
                raise
            broken = manifest.join(found, "source_file", "left_semi")
            lake.reject("bronze", load, without_lines(broken, UNREADABLE))
        finally:
            found.unpersist()
        return None


def load_bronze_paths(
    lake: Lakehouse, raw_root: str, paths: Sequence[str], mode: str = "fail"
) -> int:
    if not paths:
        return 0
    return load_bronze(lake, raw_root, archive.listed(lake.spark, paths), mode)


def load_silver(
    lake: Lakehouse,
    sources: Sequence[str] | DataFrame | None = None,
    mode: str = "fail",
    origin: str | None = None,
) -> int:
    """Type the visible Bronze sources not in Silver yet: the given ones (names, or a relation with
    `source_file`), or all. Returns the rows that became visible.

    A given source that is in neither layer is an error. Sources with a bad row go to the rejects
    table and the others are committed; with mode `fail`, LoadError is raised after that. With
    mode `quarantine`, given sources that are in neither layer are left alone.
    """
    if sources is not None and not isinstance(sources, DataFrame):
        sources = sources_frame(lake.spark, sources)
    if sources is not None and mode == "fail":
        unknown = sources.select("source_file").join(
            lake.bronze_sources(), "source_file", "left_anti"
        )
        if total := unknown.count():
            shown = unknown.orderBy("source_file").limit(SHOWN).collect()
            names = ", ".join(row.source_file for row in shown)
            more = f" ({total} in all)" if total > SHOWN else ""
            raise ValueError(f"Bronze source file not found: {names}{more}")
    committed = 0
    while True:
        load = lake.next_load("silver")
        listed = lake.plan("silver", load, lake.pending_silver(sources))
        if listed:
            typed = silver.to_silver(lake.read_planned(load))
            rows, bad = lake.write_load("silver", load, typed)
            committed += lake.commit_silver(load, rows, bad, origin)
        if listed < LOAD_SOURCES:
            break
    if mode == "fail":
        found = lake.open_rejects("silver")
        if sources is not None:
            found = found.join(sources.select("source_file"), "source_file", "left_semi")
        lake.require_none(found)
    return committed


def _catalog_id(repository_index: DataFrame) -> str:
    """Tells one index from another, whatever the order of its rows."""
    row = F.xxhash64("repository", "technology_id")
    count, mixed = repository_index.agg(F.count("*"), F.bit_xor(row)).first()
    return f"{count}/{mixed}"


def build_gold(
    lake: Lakehouse,
    dates: Sequence[date],
    repository_index: DataFrame,
    catalog_id: str | None = None,
) -> int:
    """Rebuild whole dates from Silver, late events included; returns the Gold rows."""
    seen = lake.last_load("silver")
    events = lake.read_silver(dates, upto=seen)
    rows = gold.daily_activity(events, repository_index)
    actors = gold.actor_bitmaps(events, repository_index)
    return lake.replace_dates(
        rows, dates, catalog_id or _catalog_id(repository_index), seen, actors
    )


def refresh(
    lake: Lakehouse, repository_index: DataFrame, dates: Sequence[date] | None = None
) -> list[date]:
    """Rebuild the dates, all or of the given ones, that changed since their last build; returns
    those rebuilt."""
    catalog_id = _catalog_id(repository_index)
    stale = lake.stale_dates(catalog_id, dates)
    if stale:
        build_gold(lake, stale, repository_index, catalog_id)
    return stale


def run_hours(
    lake: Lakehouse,
    raw_root: str,
    hours: Sequence[datetime],
    repository_index: DataFrame,
    mode: str = "fail",
) -> RunSummary:
    """Raw to Gold for landed hours of one UTC date; `mode` as for `backfill`."""
    if not hours:
        raise ValueError(NO_HOURS)
    if any(hour.tzinfo is None or hour.utcoffset() is None for hour in hours):
        raise ValueError(NAIVE_HOURS)
    wanted = [hour.astimezone(UTC) for hour in hours]
    if any((hour.minute, hour.second, hour.microsecond) != (0, 0, 0) for hour in wanted):
        raise ValueError(archive.UNALIGNED_HOUR)
    dates = sorted({hour.date() for hour in wanted})
    if len(dates) != 1:
        raise ValueError(SEVERAL_DATES)
    expected = lake.spark.createDataFrame(
        pa.table({"hour": pa.array(wanted, pa.timestamp("us", "UTC"))})
    ).distinct()
    landed = archive.inventory(lake.spark, raw_root, dates)
    absent = archive.landing(landed, expected).where(~F.col("landed")).orderBy("hour").collect()
    if absent:
        names = ", ".join(f"{row.hour:%Y-%m-%dT%H}" for row in absent)
        raise FileNotFoundError(f"archive hours have not landed: {names}")
    wanted_files = landed.join(expected, "hour", "left_semi")
    return _to_gold(lake, raw_root, wanted_files, dates, repository_index, mode)


def _to_gold(
    lake: Lakehouse,
    raw_root: str,
    archives: DataFrame,
    dates: Sequence[date],
    repository_index: DataFrame,
    mode: str,
) -> RunSummary:
    """Load the archives and rebuild the dates that changed since their last build. Bad sources
    hold up neither the others nor the dates: they are recorded, and with mode `fail` they raise
    LoadError when all is built."""
    # The listing of this run, used by both loads and the summary.
    archives = archives.persist()
    try:
        names = archives.select("source_file").distinct()
        total, reused = lake.known_archives(archives)
        bronze_rows = load_bronze(lake, raw_root, archives, "quarantine")
        silver_rows = load_silver(lake, names, "quarantine")
        refresh(lake, repository_index, dates)
        rejected = lake.rejected_of(_versions(archives))
        left_out = rejected.select("source_file").distinct().count()
        if mode == "fail" and left_out:
            lake.require_none(rejected)
        gold_rows = lake.read_gold(dates).count()
        return RunSummary(total, bronze_rows, silver_rows, gold_rows, reused, left_out)
    finally:
        archives.unpersist()


def run_day(
    lake: Lakehouse, raw_root: str, day: date, repository_index: DataFrame
) -> RunSummary:
    """Raw to Gold for the 24 hours of one UTC date."""
    start = datetime(day.year, day.month, day.day, tzinfo=UTC)
    hours = [start + timedelta(hours=n) for n in range(24)]
    return run_hours(lake, raw_root, hours, repository_index)


def date_range(from_date: date, to_date: date) -> list[date]:
    """Daily partitions from one date to another, both included."""
    if from_date < FIRST_DATE:
        raise ValueError(f"daily partitions start at {FIRST_DATE.isoformat()}")
    if to_date < from_date:
        raise ValueError(f"date range ends {to_date.isoformat()}, before {from_date.isoformat()}")
    return [from_date + timedelta(days=n) for n in range((to_date - from_date).days + 1)]


def backfill(
    lake: Lakehouse,
    raw_root: str,
    from_date: date,
    to_date: date,
    repository_index: DataFrame,
    mode: str = "fail",
) -> RunSummary:
    """Raw to Gold for everything that has landed in a range of dates, as one Bronze load,
    one Silver load and one Gold build. Hours that have not landed show in the checks.

    Bad, unreadable and empty archives go to the rejects table and every date is built from the
    others. With mode `fail`, LoadError then names them; with `quarantine`, the summary counts
    them. A repaired archive is loaded by the next run.
    """
    dates = date_range(from_date, to_date)
    landed = archive.inventory(lake.spark, raw_root, dates)
    return _to_gold(lake, raw_root, landed, dates, repository_index, mode)


def run_summary(lake: Lakehouse) -> DataFrame:
    """One row of totals over the visible sources and Gold."""
    silver_rows = lake.commits("silver").groupBy("source_file").agg(
        F.max_by("row_count", "load_id").alias("row_count")
    )
    rows = {
        "bronze": lake.bronze_sources().select("row_count"),
        "silver": silver_rows.select("row_count"),
        "gold": lake.read_gold().agg(F.count(F.lit(1)).alias("row_count")),
    }
    counted = reduce(
        DataFrame.unionByName,
        [found.select(F.lit(name).alias("layer"), "row_count") for name, found in rows.items()],
    )

    def total(layer: str) -> Column:
        found = F.sum(F.when(F.col("layer") == layer, F.col("row_count")))
        return F.coalesce(found, F.lit(0)).alias(f"{layer}_rows")

    archives = F.count_if(F.col("layer") == "bronze").alias("archive_count")
    return counted.agg(archives, *map(total, rows))


def checks(lake: Lakehouse, dates: Sequence[date]) -> DataFrame:
    """The three blocking checks over the given dates: `check_name, passed, details`."""
    asked = lake.spark.createDataFrame(pa.table({"event_date": pa.array(dates, pa.date32())}))
    found = {
        "complete_archive_hours": quality.complete_archive_hours(lake.read_silver(dates), asked),
        "unique_gold_keys": quality.unique_gold_keys(lake.read_gold(dates)),
        "valid_gold_metrics": quality.valid_gold_metrics(lake.read_gold(dates)),
    }
    return reduce(
        DataFrame.unionByName,
        [
            rows.select(
                F.lit(name).alias("check_name"),
                "passed",
                F.to_json(F.struct(*[c for c in rows.columns if c != "passed"])).alias("details"),
            )
            for name, rows in found.items()
        ],
    )


def require_checks(lake: Lakehouse, dates: Sequence[date]) -> None:
    """Raise QualityError naming the checks that did not pass."""
    failed = checks(lake, dates).where(~F.col("passed")).persist()
    try:
        total = failed.count()
        shown = failed.orderBy("check_name", "details").limit(SHOWN).collect()
    finally:
        failed.unpersist()
    if total:
        said = [f"{row.check_name}: {row.details}" for row in shown]
        raise QualityError("; ".join([*said, f"{total} failed checks in all"]))


def materialize_day(
    lake: Lakehouse, raw_root: str, day: date, repository_index: DataFrame
) -> RunSummary:
    """One whole day, then its checks; a failing check blocks what comes after."""
    summary = run_day(lake, raw_root, day, repository_index)
    require_checks(lake, [day])
    return summary


def publish(lake: Lakehouse, dates: Sequence[date], serving: JdbcServing) -> int:
    """Replace the given dates in the serving table, provided their checks pass."""
    require_checks(lake, dates)
    return serving.replace_dates(lake.read_gold(dates), dates)
