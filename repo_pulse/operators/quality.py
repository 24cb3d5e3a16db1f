"""Checks that gate publication. Each gives one row per checked date, or per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repo_pulse.functions.instants import utc_text
from repo_pulse.schema import GOLD_KEY, METRICS

SUBTYPES = (
    "push_count",
    "pull_request_count",
    "issue_count",
    "star_count",
    "fork_count",
    "release_count",
)


def archive_hours(silver: DataFrame) -> DataFrame:
    """Distinct archive hours present for each event date, in order; two columns are read."""
    return _present_hours(silver).orderBy("event_date", "archive_hour")


def _present_hours(silver: DataFrame) -> DataFrame:
    return silver.select("event_date", "archive_hour").distinct()


def expected_hours(dates: DataFrame) -> DataFrame:
    """The 24 UTC hours of each `event_date`."""
    start = F.col("event_date").cast("timestamp")
    hours = F.sequence(start, start + F.expr("INTERVAL 23 HOURS"), F.expr("INTERVAL 1 HOUR"))
    return dates.select("event_date", F.explode(hours).alias("archive_hour"))


def missing_hours(silver: DataFrame, dates: DataFrame) -> DataFrame:
    """Expected but absent hours of the given dates. An hour counts for a date only when an
    event of that date came from that hour's archive."""
    return expected_hours(dates).join(
        _present_hours(silver), ["event_date", "archive_hour"], "left_anti"
    )


def complete_archive_hours(silver: DataFrame, dates: DataFrame) -> DataFrame:
    """Hour coverage by date: counts, the missing hours as text, and the verdict."""
    missing = missing_hours(silver, dates).select(
        "event_date", utc_text(F.col("archive_hour")).alias("hour")
    )
    # At most 24 values per date, so the list is bounded.
    listed = missing.groupBy("event_date").agg(F.sort_array(F.collect_list("hour")).alias("hours"))
    hours = F.coalesce("hours", F.array().cast("array<string>"))
    absent = F.size(hours).cast("bigint")
    return dates.join(listed, "event_date", "left").select(
        "event_date",
        F.lit(24).cast("bigint").alias("expected_hour_count"),
        (F.lit(24) - absent).alias("present_hour_count"),
        absent.alias("missing_hour_count"),
        hours.alias("missing_hours"),
        (absent == 0).alias("passed"),
    )


def unique_gold_keys(gold: DataFrame) -> DataFrame:
    """Row count and number of keys that occur more than once."""
    keys = gold.groupBy(*GOLD_KEY).count()
    duplicates = F.count_if(F.col("count") > 1)
    return keys.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("row_count"),
        duplicates.alias("duplicate_key_count"),
        (duplicates == 0).alias("passed"),
    )


def negative_metrics() -> Column:
    return F.least(*METRICS) < 0


def invalid_metrics() -> Column:
    """Negative counters, or counters that cannot hold together. Commits have no upper bound."""
    return (
        negative_metrics()
        | (F.col("unique_actor_count") > F.col("event_count"))
        | (F.col("merged_pull_request_count") > F.col("pull_request_count"))
        | (F.greatest(*SUBTYPES) > F.col("event_count"))
    )


def valid_gold_metrics(gold: DataFrame) -> DataFrame:
    """Row count and number of rows with invalid metrics."""
    invalid = F.count_if(invalid_metrics())
    return gold.agg(
        F.count(F.lit(1)).alias("row_count"),
        invalid.alias("invalid_row_count"),
        (invalid == 0).alias("passed"),
    )
