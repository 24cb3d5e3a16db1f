"""Dashboard queries over Gold. Each takes an optional list of technologies; none means all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repo_pulse.operators import catalog
from repo_pulse.schema import METRICS

EVENT_MIX = (
    "fork_count",
    "issue_count",
    "pull_request_count",
    "push_count",
    "release_count",
    "star_count",
)


def filtered(gold: DataFrame, technologies: Sequence[str] | None) -> DataFrame:
    """The shared filter of every view."""
    if technologies is None:
        return gold
    return gold.where(F.col("technology_id").isin(*technologies))


def activity_trend(gold: DataFrame, technologies: Sequence[str] | None = None) -> DataFrame:
    """Events by day and technology."""
    return (
        filtered(gold, technologies)
        .groupBy("activity_date", "technology_id")
        .agg(F.sum("event_count").alias("event_count"))
    )


def event_mix(gold: DataFrame, technologies: Sequence[str] | None = None) -> DataFrame:
    """Six counters by day, one row per counter. Summed by day first, then unpivoted, so six
    times fewer rows are aggregated."""
    by_day = (
        filtered(gold, technologies)
        .groupBy("activity_date")
        .agg(*[F.sum(name).alias(name) for name in EVENT_MIX])
    )
    return by_day.unpivot("activity_date", list(EVENT_MIX), "measure", "event_count")


def technology_ranking(gold: DataFrame, technologies: Sequence[str] | None = None) -> DataFrame:
    """Technologies by total events, largest first, ties by id."""
    return technology_totals(gold, technologies).select("technology_id", "event_count").orderBy(
        F.desc("event_count"), "technology_id"
    )


def technology_totals(gold: DataFrame, technologies: Sequence[str] | None = None) -> DataFrame:
    """Every measure summed by technology, the default of each measure. The summed unique
    actors count an actor once per day; `distinct_actors` counts an actor once."""
    return (
        filtered(gold, technologies)
        .groupBy("technology_id")
        .agg(*[F.sum(name).alias(name) for name in METRICS])
    )


def distinct_actors(silver: DataFrame, repository_index: DataFrame) -> DataFrame:
    """Actors by technology over all days, from Silver."""
    return (
        catalog.classify(silver, repository_index)
        .groupBy("technology_id")
        .agg(F.count_distinct("actor_id").alias("actor_count"))
    )


def distinct_actors_range(actors: DataFrame) -> DataFrame:
    """Exact number of different actors of each technology over all dates of the given bitmaps (see
    `gold.actor_bitmaps`): no event is read, and bitmaps are merged before the shuffle."""
    merged = actors.groupBy("technology_id", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("actors")).alias("actor_count")
    )
    return merged.groupBy("technology_id").agg(F.sum("actor_count").alias("actor_count"))
