"""Daily activity of each tracked technology."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repo_pulse.operators import catalog
from repo_pulse.operators.silver import PULL_REQUEST, PUSH
from repo_pulse.schema import ACTORS, GOLD, GOLD_KEY, enforce


def counters() -> list[Column]:
    """The ten metrics over classified Silver events.

    One exact distinct count next to plain counters: Spark pre-aggregates by (key, actor) on
    the map side and shuffles by (key, actor) before it shuffles by key, so a technology or an
    actor holding a third of all events does not end up in one task.
    """
    kind = F.col("event_type")
    push, pull_request = kind == PUSH, kind == PULL_REQUEST
    return [
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("actor_id").alias("unique_actor_count"),
        F.count_if(push).alias("push_count"),
        F.coalesce(F.sum(F.when(push, F.col("commit_count"))), F.lit(0)).alias("commit_count"),
        F.count_if(pull_request).alias("pull_request_count"),
        F.count_if(pull_request & F.col("is_merged").eqNullSafe(True)).alias(
            "merged_pull_request_count"
        ),
        F.count_if(kind == "IssuesEvent").alias("issue_count"),
        F.count_if((kind == "WatchEvent") & (F.col("action") == "started")).alias("star_count"),
        F.count_if(kind == "ForkEvent").alias("fork_count"),
        F.count_if(kind == "ReleaseEvent").alias("release_count"),
    ]


def daily_activity(silver: DataFrame, repository_index: DataFrame) -> DataFrame:
    """One Gold row per technology and UTC date with at least one tracked event.

    Rows are counted as they are: a repeated `event_id` counts twice. Sorting is left to the
    reader (`in_order`), as a sorted aggregate would add a shuffle to every build.
    """
    tracked = catalog.classify(silver, repository_index)
    grouped = tracked.groupBy("technology_id", F.col("event_date").alias("activity_date"))
    return enforce(grouped.agg(*counters()), GOLD)


def actor_bitmaps(silver: DataFrame, repository_index: DataFrame) -> DataFrame:
    """The actors of each technology and date as bitmaps, which add up over any range of dates.

    Every bitmap covers a fixed range of ids, so a group never outgrows it, however many events an
    actor or a technology has; they are filled before the shuffle.
    """
    tracked = catalog.classify(silver, repository_index)
    grouped = tracked.groupBy(
        "technology_id",
        F.col("event_date").alias("activity_date"),
        F.bitmap_bucket_number("actor_id").alias("bucket"),
    )
    position = F.bitmap_bit_position("actor_id")
    return enforce(grouped.agg(F.bitmap_construct_agg(position).alias("actors")), ACTORS)


def in_order(gold: DataFrame) -> DataFrame:
    return gold.orderBy(*GOLD_KEY)
