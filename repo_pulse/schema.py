"""Storage contracts of the three layers. Column order is part of the contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
}


def struct(text: str) -> T.StructType:
    """`name type` pairs separated by commas; a trailing `?` marks a nullable column."""
    fields = []
    for item in text.split(","):
        name, kind = item.split()
        fields.append(T.StructField(name, _TYPES[kind.rstrip("?")], kind.endswith("?")))
    return T.StructType(fields)


BRONZE = struct(
    "event_id string, event_type string, created_at timestamp, is_public boolean,"
    "actor_id bigint, actor_login string, repo_id bigint, repo_name string,"
    "org_id bigint?, org_login string?, payload_json string,"
    "archive_hour timestamp, source_file string, source_line_number bigint"
)

SILVER = struct(
    "event_id string, event_type string, event_date date, created_at timestamp,"
    "actor_id bigint, actor_login string, repo_id bigint, repo_name string,"
    "org_id bigint?, org_login string?, action string?, commit_count bigint?,"
    "is_merged boolean?, archive_hour timestamp, source_file string,"
    "source_line_number bigint"
)

METRICS = (
    "event_count",
    "unique_actor_count",
    "push_count",
    "commit_count",
    "pull_request_count",
    "merged_pull_request_count",
    "issue_count",
    "star_count",
    "fork_count",
    "release_count",
)

GOLD_KEY = ("technology_id", "activity_date")

GOLD = struct(
    "technology_id string, activity_date date," + ",".join(f"{m} bigint" for m in METRICS)
)

# The actors of a technology and day as bitmaps of 32,768 neighbouring ids each.
ACTORS = struct("technology_id string, activity_date date, bucket bigint, actors binary")


def enforce(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Project to the contract's columns, order and types.

    Parquet gives every column back as nullable, so nulls are counted at write time
    (see `broken`), not promised by the reader's schema.
    """
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract])


def broken(contract: T.StructType) -> Column:
    """True for a row with a null in a required column."""
    required = [F.col(f.name).isNull() for f in contract if not f.nullable]
    condition = required[0]
    for item in required[1:]:
        condition = condition | item
    return condition
