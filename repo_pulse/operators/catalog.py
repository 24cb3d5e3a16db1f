"""The technology catalog: loading, validation, the repository index, classification."""

from __future__ import annotations

import tomllib
from collections.abc import Iterable, Mapping
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repo_pulse.functions.text import normalize

# The tracked technologies (id, name, category, repositories).
DEFAULT_TECHNOLOGIES = (
    ("apache-airflow", "Apache Airflow", "orchestration", ["apache/airflow"]),
    ("dagster", "Dagster", "orchestration", ["dagster-io/dagster"]),
    ("dbt-core", "dbt Core", "transformation", ["dbt-labs/dbt-core"]),
    ("apache-spark", "Apache Spark", "processing", ["apache/spark"]),
    ("apache-flink", "Apache Flink", "stream-processing", ["apache/flink"]),
    ("apache-kafka", "Apache Kafka", "streaming", ["apache/kafka"]),
    ("apache-iceberg", "Apache Iceberg", "table-format", ["apache/iceberg"]),
    ("delta-lake", "Delta Lake", "table-format", ["delta-io/delta"]),
    ("trino", "Trino", "query-engine", ["trinodb/trino"]),
    ("duckdb", "DuckDB", "query-engine", ["duckdb/duckdb"]),
    ("airbyte", "Airbyte", "ingestion", ["airbytehq/airbyte"]),
    (
        "great-expectations",
        "Great Expectations",
        "data-quality",
        ["great-expectations/great_expectations"],
    ),
)

# Broken rules named in a message, which counts them all.
SHOWN = 20

_COLUMNS = ("technology_id", "name", "category", "repositories")
_CATALOG = pa.schema(
    [(name, pa.string()) for name in _COLUMNS[:3]] + [("repositories", pa.list_(pa.string()))]
)


def create(spark: SparkSession, technologies: Iterable[tuple]) -> DataFrame:
    """A catalog DataFrame from configuration tuples, ids and repositories normalized.

    Built as a local relation, so the optimizer knows its exact size. A catalog that breaks a
    rule raises.
    """
    return validate(_made(spark, technologies))


def default(spark: SparkSession) -> DataFrame:
    """The built-in catalog, which a test validates."""
    return _made(spark, DEFAULT_TECHNOLOGIES)


def _made(spark: SparkSession, technologies: Iterable[tuple]) -> DataFrame:
    rows = [dict(zip(_COLUMNS, technology, strict=True)) for technology in technologies]
    return normalized(spark.createDataFrame(pa.Table.from_pylist(rows, schema=_CATALOG)))


def load(spark: SparkSession, path: str) -> DataFrame:
    """A catalog from a TOML file with a `technologies` table array; invalid ones raise.

    The file is read by Spark, so any store that holds the tables can hold it.
    """
    text = spark.read.text(path, wholetext=True).first()
    entries: list[Mapping] = tomllib.loads(text.value if text else "")["technologies"]
    return create(
        spark, [(e["id"], e["name"], e["category"], e["repositories"]) for e in entries]
    )


def normalized(catalog: DataFrame) -> DataFrame:
    return catalog.select(
        normalize(F.col("technology_id")).alias("technology_id"),
        "name",
        "category",
        F.transform("repositories", normalize).alias("repositories"),
    )


def assignments(catalog: DataFrame) -> DataFrame:
    """One row per technology and repository it lists."""
    return catalog.select("technology_id", F.explode("repositories").alias("repository"))


def violations(catalog: DataFrame) -> DataFrame:
    """Every broken rule of a normalized catalog: `rule, subject, message`."""
    listed = assignments(catalog)

    def repeated(rows: DataFrame, key: str) -> DataFrame:
        return rows.groupBy(F.col(key).alias("subject")).count().where("count > 1")

    def rule(rows: DataFrame, name: str, before: str, after: str) -> DataFrame:
        message = F.concat(F.lit(f"{before} '"), F.col("subject"), F.lit(f"' {after}"))
        return rows.select(F.lit(name).alias("rule"), "subject", message.alias("message"))

    malformed = listed.where(~F.col("repository").rlike(r"\A[^/]+/[^/]+\z")).select(
        F.col("repository").alias("subject")
    )
    return reduce(
        DataFrame.unionByName,
        [
            rule(
                repeated(catalog, "technology_id"),
                "duplicate_id",
                "technology id",
                "is duplicated",
            ),
            rule(
                malformed.distinct(),
                "repository_format",
                "repository",
                "must have 'owner/name' format",
            ),
            rule(
                repeated(listed, "repository"),
                "duplicate_repository",
                "repository",
                "is assigned to multiple technologies",
            ),
        ],
    )


def validate(catalog: DataFrame) -> DataFrame:
    """The same catalog, or ValueError naming the first broken rules and how many there are;
    `violations` lists them all."""
    broken = violations(catalog)
    total = broken.count()
    if total:
        found = broken.orderBy("rule", "subject").limit(SHOWN).collect()
        more = [f"{total} broken rules in all"] if total > SHOWN else []
        raise ValueError("; ".join([row.message for row in found] + more))
    return catalog


def index(catalog: DataFrame) -> DataFrame:
    """The lookup side: `repository, technology_id`, one row per repository.

    `create` and `load` refuse a catalog that lists a repository twice; a catalog made in another
    way must pass `validate` first, or its events would be counted twice. The index is not made
    unique here: an aggregation under the join would keep AQE from splitting a hot repository.
    """
    return assignments(catalog).select("repository", "technology_id")


def classify(events: DataFrame, repository_index: DataFrame) -> DataFrame:
    """Tracked events with their `technology_id`; events of other repositories drop out.

    No broadcast hint: the optimizer broadcasts the index while its size is under
    `spark.sql.autoBroadcastJoinThreshold` (a configured catalog is a local relation of known
    size) and otherwise shuffles by repository, where AQE splits a hot repository.
    """
    # Never null, or the join would have the optimizer filter on the expression as well, which
    # works it out twice per event. No repository has an empty name.
    name = F.coalesce(normalize(F.col("repo_name")), F.lit(""))
    keyed = events.withColumn("repository", name)
    return keyed.join(repository_index, "repository").drop("repository")
