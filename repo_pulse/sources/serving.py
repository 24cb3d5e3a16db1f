"""Publishing Gold to a relational table over JDBC.

Executors write the rows to a staging table with Spark's JDBC writer; then one transaction on
the database moves them into the target. The transaction holds statements only, no rows pass
through the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from contextlib import closing
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repo_pulse.schema import GOLD, GOLD_KEY, METRICS

# Where dashboards look for the table.
SCHEMA = "analytics"
TABLE = "analytics.daily_technology_activity"
# Each run stages under a name of its own that starts with this one.
STAGING = "analytics.daily_technology_activity_staging"

_SQL_TYPES = {"string": "TEXT", "date": "DATE", "bigint": "BIGINT"}
COLUMNS = ", ".join(GOLD.names)


def create_statements(table: str = TABLE) -> list[str]:
    columns = [f"{f.name} {_SQL_TYPES[f.dataType.simpleString()]} NOT NULL" for f in GOLD]
    columns.append("published_at TIMESTAMPTZ NOT NULL DEFAULT CURRENT_TIMESTAMP")
    columns.append(f"PRIMARY KEY ({', '.join(GOLD_KEY)})")
    return [
        f"CREATE SCHEMA IF NOT EXISTS {table.split('.')[0]}",
        f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)})",
    ]


def upsert_statement(table: str = TABLE, staging: str = STAGING) -> str:
    """Insert the staged rows or update those present by key; other rows stay. Distinct, as a
    task that is run twice may stage its rows twice."""
    updates = [f"{name} = EXCLUDED.{name}" for name in METRICS]
    updates.append("published_at = CURRENT_TIMESTAMP")
    return (
        f"INSERT INTO {table} ({COLUMNS}) SELECT DISTINCT {COLUMNS} FROM {staging} WHERE true "
        f"ON CONFLICT ({', '.join(GOLD_KEY)}) DO UPDATE SET {', '.join(updates)}"
    )


def delete_statement(dates: Sequence[date], table: str = TABLE) -> str:
    listed = ", ".join(f"DATE '{day.isoformat()}'" for day in dates)
    return f"DELETE FROM {table} WHERE activity_date IN ({listed})"


def stage(gold: DataFrame, url: str, properties: Mapping[str, str], table: str = STAGING) -> None:
    """Write the rows to the staging table from the executors."""
    gold.select(*GOLD.names).write.mode("overwrite").jdbc(url, table, properties=dict(properties))


def run_transaction(connect: Callable, statements: Sequence[str]) -> None:
    """Run statements on a new DB-API connection: all of them, or none."""
    with closing(connect()) as connection:
        try:
            with closing(connection.cursor()) as cursor:
                for statement in statements:
                    cursor.execute(statement)
            connection.commit()
        except BaseException:
            connection.rollback()
            raise


class JdbcServing:
    """A serving table: the JDBC address executors write to and a way to open a DB-API
    connection to the same database, such as `lambda: psycopg.connect(dsn)`."""

    def __init__(self, url: str, properties: Mapping[str, str], connect: Callable):
        self.url, self.properties, self.connect = url, properties, connect

    def read(self, spark: SparkSession) -> DataFrame:
        """The published rows, as a source for reports."""
        rows = spark.read.jdbc(self.url, TABLE, properties=dict(self.properties))
        return rows.select(*GOLD.names)

    def upsert(self, gold: DataFrame) -> int:
        """Insert or update by key, keeping rows not in the input. Returns rows published."""
        return self._publish(gold, [])

    def replace_dates(self, gold: DataFrame, dates: Sequence[date]) -> int:
        """Replace whole dates in one transaction, so rows no longer in Gold go away."""
        return self._publish(require_dates(gold, dates), [delete_statement(dates)])

    def _publish(self, gold: DataFrame, before: Sequence[str]) -> int:
        """Stage the rows and move them in one transaction, which drops the staging table.

        The staging table belongs to this run, so runs at the same time don't mix their rows.
        """
        rows = require_unique_keys(gold)
        staging = f"{STAGING}_{uuid.uuid4().hex}"
        run_transaction(self.connect, create_statements())
        stage(gold, self.url, self.properties, staging)
        moved = [*before, upsert_statement(staging=staging), f"DROP TABLE {staging}"]
        run_transaction(self.connect, moved)
        return rows


def require_dates(gold: DataFrame, dates: Sequence[date]) -> DataFrame:
    """The same rows, or ValueError when one belongs to another date."""
    listed = ", ".join(day.isoformat() for day in dates)
    if gold.where(~F.col("activity_date").isin(*dates)).limit(1).count():
        raise ValueError(f"all serving rows must match activity_date={listed}")
    return gold


def require_unique_keys(gold: DataFrame) -> int:
    """Row count, or ValueError when a key repeats: an upsert would keep one row unsaid."""
    keys = gold.groupBy(*GOLD_KEY).count()
    total = keys.agg(F.sum("count").alias("rows"), F.max("count").alias("most")).first()
    if (total.most or 0) > 1:
        raise ValueError("serving rows repeat a (technology_id, activity_date) key")
    return total.rows or 0


def upserted(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """The table after an upsert, as a DataFrame: incoming rows, and current rows whose key is
    not among them. For serving tables kept in files."""
    kept = current.join(incoming.select(*GOLD_KEY), list(GOLD_KEY), "left_anti")
    return kept.unionByName(incoming)


def dates_replaced(current: DataFrame, incoming: DataFrame, dates: Sequence[date]) -> DataFrame:
    """The table after replacing whole dates, as a DataFrame."""
    return current.where(~F.col("activity_date").isin(*dates)).unionByName(incoming)
