"""Partitioned Parquet tables for the three layers, and the ledger that says what is in them.

Rows are written by load: Bronze under the id of its load, Silver under load and event date, Gold
under the id of its build. How many archives share a task or a file does not matter: a row keeps the
id it had in its load, the ledger the first id of each source, and the difference is the line.

What a reader sees is decided by the ledger alone, which gets one file for each load, written last.
A crash before that leaves rows nobody reads; the next load takes the same id and overwrites them.
Nothing that can be read is ever changed, so a reader sees all of a load or nothing of it:

- a source is known by name, modification time and length. A newer version takes the place of an
  older one once it is good: in Bronze the last load that lists a source counts, in Silver the load
  that brings the newer version hides the older one and names its dates as touched;
- a Gold date is shown from the last build that lists it, with or without rows;
- loads are ordered by id, not by clock. One load for each layer may run at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repo_pulse import schema
from repo_pulse.operators.bronze import ERROR
from repo_pulse.session import configure

NULL_IN_REQUIRED = "null in a required column"

# Bad sources named in the message of a failed load, which counts them all; the table has all.
SHOWN = 20

# Sources in one load. Their list is broadcast, so it has a bound: about 200 bytes for each.
# More of them are loaded by several loads, one after the other.
LOAD_SOURCES = 20_000

# Kinds of ledger rows: `load` ends every load, `source` lists a source (Bronze: its first row id
# and version; Silver: the Bronze load it came from, in `parent`), `date` an event date that a
# Silver load touched or a Gold build made (`parent`: the last Silver load it saw), `hidden` a
# source that is not to be read from the load in `parent`. `origin` is the stream batch of a load
# or the catalog of a build.
LEDGER = schema.struct(
    "layer string, load_id bigint, kind string, source_file string?, event_date date?, "
    "row_count bigint, first_row_id bigint?, modified_at timestamp?, length bigint?, "
    "parent bigint?, origin string?, committed_at timestamp"
)

# The sources of a load, listed before it begins.
MANIFEST = schema.struct(
    "source_file string, archive_date date?, archive_hour bigint?, modified_at timestamp?, "
    "length bigint?, parent bigint?, first_row_id bigint?, row_count bigint?, "
    "layer string, load_id bigint"
)

# A row for each version of a source that a load left out.
REJECTS = schema.struct(
    "layer string, load_id bigint, source_file string, modified_at timestamp?, length bigint?, "
    "parent bigint?, reason string, first_error_line bigint?, error_count bigint, "
    "seen_at timestamp"
)
VERSION = ["source_file", "modified_at", "length"]

ROW_ID = "row_id"
LINE = "source_line_number"

BRONZE_STORED = T.StructType(
    [f for f in schema.BRONZE if f.name != LINE]
    + [T.StructField(ROW_ID, T.LongType(), False), T.StructField(ERROR, T.StringType())]
)
SILVER_STORED = T.StructType([*schema.SILVER, T.StructField(ERROR, T.StringType())])


class LoadError(ValueError):
    """Some sources of a load hold rows that break the contract; the others are committed."""


def in_list(column: str, values: Iterable) -> Column:
    """Membership in a list of names or dates a caller gave, as one parsed expression that prunes
    partitions."""
    literals = []
    for value in values:
        text = str(value).replace("\\", "\\\\").replace("'", "\\'")
        literals.append(f"DATE'{text}'" if isinstance(value, date) else f"'{text}'")
    return F.expr(f"{column} IN ({', '.join(literals)})") if literals else F.lit(False)


class Lakehouse:
    """The tables under one root folder, which every executor must reach."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self.bronze = f"{prefix}bronze.gharchive_events"
        self.silver = f"{prefix}silver.github_events"
        self.gold = f"{prefix}gold.daily_technology_activity"
        self.actors = f"{prefix}gold.daily_technology_actors"
        self.ledger = f"{prefix}ops.source_commits"
        self.manifests = f"{prefix}ops.load_sources"
        self.rejected = f"{prefix}ops.source_rejects"
        self.tables = {
            self.bronze: (BRONZE_STORED, ["load_id"]),
            self.silver: (SILVER_STORED, ["load_id", "event_date"]),
            self.gold: (schema.GOLD, ["build_id"]),
            self.actors: (schema.ACTORS, ["build_id"]),
            self.ledger: (LEDGER, []),
            self.manifests: (MANIFEST, ["layer", "load_id"]),
            self.rejected: (REJECTS, []),
        }
        self.ensure()

    # -- tables -------------------------------------------------------------------------

    def ensure(self) -> None:
        """Create or open the tables; opening finds partitions already in the folders."""
        for table, (columns, partitions) in self.tables.items():
            known = {f.name for f in columns}
            ids = [T.StructField(p, T.LongType()) for p in partitions if p not in known]
            self._ensure(table, T.StructType([*columns, *ids]), partitions)

    def _ensure(self, table: str, columns: T.StructType, partitions: Sequence[str]) -> None:
        database, name = table.split(".")
        folder = f"{self.root}/{database}"
        if self.spark.catalog.tableExists(table):
            self._require_same(table, f"{folder}/{name}", columns, partitions)
            return
        listed = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns)
        parts = f"PARTITIONED BY ({', '.join(partitions)}) " if partitions else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder}'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({listed}) USING parquet "
            f"OPTIONS (compression 'zstd') {parts}LOCATION '{folder}/{name}'"
        )
        # An append of nothing creates the folder, which the recovery lists.
        self.spark.sql(f"INSERT INTO {table} SELECT * FROM {table} WHERE false")
        if partitions:
            self.spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")

    def _require_same(
        self, table: str, folder: str, columns: T.StructType, partitions: Sequence[str]
    ) -> None:
        """An open table must lie under this root and have the columns and partitions asked for."""
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
        location = next(r.data_type for r in described if r.col_name == "Location")
        if _bare(location) != _bare(folder):
            raise ValueError(f"table {table} lies at {location}, not at {folder}")
        found = {c.name: (c.dataType, c.isPartition) for c in self.spark.catalog.listColumns(table)}
        wanted = {f.name: (f.dataType.simpleString(), f.name in partitions) for f in columns}
        if found != wanted:
            raise ValueError(f"table {table} has other columns or partitions than asked for")

    def drop(self) -> None:
        """Forget the tables; the files stay."""
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")

    def _overwrite(self, rows: DataFrame, table: str, **fixed: str | int) -> None:
        """Put the rows in place of whatever the partitions of these fixed values hold."""
        partitions = self.tables[table][1]
        columns = [c for c in self.spark.table(table).columns if c not in fixed]
        spec = ", ".join(f"{p} = {fixed[p]!r}" if p in fixed else p for p in partitions)
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION ({spec}) "
            f"SELECT {', '.join(columns)} FROM {{rows}}",
            rows=rows,
        )

    def _write_build(self, rows: DataFrame, table: str, build: int) -> None:
        """Write a build into its folder, in place of what an attempt before it has left. The rows
        may come from the table itself."""
        folder = f"{self.root}/{table.replace('.', '/')}/build_id={build}"
        columns = [f.name for f in self.tables[table][0]]
        rows.select(*columns).write.mode("overwrite").option("compression", "zstd").parquet(folder)
        self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (build_id = {build})")

    def _append(self, rows: DataFrame, table: str) -> None:
        """Add rows as one file, so that they appear at once; only these rows go to one task."""
        columns = self.tables[table][0]
        absent = {f.name: F.lit(None).cast(f.dataType) for f in columns if f.name not in rows.columns}
        full = rows.withColumns(absent) if absent else rows
        full.select(*[f.name for f in columns]).repartition(1).write.insertInto(table)

    # -- ledger -------------------------------------------------------------------------

    def commits(self, layer: str, kind: str = "source") -> DataFrame:
        rows = self.spark.table(self.ledger)
        return rows.where((F.col("layer") == layer) & (F.col("kind") == kind))

    def rejects(self, layer: str | None = None) -> DataFrame:
        """The recorded rejects."""
        rows = self.spark.table(self.rejected)
        return rows if layer is None else rows.where(F.col("layer") == layer)

    def last_load(self, layer: str) -> int:
        return self.commits(layer, "load").agg(F.max("load_id")).first()[0] or 0

    def next_load(self, layer: str) -> int:
        """The id of the next load. One that ended without a commit leaves its id to the next."""
        ids = self.commits(layer, "load").select("load_id")
        tried = self.rejects(layer).select("load_id")
        return (ids.unionByName(tried).agg(F.max("load_id")).first()[0] or 0) + 1

    def is_committed(self, layer: str, origin: str) -> bool:
        """Whether a load of this stream batch has been committed."""
        return not self.commits(layer, "load").where(F.col("origin") == origin).isEmpty()

    def bronze_sources(self) -> DataFrame:
        """The visible version of each Bronze source: the last load that lists it."""
        columns = ["load_id", "first_row_id", "row_count", "modified_at", "length"]
        last = F.max_by(F.struct(*columns), "load_id").alias("last")
        return self.commits("bronze").groupBy("source_file").agg(last).select(
            "source_file", "last.*"
        )

    def pending_archives(self, archives: DataFrame) -> DataFrame:
        """The archives whose version was neither loaded nor rejected."""
        known = self.commits("bronze").select(*VERSION).unionByName(
            self.rejects("bronze").select(*VERSION)
        )
        versions = archives.withColumnRenamed("modificationTime", "modified_at")
        left = versions.join(known, VERSION, "left_anti")
        return left.withColumnRenamed("modified_at", "modificationTime").select(*archives.columns)

    def known_archives(self, archives: DataFrame) -> tuple[int, int]:
        """How many sources there are among the archives, and how many were loaded before."""
        versions = archives.withColumnRenamed("modificationTime", "modified_at").select(*VERSION)
        loaded = self.commits("bronze").select(*VERSION, F.lit(True).alias("loaded")).distinct()
        by_source = versions.join(loaded, VERSION, "left").groupBy("source_file").agg(
            F.count("loaded").alias("loaded")
        )
        return tuple(by_source.agg(F.count(F.lit(1)), F.count_if(F.col("loaded") > 0)).first())

    def pending_silver(self, sources: DataFrame | None = None) -> DataFrame:
        """Visible Bronze sources, all or the given ones, that Silver neither has nor refused, as
        rows of a manifest."""
        done = self.commits("silver").select("source_file", "parent")
        refused = self.rejects("silver").select("source_file", "parent")
        visible = self.bronze_sources().withColumnRenamed("load_id", "parent")
        if sources is not None:
            visible = visible.join(sources.select("source_file"), "source_file", "left_semi")
        return visible.join(done.unionByName(refused), ["source_file", "parent"], "left_anti")

    # -- loads --------------------------------------------------------------------------

    def plan(self, layer: str, load: int, sources: DataFrame) -> int:
        """List the sources of a load, at most LOAD_SOURCES of them; returns how many."""
        columns = [f.name for f in MANIFEST if f.name not in ("layer", "load_id")]
        absent = {c: F.lit(None).cast(MANIFEST[c].dataType) for c in columns}
        rows = sources.withColumns({c: v for c, v in absent.items() if c not in sources.columns})
        rows = rows.orderBy("archive_date", "archive_hour", "source_file").limit(LOAD_SOURCES)
        listed = Observation()
        rows = rows.select(*columns).coalesce(1).observe(listed, F.count(F.lit(1)).alias("sources"))
        self._overwrite(rows, self.manifests, layer=layer, load_id=load)
        return listed.get["sources"]

    def manifest(self, layer: str, load: int) -> DataFrame:
        """The sources of a load. Read by nothing but its partition, so that Spark can use the list
        it broadcasts for a join to skip files as well."""
        rows = self.spark.table(self.manifests)
        return rows.where((F.col("layer") == layer) & (F.col("load_id") == load))

    def broken_neighbours(self, load: int) -> DataFrame:
        """Sources that could not be read and lie in a folder beside sources of a Bronze load: an
        hour may be delivered in several files. Hardly ever any."""
        folder = ["archive_date", "archive_hour"]
        listed = self.manifest("bronze", load)
        broken = self.rejects("bronze").where(F.col("reason").endswith(UNREADABLE.format("")))
        planned = self.spark.table(self.manifests).where("layer = 'bronze'")
        found = planned.join(broken.select("load_id", "source_file"), ["load_id", "source_file"])
        beside = found.join(listed.select(*folder), folder, "left_semi")
        beside = beside.join(listed.select("source_file"), "source_file", "left_anti")
        return beside.select("source_file").distinct()

    def write_load(self, layer: str, load: int, rows: DataFrame) -> tuple[int, int]:
        """Write the rows of a load with their error column, visible to nobody yet; returns rows and
        faulty rows, counted on the way.

        Silver is dealt by event date, in parts of the size Spark advises, so its files do not
        multiply with dates, tasks or archives.
        """
        table = self.bronze if layer == "bronze" else self.silver
        contract = T.StructType([f for f in self.tables[table][0] if f.name != ERROR])
        null_found = F.when(schema.broken(contract), F.lit(NULL_IN_REQUIRED))
        checked = rows.withColumn(ERROR, F.coalesce(ERROR, null_found))
        seen = Observation()
        counted = checked.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(ERROR).isNotNull()).alias("bad")
        )
        if layer == "silver":
            counted = counted.hint("rebalance", "event_date")
        self._overwrite(counted, table, load_id=load)
        found = seen.get
        return found["rows"], found["bad"]

    def commit_bronze(self, load: int, rows: int, origin: str | None = None) -> int:
        """List the clean sources of a written Bronze load; returns the rows that became visible.

        Rows and first ids of the sources come from three narrow columns of the load. Sources with
        an error or without a row are rejected and not listed.
        """
        faulty = F.col(ERROR).isNotNull()
        written = self.spark.table(self.bronze).where(F.col("load_id") == load)
        counted = written.groupBy("source_file").agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(ROW_ID).alias("first"),
            F.max(ROW_ID).alias("last"),
            F.count_if(faulty).alias("errors"),
            F.min(F.when(faulty, F.col(ROW_ID))).alias("error_row"),
        )
        manifest = self.manifest("bronze", load).select(*VERSION)
        found = manifest.join(counted, "source_file", "left").persist()
        try:
            seen = found.agg(
                F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                F.count_if(F.col("last") - F.col("first") + 1 != F.col("rows")).alias("holes"),
                F.count_if(F.col("errors") > 0).alias("bad"),
                F.count_if(F.col("rows").isNull()).alias("empty"),
                F.coalesce(F.sum(F.when(F.col("errors") == 0, F.col("rows"))), F.lit(0)).alias(
                    "clean"
                ),
            ).first()
            if seen.rows != rows or seen.holes:
                raise RuntimeError(f"bronze load {load}: rows of a source are not in one piece")
            if seen.bad:
                self.reject("bronze", load, self._first_errors(written, found))
            if seen.empty:
                self.reject("bronze", load, without_lines(found.where("rows IS NULL"), EMPTY))
            clean = found.where("errors = 0").select(
                *VERSION,
                F.col("rows").alias("row_count"),
                F.col("first").alias("first_row_id"),
                F.lit("source").alias("kind"),
            )
            self._commit("bronze", load, clean, origin)
            return seen.clean
        finally:
            found.unpersist()

    @staticmethod
    def _first_errors(written: DataFrame, found: DataFrame) -> DataFrame:
        """Rejects of the counted sources with errors, each with its first error and line."""
        bad = found.where("errors > 0").select(
            *VERSION, "first", "errors", F.col("error_row").alias(ROW_ID)
        )
        line = F.col(ROW_ID) - F.col("first") + 1
        where = F.concat("source_file", F.lit(":"), line.cast("string"), F.lit(": "))
        return bad.join(written.select("source_file", ROW_ID, ERROR), ["source_file", ROW_ID]).select(
            *VERSION,
            F.concat(where, ERROR).alias("reason"),
            line.alias("first_error_line"),
            F.col("errors").alias("error_count"),
        )

    def commit_silver(self, load: int, rows: int, bad: int, origin: str | None = None) -> int:
        """List the clean sources of a written Silver load; returns the rows that became visible.

        Nothing written is read again unless rows were faulty: every Bronze row gives one Silver
        row, so the counts of the sources are those of Bronze, and the dates are the partitions.
        """
        manifest = self.manifest("silver", load)
        older = self.commits("silver").select("source_file", F.col("load_id").alias("old"))
        loaded = older.select("source_file", F.lit(True).alias("again")).distinct()
        expected, again = manifest.join(loaded, "source_file", "left").agg(
            F.coalesce(F.sum("row_count"), F.lit(0)), F.count("again")
        ).first()
        if rows != expected:
            raise RuntimeError(f"silver load {load}: {rows} rows of {expected} were written")
        written = self.spark.table(self.silver).where(F.col("load_id") == load)
        listed = manifest.select(*VERSION, "parent", "row_count")
        if bad:
            faulty = written.where(F.col(ERROR).isNotNull())
            first = faulty.groupBy("source_file").agg(
                F.count(F.lit(1)).alias("error_count"),
                F.min(F.struct(LINE, ERROR)).alias("first"),
            )
            self.reject(
                "silver",
                load,
                listed.join(first, "source_file").select(
                    *VERSION,
                    "parent",
                    F.col(f"first.{ERROR}").alias("reason"),
                    F.col(f"first.{LINE}").alias("first_error_line"),
                    "error_count",
                ),
            )
        refused = self.rejects("silver").where(F.col("load_id") == load).select("source_file")
        clean = listed.join(refused, "source_file", "left_anti") if bad else listed
        touched = self._partition_dates(load)
        entries = clean.withColumn("kind", F.lit("source"))
        hidden = []
        if bad:
            hidden.append(refused.withColumn("parent", F.lit(load).cast("bigint")))
        if again:
            # Older versions of these sources go out of sight, with all their dates touched.
            replaced = older.join(clean.select("source_file"), "source_file", "left_semi")
            hidden.append(replaced.withColumnRenamed("old", "parent").distinct())
            past = self.spark.table(self.silver).select(
                F.col("load_id").alias("old"), "source_file", "event_date"
            )
            past = past.join(replaced, ["old", "source_file"], "left_semi")
            touched = touched.unionByName(past.select("event_date")).distinct()
        nothing = F.lit(0).cast("bigint")
        more = [(rows_, "hidden") for rows_ in hidden] + [(touched, "date")]
        for found, kind in more:
            found = found.withColumns({"kind": F.lit(kind), "row_count": nothing})
            entries = entries.unionByName(found, allowMissingColumns=True)
        self._commit("silver", load, entries, origin)
        if not bad:
            return expected
        mine = self.commits("silver").where(F.col("load_id") == load)
        return mine.agg(F.sum("row_count")).first()[0] or 0

    def _partition_dates(self, load: int) -> DataFrame:
        """Event dates of a Silver load, from the names of its partitions."""
        parts = self.spark.sql(f"SHOW PARTITIONS {self.silver} PARTITION (load_id = {load})")
        day = F.regexp_extract("partition", r"event_date=(\d{4}-\d{2}-\d{2})", 1)
        return parts.select(day.cast("date").alias("event_date"))

    def _commit(self, layer: str, load: int, entries: DataFrame, origin: str | None) -> None:
        """End a load: its entries and its own row appear at once."""
        nothing = self.spark.range(1).select(
            F.lit("load").alias("kind"), F.lit(0).cast("bigint").alias("row_count")
        )
        rows = entries.unionByName(nothing, allowMissingColumns=True)
        self._append(
            rows.withColumns(
                {
                    "layer": F.lit(layer),
                    "load_id": F.lit(load).cast("bigint"),
                    "origin": F.lit(origin).cast("string"),
                    "committed_at": F.current_timestamp(),
                }
            ),
            self.ledger,
        )

    def reject(self, layer: str, load: int, found: DataFrame) -> None:
        """Record versions of sources that a load leaves out."""
        self._append(
            found.withColumns(
                {
                    "layer": F.lit(layer),
                    "load_id": F.lit(load).cast("bigint"),
                    "seen_at": F.current_timestamp(),
                }
            ),
            self.rejected,
        )

    def open_rejects(self, layer: str) -> DataFrame:
        """The last rejected version of each source that no later load of the layer lists."""
        columns = [c for c in self.rejects().columns if c not in ("layer", "source_file")]
        last = F.max_by(F.struct(*columns), "load_id").alias("last")
        latest = self.rejects(layer).groupBy("source_file").agg(last).select(
            F.lit(layer).alias("layer"), "source_file", "last.*"
        )
        later = self.commits(layer).select("source_file", F.col("load_id").alias("later"))
        again = (latest.source_file == later.source_file) & (later.later > latest.load_id)
        return latest.join(later, again, "left_anti")

    def rejected_of(self, versions: DataFrame) -> DataFrame:
        """What was recorded of these versions of sources, in any layer."""
        return self.rejects().join(versions.select(*VERSION), VERSION, "left_semi")

    def require_none(self, found: DataFrame) -> None:
        """Raise LoadError when there are such rejects."""
        total = found.count()
        if total:
            raise LoadError(self._describe(found, total))

    def _describe(self, rejected: DataFrame, total: int) -> str:
        """The first error of the first bad sources, how many there are, and where all are."""
        rows = rejected.orderBy("source_file", "layer").limit(SHOWN).collect()
        said = [
            f"{r.reason} ({r.error_count} errors)" if r.first_error_line else r.reason
            for r in rows
        ]
        if total > SHOWN:
            said.append(f"{total} sources in all")
        return "; ".join(said) + f"; see {self.rejected}"

    # -- reads --------------------------------------------------------------------------

    def read_bronze(self, sources: Sequence[str] | None = None) -> DataFrame:
        """Visible Bronze rows, of the given sources or all; only their loads are read."""
        visible = self.bronze_sources()
        if sources is not None:
            visible = visible.where(in_list("source_file", sources))
        return self._lines(visible.select("load_id", "source_file", "first_row_id"))

    def read_planned(self, load: int) -> DataFrame:
        """The Bronze rows a Silver load is to type. Its list is short enough to be broadcast."""
        listed = self.manifest("silver", load).select(
            F.col("parent").alias("load_id"), "source_file", "first_row_id"
        )
        return self._lines(F.broadcast(listed))

    def _lines(self, listed: DataFrame) -> DataFrame:
        rows = self.spark.table(self.bronze).join(listed, ["load_id", "source_file"])
        line = (F.col(ROW_ID) - F.col("first_row_id") + 1).alias(LINE)
        return rows.select(*[line if c == LINE else c for c in schema.BRONZE.names])

    def read_silver(
        self, dates: Sequence[date] | None = None, upto: int | None = None
    ) -> DataFrame:
        """Visible Silver rows, of the given event dates or all, as they are now or were after a
        load.

        Rows are hidden by exception: the lists joined hold loads, and sources that were refused
        or replaced, not every source there ever was.
        """
        rows = self.spark.table(self.silver)
        loads = self.commits("silver", "load").select("load_id")
        hidden = self.commits("silver", "hidden")
        if dates is not None:
            rows = rows.where(in_list("event_date", dates))
        if upto is not None:
            loads = loads.where(F.col("load_id") <= upto)
            hidden = hidden.where(F.col("load_id") <= upto)
        hidden = hidden.select(F.col("parent").alias("load_id"), "source_file")
        visible = rows.join(loads, "load_id", "left_semi")
        visible = visible.join(hidden, ["load_id", "source_file"], "left_anti")
        return visible.select(*schema.SILVER.names)

    def read_gold(self, dates: Sequence[date] | None = None) -> DataFrame:
        return self._built(self.gold, dates).select(*schema.GOLD.names)

    def read_actors(self, dates: Sequence[date] | None = None) -> DataFrame:
        """Bitmaps of the actors of each technology and day, see `gold.actor_bitmaps`."""
        return self._built(self.actors, dates).select(*schema.ACTORS.names)

    def _built(self, table: str, dates: Sequence[date] | None) -> DataFrame:
        """Rows of the last build of each date."""
        rows, built = self.spark.table(table), self.commits("gold", "date")
        if dates is not None:
            rows = rows.where(in_list("activity_date", dates))
            built = built.where(in_list("event_date", dates))
        last = built.groupBy(F.col("event_date").alias("activity_date")).agg(
            F.max("load_id").alias("build_id")
        )
        return rows.join(last, ["build_id", "activity_date"], "left_semi")

    # -- Gold ---------------------------------------------------------------------------

    def replace_dates(
        self,
        rows: DataFrame,
        dates: Sequence[date],
        catalog: str = "",
        seen: int = 0,
        actors: DataFrame | None = None,
    ) -> int:
        """Replace whole Gold dates. Rows of another date are refused before anything is
        written; a requested date without rows ends up empty. Returns the rows written.

        The rows are written as a build of their own; one append to the ledger then points all the
        dates to it, so a reader finds the old rows or the new ones. The ledger notes the catalog
        and the last Silver load `seen`. Gold has a row per technology and day, so the batch is
        small enough to keep.
        """
        kept = schema.enforce(rows, schema.GOLD).persist()
        try:
            counts = dict(kept.groupBy("activity_date").count().collect())
            if set(counts) - set(dates):
                wanted = ", ".join(day.isoformat() for day in sorted(dates))
                raise ValueError(f"all Gold rows must match activity_date={wanted}")
            if not dates:
                return 0
            build = self.next_load("gold")
            self._write_build(kept, self.gold, build)
            if actors is not None:
                self._write_build(actors, self.actors, build)
            days = sorted(set(dates))
            pointers = pa.table(
                {
                    "event_date": pa.array(days, pa.date32()),
                    "row_count": pa.array([counts.get(day, 0) for day in days], pa.int64()),
                }
            )
            pointers = self.spark.createDataFrame(pointers).withColumns(
                {"parent": F.lit(seen).cast("bigint"), "kind": F.lit("date")}
            )
            self._commit("gold", build, pointers, catalog)
            return sum(counts.values())
        finally:
            kept.unpersist()

    def dates_frame(self, dates: Sequence[date]) -> DataFrame:
        days = pa.table({"event_date": pa.array(sorted(set(dates)), pa.date32())})
        return self.spark.createDataFrame(days)

    def stale_dates(self, catalog: str, dates: Sequence[date] | None = None) -> list[date]:
        """The dates, all or of the given ones, whose last build used another catalog or did not see
        their last Silver load, or that were never built."""
        last = F.max_by(F.struct("parent", "origin"), "load_id").alias("last")
        built = self.commits("gold", "date").groupBy("event_date").agg(last)
        changed = self.commits("silver", "date").groupBy("event_date").agg(
            F.max("load_id").alias("changed")
        )
        asked = changed.select("event_date") if dates is None else self.dates_frame(dates)
        joined = asked.join(built, "event_date", "left").join(changed, "event_date", "left")
        fresh = (F.col("last.origin") == catalog) & (
            F.col("changed").isNull() | (F.col("changed") <= F.col("last.parent"))
        )
        found = joined.where(~F.coalesce(fresh, F.lit(False))).select("event_date").collect()
        return sorted(row.event_date for row in found)


# What is said of a source without a row for a line.
EMPTY = "Bronze source file not found: {}"
UNREADABLE = "{}: cannot be read"


def without_lines(sources: DataFrame, text: str) -> DataFrame:
    """Rejects of versions of sources that have no line to blame."""
    before, after = text.split("{}")
    return sources.select(
        *VERSION,
        F.concat(F.lit(before), F.col("source_file"), F.lit(after)).alias("reason"),
        F.lit(1).cast("bigint").alias("error_count"),
    )


def _bare(path: str) -> str:
    """A path without its scheme's spelling and slashes at the end."""
    return re.sub(r"^file:/+", "/", path).rstrip("/")


def sources_frame(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Distinct source names a caller gave, as a relation."""
    distinct = list(dict.fromkeys(names))
    return spark.createDataFrame(pa.table({"source_file": pa.array(distinct, pa.string())}))
