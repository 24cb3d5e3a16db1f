"""The registered queries: each takes a session and a folder of tables and returns a DataFrame.

Instants are returned without a zone, so that both engines print the same value.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repo_pulse import submit
from repo_pulse.functions.instants import utc_text
from repo_pulse.operators import bronze, catalog, gold, quality, reports, silver
from repo_pulse.plans import jobs
from repo_pulse.schema import GOLD, METRICS
from repo_pulse.session import scratch_dir
from repo_pulse.sources import archive, serving
from repo_pulse.sources.lakehouse import Lakehouse
from repo_pulse.streaming import incremental
from repo_pulse.workload import derived

Query = Callable[[SparkSession, str], DataFrame]


def _plain(df: DataFrame) -> DataFrame:
    """Instants as wall-clock UTC without a zone."""
    zoned = [f.name for f in df.schema if f.dataType.simpleString() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def _index(spark: SparkSession) -> DataFrame:
    return catalog.index(catalog.default(spark))


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_activity(derived.silver(spark, sf_dir), _index(spark))


def _new_lake(spark: SparkSession, purpose: str) -> Lakehouse:
    root = scratch_dir(spark, purpose)
    return Lakehouse(spark, root, f"{purpose}_{root[-12:]}_")


# -- archives ---------------------------------------------------------------------------


def archive_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("ts")
    bounds = derived.table(spark, sf_dir, "events").agg(
        F.min(day).alias("first"), F.max(day).alias("last")
    )
    return _plain(archive.hours_between(bounds))


def archive_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = derived.events(spark, sf_dir).select(F.col("archive_hour").alias("hour")).distinct()
    return _plain(archive.coordinates(hours))


def hour_normalization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's hour spelled in one of six ways: UTC, with an offset, without one, not on the
    hour, without hyphens and colons, and by the week."""
    rows = derived.events(spark, sf_dir).select("event_number", "archive_hour")
    hour = F.col("archive_hour")
    at = lambda value, tail: F.concat(
        F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(tail)
    )
    number = F.col("event_number") % 6
    week = F.concat(
        F.extract(F.lit("YEAROFWEEK"), hour).cast("string"),
        F.lit("-W"),
        F.lpad(F.weekofyear(hour).cast("string"), 2, "0"),
        F.lit("-"),
        (F.weekday(hour) + 1).cast("string"),
        F.date_format(hour, "'T'HH'Z'"),
    )
    spelling = (
        F.when(number == 0, at(hour, "Z"))
        .when(number == 1, at(F.timestamp_add("MINUTE", F.lit(150), hour), "+02:30"))
        .when(number == 2, at(hour, ""))
        .when(number == 3, at(F.timestamp_add("MINUTE", F.lit(30), hour), "+00:00"))
        .when(number == 4, F.date_format(hour, "yyyyMMdd'T'HHmmss'Z'"))
        .otherwise(week)
    )
    spelled = rows.select("event_number", spelling.alias("hour_text"))
    return _plain(archive.normalize_hour(spelled))


def archive_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing of every hour from the day before the first event to the day after the last."""
    first, last = derived.date_bounds(spark, sf_dir)
    expected = archive.hours(spark, first - timedelta(days=1), last + timedelta(days=1))
    landed = archive.inventory(spark, derived.raw_zone(spark, sf_dir))
    return _plain(archive.landing(landed, expected).drop("byte_count"))


def bronze_archive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers of real gzip archives."""
    lines = archive.read_archives(spark, derived.raw_zone(spark, sf_dir))
    return _plain(
        lines.select(
            "archive_hour",
            "source_line_number",
            F.get_json_object("value", "$.id").alias("event_id"),
        )
    )


# -- Bronze and Silver ------------------------------------------------------------------


def bronze_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = bronze.parse_events(derived.lines(spark, sf_dir, malformed=True))
    return _plain(parsed.withColumnRenamed(bronze.ERROR, "error"))


def bronze_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.rejects(bronze.parse_events(derived.lines(spark, sf_dir, malformed=True)))


def bronze_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is said of every line when each has another fault, or none."""
    parsed = bronze.parse_events(derived.faulty_lines(spark, sf_dir))
    return parsed.select("source_line_number", F.col(bronze.ERROR).alias("error"))


def bronze_payload_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document carried through a raw line as a payload member, whole."""
    documents = derived.table(spark, sf_dir, "documents")
    line = F.to_json(
        F.struct(
            F.col("doc_id").cast("string").alias("id"),
            F.lit("PublicEvent").alias("type"),
            F.lit("2024-01-01T00:00:00Z").alias("created_at"),
            F.lit(True).alias("public"),
            F.struct(F.col("doc_id").alias("id"), F.col("source").alias("login")).alias("actor"),
            F.struct(F.col("doc_id").alias("id"), F.col("lang").alias("name")).alias("repo"),
            F.struct(F.col("text").alias("message"), F.col("n_chars")).alias("payload"),
        )
    )
    lines = documents.select(
        line.alias("value"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("archive_hour"),
        F.lit("documents").alias("source_file"),
        (F.col("doc_id") + 1).alias("source_line_number"),
    )
    parsed = bronze.parse_events(lines)
    message = F.get_json_object("payload_json", "$.message")
    return parsed.select(
        "event_id",
        F.col("repo_name").alias("lang"),
        F.md5(message).alias("text_md5"),
        F.get_json_object("payload_json", "$.n_chars").cast("bigint").alias("n_chars"),
        F.col(bronze.ERROR).alias("error"),
    )


def bronze_event_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every given event carried through a raw line whole: its JSON, value and type come back
    out of the payload."""
    given = derived.table(spark, sf_dir, "events")
    number = F.col("event_id")
    at = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    start = F.to_json(
        F.struct(
            number.cast("string").alias("id"),
            F.col("event_type").alias("type"),
            at.alias("created_at"),
            F.lit(True).alias("public"),
            F.struct(F.col("user_id").alias("id"), F.lit("user").alias("login")).alias("actor"),
            F.struct(number.alias("id"), F.lit("a/b").alias("name")).alias("repo"),
        )
    )
    value = F.to_json(F.struct(F.col("value")))
    line = F.concat(
        F.expr("left(start, length(start) - 1)"),
        F.lit(', "payload": {"props": '),
        F.coalesce("props", F.lit("null")),
        F.lit(', "given": '),
        value,
        F.lit("}}"),
    )
    lines = given.withColumn("start", start).select(
        line.alias("value"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("archive_hour"),
        F.lit("events").alias("source_file"),
        (number + 1).alias("source_line_number"),
    )
    parsed = bronze.parse_events(lines)
    payload = F.col("payload_json")
    return _plain(
        parsed.select(
            "event_id",
            "event_type",
            "created_at",
            "actor_id",
            F.get_json_object(payload, "$.props.k").cast("bigint").alias("k"),
            F.round(F.get_json_object(payload, "$.given.value").cast("double"), 6).alias("value"),
            F.col(bronze.ERROR).alias("error"),
        )
    )


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = bronze.parse_events(derived.lines(spark, sf_dir, malformed=True))
    return silver.to_silver(parsed.where(F.col(bronze.ERROR).isNull()))


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_typed(spark, sf_dir).withColumnRenamed(bronze.ERROR, "error"))


def silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.rejects(_typed(spark, sf_dir))


def silver_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is typed and what is said when each payload has another fault, or none."""
    parsed = bronze.parse_events(derived.faulty_payloads(spark, sf_dir))
    typed = silver.to_silver(parsed.where(F.col(bronze.ERROR).isNull()))
    named = typed.withColumnRenamed(bronze.ERROR, "error")
    return named.select(
        "event_id", "event_type", "action", "commit_count", "is_merged", "error"
    )


# -- catalog ----------------------------------------------------------------------------


def _customer_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog as large as `customer`: one technology per customer with two repositories."""
    key = F.col("c_custkey").cast("string")
    rows = derived.table(spark, sf_dir, "customer").select(
        F.concat(F.lit(" Tech-"), key).alias("technology_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("category"),
        F.array(
            F.concat(F.lit("Org-"), (F.col("c_custkey") % 10).cast("string"), F.lit("/R-"), key),
            F.concat(F.lit("\tmirror/r-"), key, F.lit(" ")),
        ).alias("repositories"),
    )
    return catalog.normalized(rows)


def catalog_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.index(_customer_catalog(spark, sf_dir))


def catalog_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog from `part` that breaks every rule: ids repeat per brand, repositories per
    size, and some repositories are not `owner/name`."""
    rows = derived.table(spark, sf_dir, "part").select(
        F.concat(F.lit("T-"), F.col("p_partkey") - F.col("p_partkey") % 2).alias("technology_id"),
        F.lit("name").alias("name"),
        F.lit("category").alias("category"),
        F.array(
            F.concat(F.lit("Size/"), F.col("p_size").cast("string")),
            F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("bad-"), F.col("p_partkey")))
            .when(F.col("p_size") % 5 == 1, F.concat(F.lit("a/b/"), F.col("p_partkey")))
            .otherwise(F.concat(F.lit("part/"), F.col("p_partkey"))),
        ).alias("repositories"),
    )
    return catalog.violations(catalog.normalized(rows))


def classify_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracked = catalog.classify(derived.silver(spark, sf_dir), _index(spark))
    return tracked.select("event_id", "repo_name", "technology_id")


def classify_large_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as events of their customer's repository, against the customer catalog."""
    orders = derived.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit(" Mirror/R-"), F.col("o_custkey").cast("string")).alias("repo_name"),
    )
    tracked = catalog.classify(orders, catalog.index(_customer_catalog(spark, sf_dir)))
    return tracked.select("o_orderkey", "technology_id")


# -- Gold -------------------------------------------------------------------------------


def daily_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.in_order(_gold(spark, sf_dir))


def daily_activity_from_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON lines to Gold in one plan."""
    parsed = bronze.parse_events(derived.lines(spark, sf_dir))
    typed = silver.to_silver(parsed.where(F.col(bronze.ERROR).isNull()))
    return gold.daily_activity(typed.where(F.col(bronze.ERROR).isNull()), _index(spark))


def daily_activity_one_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    middle = derived.middle_date(spark, sf_dir)
    events = derived.silver(spark, sf_dir).where(F.col("event_date") == middle)
    return gold.in_order(gold.daily_activity(events, _index(spark)))


# -- tables and jobs --------------------------------------------------------------------

_HISTORY: dict[tuple[str, str], tuple[Lakehouse, str]] = {}


def _history(spark: SparkSession, sf_dir: str) -> tuple[Lakehouse, str]:
    """A lakehouse filled in two backfills, once per application: up to the middle date, then
    the rest, then the middle date again for the events that were delivered late. What there
    was to see after the first backfill is kept in the second element's folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _HISTORY:
        raw = derived.raw_zone(spark, sf_dir)
        first, last = derived.date_bounds(spark, sf_dir)
        middle = derived.middle_date(spark, sf_dir)
        lake, kept = _new_lake(spark, "history"), scratch_dir(spark, "halfway")
        jobs.backfill(lake, raw, first, middle, _index(spark))
        lake.read_gold().write.parquet(f"{kept}/gold")
        pending = lake.pending_archives(archive.inventory(spark, raw))
        pending.select("source_file", "hour").write.parquet(f"{kept}/pending")
        # The last events may be delivered in the first hour of the day after.
        after, end = middle + timedelta(days=1), last + timedelta(days=1)
        jobs.backfill(lake, raw, after, end, _index(spark))
        jobs.build_gold(lake, [middle], _index(spark))
        _HISTORY[key] = (lake, kept)
    return _HISTORY[key]


def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir)[0].read_gold()


def late_event_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The middle date before and after the archives that held its late events."""
    lake, kept = _history(spark, sf_dir)
    middle = derived.middle_date(spark, sf_dir)
    before = spark.read.parquet(f"{kept}/gold").where(F.col("activity_date") == middle)
    after = lake.read_gold([middle])
    return before.select(F.lit("before").alias("stage"), *GOLD.names).unionByName(
        after.select(F.lit("after").alias("stage"), *GOLD.names)
    )


def pending_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives left to load after the first backfill, by hour."""
    pending = spark.read.parquet(f"{_history(spark, sf_dir)[1]}/pending")
    return _plain(pending.groupBy("hour").agg(F.count(F.lit(1)).alias("archive_count")))


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.run_summary(_history(spark, sf_dir)[0])


def blocking_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of the checks over all dates passed and failed."""
    first, last = derived.date_bounds(spark, sf_dir)
    checked = jobs.checks(_history(spark, sf_dir)[0], jobs.date_range(first, last))
    return checked.groupBy("check_name", "passed").agg(F.count(F.lit(1)).alias("check_count"))


def bronze_from_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the Bronze load made of the archives, without the file names Spark chose."""
    return _plain(_history(spark, sf_dir)[0].read_bronze().drop("source_file"))


def silver_from_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the loads made of the archives, without the file names Spark chose."""
    rows = _history(spark, sf_dir)[0].read_silver()
    return _plain(rows.drop("source_file", "source_line_number"))


_DAMAGED: dict[tuple[str, str], Lakehouse] = {}


def _damaged(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """A lakehouse after a backfill over archives of which three are bad."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DAMAGED:
        first, last = derived.date_bounds(spark, sf_dir)
        lake = _new_lake(spark, "damaged")
        raw = derived.damaged_zone(spark, sf_dir)
        end = last + timedelta(days=1)
        jobs.backfill(lake, raw, first, end, _index(spark), mode="quarantine")
        _DAMAGED[key] = lake
    return _DAMAGED[key]


def backfill_with_bad_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of every date from the archives that are not bad."""
    return _damaged(spark, sf_dir).read_gold()


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the backfill recorded, without the file names Spark chose."""
    reason = F.regexp_replace("reason", r"\d{4}-\d{2}-\d{2}-\d+\.json\.gz|part-\S+\.gz", "file")
    reason = F.regexp_replace(reason, r"file:\d+:", "file:line:")
    return _damaged(spark, sf_dir).rejects().select(
        "layer",
        reason.alias("reason"),
        "error_count",
        F.col("first_error_line").isNotNull().alias("has_line"),
    )


def stream_with_bad_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after a stream over archives of which three are bad."""
    raw = derived.damaged_zone(spark, sf_dir)
    lake = _new_lake(spark, "stream_damaged")
    query = incremental.stream_refresh(lake, raw, f"{lake.root}/checkpoint", _index(spark))
    query.awaitTermination()
    return lake.read_gold()


def _with_revisions(spark: SparkSession, sf_dir: str, streamed: bool) -> DataFrame:
    """Gold after a load of older versions of some archives and after the newer ones landed.

    A stream learns of a newer version of an archive only if it left the older one out.
    """
    replaced = [derived.REFUSED_HOUR] if streamed else [derived.REFUSED_HOUR, derived.REVISED_HOUR]
    raw, newer = derived.revised_zone(spark, sf_dir), derived.raw_zone(spark, sf_dir)
    first, last = derived.date_bounds(spark, sf_dir)
    lake = _new_lake(spark, "revised")

    def load() -> DataFrame:
        if streamed:
            incremental.stream_refresh(
                lake, raw, f"{lake.root}/checkpoint", _index(spark)
            ).awaitTermination()
        else:
            end = last + timedelta(days=1)
            jobs.backfill(lake, raw, first, end, _index(spark), mode="quarantine")
        return lake.read_gold()

    before = scratch_dir(spark, "before")
    load().write.parquet(before)
    for hour in replaced:
        derived.replace_archives(spark, raw, newer, derived.first_hour(spark, sf_dir, hour))
    after = load()
    stages = {"before": spark.read.parquet(before), "after": after}
    found = [rows.select(F.lit(s).alias("stage"), *GOLD.names) for s, rows in stages.items()]
    return found[0].unionByName(found[1])


def repaired_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One archive that Silver refused and one that was good, both replaced by newer versions."""
    return _with_revisions(spark, sf_dir, streamed=False)


def stream_repaired_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refused archive through the stream, which goes on from its checkpoint."""
    return _with_revisions(spark, sf_dir, streamed=True)


def distinct_actors_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actors of each technology from the first to the middle date, from bitmaps of the builds."""
    first, _ = derived.date_bounds(spark, sf_dir)
    days = jobs.date_range(first, derived.middle_date(spark, sf_dir))
    return reports.distinct_actors_range(_history(spark, sf_dir)[0].read_actors(days))


def materialized_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What came of running each of three dates as a whole and requiring its checks: the first,
    which may lack hours, the middle one, and the day after the last, which has no full day."""
    first, last = derived.date_bounds(spark, sf_dir)
    raw, lake = derived.raw_zone(spark, sf_dir), _new_lake(spark, "days")
    found = []
    for day in sorted({first, derived.middle_date(spark, sf_dir), last + timedelta(days=1)}):
        try:
            jobs.materialize_day(lake, raw, day, _index(spark))
            outcome = "passed"
        except FileNotFoundError:
            outcome = "hours missing"
        except jobs.QualityError:
            outcome = "checks failed"
        found.append((day, outcome))
    outcomes = spark.createDataFrame(found, "activity_date date, outcome string")
    rows = lake.read_gold().groupBy("activity_date").agg(F.sum("event_count").alias("event_count"))
    return outcomes.join(rows, "activity_date", "left")


def run_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of the middle date after its landed hours from 06:00 to 11:00 were run."""
    middle, raw = derived.middle_date(spark, sf_dir), derived.raw_zone(spark, sf_dir)
    lake = _new_lake(spark, "run_hours")
    landed = archive.inventory(spark, raw, [middle]).select(F.hour("hour").alias("h")).distinct()
    at = sorted(row.h for row in landed.where("h BETWEEN 6 AND 11").collect())
    hours = [datetime(middle.year, middle.month, middle.day, h, tzinfo=UTC) for h in at]
    jobs.run_hours(lake, raw, hours, _index(spark))
    return lake.read_gold()


def replace_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after the first date was replaced by nothing and the last by one technology."""
    first, last = derived.date_bounds(spark, sf_dir)
    lake = _new_lake(spark, "replace")
    lake.replace_dates(_gold(spark, sf_dir), jobs.date_range(first, last))
    lake.replace_dates(lake.read_gold([first]).where(F.lit(False)), [first])
    kept = lake.read_gold([last]).where(F.col("technology_id") == "trino")
    lake.replace_dates(kept, [last])
    return lake.read_gold()


def refused_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after all its rows were offered for the first date alone, and what was said to that."""
    first, last = derived.date_bounds(spark, sf_dir)
    lake, rows = _new_lake(spark, "refused"), _gold(spark, sf_dir)
    lake.replace_dates(rows, jobs.date_range(first, last))
    said = "nothing"
    try:
        lake.replace_dates(rows, [first])
    except ValueError as error:
        said = str(error)
    return lake.read_gold().withColumn("said", F.lit(said))


def command_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after three commands: a backfill of all dates in two parts, and a build of the middle
    date again for its late events."""
    first, last = derived.date_bounds(spark, sf_dir)
    middle, root = derived.middle_date(spark, sf_dir), scratch_dir(spark, "commands")
    prefix = f"commands_{root[-12:]}_"
    given = ["--lake", root, "--prefix", prefix, "--raw", derived.raw_zone(spark, sf_dir)]
    day = timedelta(days=1)
    for command in (
        ["backfill", f"{first}", f"{middle}"],
        ["backfill", f"{middle + day}", f"{last + day}", "--quarantine"],
        ["build-gold", f"{middle}"],
    ):
        submit.run(spark, submit.arguments([*given, *command]))
    return Lakehouse(spark, root, prefix).read_gold()


# -- quality ----------------------------------------------------------------------------


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event date and the day after the last, which has no events."""
    first, last = derived.date_bounds(spark, sf_dir)
    days = archive.hours(spark, first, last + timedelta(days=1))
    return days.select(F.col("activity_date").alias("event_date")).distinct()


def silver_archive_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(quality.archive_hours(derived.silver(spark, sf_dir)))


def missing_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = quality.missing_hours(derived.silver(spark, sf_dir), _asked(spark, sf_dir))
    return missing.select("event_date", utc_text(F.col("archive_hour")).alias("archive_hour"))


def check_complete_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = quality.complete_archive_hours(
        derived.silver(spark, sf_dir), _asked(spark, sf_dir)
    )
    return checked.withColumn("missing_hours", F.array_join("missing_hours", ","))


def check_unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold with the rows of two technologies repeated."""
    rows = _gold(spark, sf_dir)
    repeated = rows.where(F.col("technology_id").isin("trino", "duckdb"))
    return quality.unique_gold_keys(rows.unionByName(repeated))


def check_valid_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold in which every rule is broken in some rows, one rule in a row, and two rows in
    twenty are left as they are."""
    events, requests = F.col("event_count"), F.col("pull_request_count")
    breaks = [(name, F.lit(-1)) for name in METRICS]
    breaks += [("unique_actor_count", events + 1), ("merged_pull_request_count", requests + 1)]
    breaks += [(name, events + 1) for name in quality.SUBTYPES]
    number = (F.dayofyear("activity_date") + 7 * F.length("technology_id")) % 20
    changed = {name: F.col(name) for name, _ in breaks}
    for i, (name, value) in enumerate(breaks):
        changed[name] = F.when(number == i, value).otherwise(changed[name])
    return quality.valid_gold_metrics(_gold(spark, sf_dir).withColumns(changed))


# -- reports ----------------------------------------------------------------------------

_CHOSEN = ["apache-spark", "apache-flink", "duckdb"]


def activity_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.activity_trend(_gold(spark, sf_dir))


def activity_trend_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.activity_trend(_gold(spark, sf_dir), _CHOSEN)


def event_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.event_mix(_gold(spark, sf_dir))


def technology_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.technology_ranking(_gold(spark, sf_dir))


def technology_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.technology_totals(_gold(spark, sf_dir))


def distinct_actors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.distinct_actors(derived.silver(spark, sf_dir), _index(spark))


# -- serving ----------------------------------------------------------------------------


def _published(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, date]:
    """A serving table as it stands (every technology but two, old counters) and new Gold."""
    rows = _gold(spark, sf_dir)
    old = rows.where(~F.col("technology_id").isin("trino", "duckdb"))
    older = old.withColumns({name: F.col(name) + 1000 for name in METRICS})
    return older, rows, derived.middle_date(spark, sf_dir)


def serving_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of the dates from the middle on, upserted."""
    current, rows, middle = _published(spark, sf_dir)
    return serving.upserted(current, rows.where(F.col("activity_date") >= middle))


def serving_replace_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The middle date replaced by a Gold date that lacks one technology."""
    current, rows, middle = _published(spark, sf_dir)
    incoming = rows.where(
        (F.col("activity_date") == middle) & (F.col("technology_id") != "airbyte")
    )
    return serving.dates_replaced(current, incoming, [middle])


# -- streams ----------------------------------------------------------------------------


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows by hour after the stream ran twice over the same archives."""
    raw = derived.raw_zone(spark, sf_dir)
    lake = _new_lake(spark, "stream_bronze")
    for attempt in ("first", "second"):
        # A new checkpoint offers every archive again; the ledger skips them.
        query = incremental.stream_bronze(lake, raw, f"{lake.root}/checkpoint-{attempt}")
        query.awaitTermination()
    rows = lake.read_bronze().groupBy("archive_hour")
    return _plain(
        rows.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.max("source_line_number").alias("last_line"),
            F.count_distinct("event_id").alias("event_count"),
        )
    )


def stream_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after a stream that loads archives in several batches and rebuilds the dates they
    touch, some of them more than once."""
    raw = derived.raw_zone(spark, sf_dir)
    lake = _new_lake(spark, "stream_refresh")
    third = archive.inventory(spark, raw).count() // 3 + 1
    incremental.stream_refresh(
        lake, raw, f"{lake.root}/checkpoint", _index(spark), max_files=third
    ).awaitTermination()
    return lake.read_gold()


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        archive_hours,
        archive_coordinates,
        hour_normalization,
        archive_landing,
        bronze_archive_scan,
        bronze_parse,
        bronze_rejects,
        bronze_faults,
        bronze_payload_text,
        bronze_event_members,
        silver_events,
        silver_rejects,
        silver_faults,
        catalog_index,
        catalog_violations,
        classify_events,
        classify_large_catalog,
        daily_activity,
        daily_activity_from_lines,
        daily_activity_one_date,
        backfill,
        late_event_rebuild,
        pending_sources,
        run_summary,
        blocking_checks,
        bronze_from_archives,
        silver_from_archives,
        backfill_with_bad_sources,
        load_rejects,
        repaired_source,
        stream_repaired_source,
        distinct_actors_range,
        materialized_day,
        stream_with_bad_source,
        run_hours,
        replace_date,
        refused_date,
        command_line,
        silver_archive_hours,
        missing_hours,
        check_complete_hours,
        check_unique_keys,
        check_valid_metrics,
        activity_trend,
        activity_trend_filtered,
        event_mix,
        technology_ranking,
        technology_totals,
        distinct_actors,
        serving_upsert,
        serving_replace_date,
        stream_bronze,
        stream_refresh,
    )
}
