"""Code-hosting events derived from the given tables by arithmetic two engines share.

Every row of `events` becomes one event: its type, action and counters come from `event_id`,
its repository, actor and organisation from `user_id`. One event in ten is delivered an hour
late, so some archives hold events of the day before.
"""

from __future__ import annotations

import gzip
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from repo_pulse.schema import SILVER, enforce
from repo_pulse.session import configure, scratch_dir
from repo_pulse.sources import archive

EVENT_TYPES = (
    "PushEvent",
    "PullRequestEvent",
    "IssuesEvent",
    "WatchEvent",
    "ForkEvent",
    "ReleaseEvent",
    "WatchEvent",
    "PublicEvent",
)

# Twelve tracked repositories, some in mixed case or padded, and four that are not tracked.
REPOSITORIES = (
    "apache/airflow",
    "Dagster-IO/dagster",
    " dbt-labs/dbt-core",
    "APACHE/SPARK",
    "apache/flink",
    "apache/kafka ",
    "apache/iceberg",
    "delta-io/Delta",
    "trinodb/trino",
    "duckdb/duckdb",
    " airbytehq/Airbyte ",
    "great-expectations/great_expectations",
    "example/one",
    "example/two",
    "apache/airflow-fork",
    "spark",
)

# Lines per derived archive file; an hour with more is delivered as several files.
LINES_PER_ARCHIVE = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Rows in at least as many partitions as there are cores. A table kept in fewer files
    would leave cores idle while its rows are parsed; a large one is returned as it is."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def events(spark: SparkSession, sf_dir: str, spread_out: bool = False) -> DataFrame:
    """One derived event per row of `events`, as plain columns."""
    number, user = F.col("event_id"), F.col("user_id")
    merged = number % 16 == 1
    kind = number % 8
    action = (
        F.when(kind == 1, F.when(merged, "closed").otherwise("opened"))
        .when(kind == 2, "opened")
        .when(kind == 3, "started")
        .when(kind == 5, "published")
        .when(kind == 6, "subscribed")
    )
    created_at = F.col("ts").cast("timestamp")
    late = F.when(number % 10 == 0, 1).otherwise(0)
    hour = F.timestamp_add("HOUR", late, F.date_trunc("hour", created_at))

    def pick(values: tuple[str, ...], at: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), (at + 1).cast("int"))

    has_org = number % 3 == 0
    base = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    if spread_out:
        base = spread(base)
    return base.select(
        number.alias("event_number"),
        number.cast("string").alias("event_id"),
        pick(EVENT_TYPES, kind).alias("event_type"),
        F.to_date(created_at).alias("event_date"),
        created_at.alias("created_at"),
        user.alias("actor_id"),
        F.concat(F.lit("user-"), user.cast("string")).alias("actor_login"),
        (user % 16).alias("repo_id"),
        pick(REPOSITORIES, user % 16).alias("repo_name"),
        F.when(has_org, user % 7).alias("org_id"),
        F.when(has_org, F.concat(F.lit("org-"), (user % 7).cast("string"))).alias("org_login"),
        action.alias("action"),
        F.when(kind == 0, number % 5).alias("commit_count"),
        F.when(kind == 1, merged).alias("is_merged"),
        hour.alias("archive_hour"),
        archive.file_name(hour).alias("source_file"),
        (number + 1).alias("source_line_number"),
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enforce(events(spark, sf_dir), SILVER)


def date_bounds(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """First and last event date."""
    day = F.to_date("ts")
    return tuple(table(spark, sf_dir, "events").agg(F.min(day), F.max(day)).first())


def middle_date(spark: SparkSession, sf_dir: str) -> date:
    first, last = date_bounds(spark, sf_dir)
    return first + (last - first) // 2


def payload_text() -> Column:
    """Payload as JSON text with spaces, so that compaction has something to do."""
    kind = F.col("event_number") % 8
    action = F.concat(F.lit('{"action": "'), F.col("action"), F.lit('", "note": "é {x}"}'))
    pull_request = F.concat(
        F.lit('{"action": "'),
        F.col("action"),
        F.lit('", "number": '),
        F.col("event_id"),
        F.lit(', "pull_request": {"merged": '),
        F.col("is_merged").cast("string"),
        F.lit(', "body": null}}'),
    )
    push = F.concat(
        F.lit('{"size": '),
        F.col("commit_count").cast("string"),
        F.lit(', "ref": "refs/heads/main"}'),
    )
    return (
        F.when(kind == 0, push)
        .when(kind == 1, pull_request)
        .when(F.col("action").isNotNull(), action)
        .otherwise(F.lit("{ }"))
    )


def lines(spark: SparkSession, sf_dir: str, malformed: bool = False) -> DataFrame:
    """Raw lines of the derived events, with their coordinates.

    With `malformed`, every 97th line writes `id` as a number and every 89th push or pull
    request carries a counter of the wrong type.
    """
    rows = events(spark, sf_dir, spread_out=True)
    quoted = F.concat(F.lit('"'), F.col("event_id"), F.lit('"'))
    number = F.col("event_number")
    event_id, payload = quoted, payload_text()
    if malformed:
        event_id = F.when(number % 97 == 0, F.col("event_id")).otherwise(quoted)
        broken = F.when(F.col("event_type") == "PushEvent", F.lit('{"size":"many"}')).when(
            F.col("event_type") == "PullRequestEvent", F.lit('{"pull_request":{"merged":1}}')
        )
        payload = F.when(number % 89 == 0, F.coalesce(broken, payload)).otherwise(payload)
    org = F.concat(
        F.lit(', "org": {"id": '),
        F.col("org_id").cast("string"),
        F.lit(', "login": "'),
        F.col("org_login"),
        F.lit('"}'),
    )
    text = F.concat(
        F.lit('{"id": '),
        event_id,
        F.lit(', "type": "'),
        F.col("event_type"),
        F.lit('", "created_at": "'),
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        F.lit('Z", "public": true, "actor": {"id": '),
        F.col("actor_id").cast("string"),
        F.lit(', "login": "'),
        F.col("actor_login"),
        F.lit('"}, "repo": {"id": '),
        F.col("repo_id").cast("string"),
        F.lit(', "name": "'),
        F.col("repo_name"),
        F.lit('"}, "payload": '),
        payload,
        F.coalesce(org, F.lit("")),
        F.lit("}"),
    )
    return rows.select(
        text.alias("value"),
        "archive_hour",
        "source_file",
        "source_line_number",
        "event_number",
    )


# One fault in each line, by `event_number`: a pattern and what takes its place. A key that is
# renamed is missing, a member put before or behind another one of the same name is the one that
# counts if it stands last.
BRONZE_FAULTS = (
    (r"\A\z", ""),
    (r'^\{"id": "\d+", ', "{"),
    (r'"type": "\w+"', '"type": null'),
    (r'"type": "\w+"', '"type": ["x"]'),
    (r'("created_at": "[^"]*)Z"', '$1"'),
    (r'"created_at": "[^"]*"', '"created_at": "soon"'),
    (r'"created_at": "[^"]*"', '"created_at": 5'),
    (r'"public": true', '"public": "true"'),
    (r'"actor": ', '"no_actor": '),
    (r'"actor": ', '"actor": null, "was": '),
    (r'("actor": \{"id": \d+)', "$1.5"),
    (r'("actor": \{"id": \d+), "login": "[^"]*"', "$1"),
    (r'"repo": ', '"repo": [1], "was": '),
    (r'"repo": \{"id": (\d+)', '"repo": {"id": "$1"'),
    (r'("repo": \{"id": \d+, "name": )"[^"]*"', '$1{"a": 1}'),
    (r'"payload": ', '"no_payload": '),
    (r'"payload": ', '"payload": "{}", "was": '),
    (r"\}\z", ', "org": 5}'),
    (r"\}\z", ', "org": {}}'),
    (r"\}\z", ', "org": {"id": 1}}'),
    (r"\}\z", ', "org": null}'),
    (r"\}\z", ""),
    (r"\A(.*)\z", "[$1]"),
    (r"\}\z", "} 1"),
)

# Payloads in place of each event's own, by `event_number`; the first is none.
SILVER_FAULTS = (
    "",
    '{"action": 1, "size": 1, "pull_request": {"merged": true}}',
    '{"action": null}',
    '{"size": 1.0, "pull_request": null}',
    '{"size": true, "pull_request": []}',
    '{"size": 3, "pull_request": {}}',
    '{"size": null, "pull_request": {"merged": null}}',
    '{"size": 7, "action": "closed", "pull_request": {"merged": true}}',
    '{"size": "3", "pull_request": {"merged": "true"}}',
)


def _by_number(values: list[Column]) -> Column:
    """The value whose turn it is; only that one is worked out."""
    turn = F.col("event_number") % len(values)
    chosen = F.when(turn == 0, values[0])
    for i, value in enumerate(values[1:], start=1):
        chosen = chosen.when(turn == i, value)
    return chosen


def faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines with every fault a Bronze row can have, one in a line."""
    broken = [F.regexp_replace("value", wrong, by) for wrong, by in BRONZE_FAULTS]
    return lines(spark, sf_dir).withColumn("value", _by_number(broken))


def faulty_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines that Bronze takes, with every fault a payload can have for Silver."""
    renamed = F.regexp_replace("value", '"payload": ', '"was": ')
    start = F.expr("left(renamed, length(renamed) - 1)")
    broken = [
        F.concat(start, F.lit(f', "payload": {payload}}}')) if payload else F.col("value")
        for payload in SILVER_FAULTS
    ]
    rows = lines(spark, sf_dir).withColumn("renamed", renamed)
    return rows.withColumn("value", _by_number(broken)).drop("renamed")


def write_archives(rows: DataFrame, raw_root: str) -> None:
    """Write lines as gzip archives, in `event_number` order within each file.

    An hour is cut into files of bounded length, each written by its own task, so a busy hour
    is spread over many tasks and no two files share a name.
    """
    sizes = rows.groupBy("archive_hour").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(LINES_PER_ARCHIVE)).alias("files")
    )
    # One row per hour of the calendar: the running sum is over a short list.
    before = Window.orderBy("archive_hour").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.select(
        "archive_hour",
        "files",
        F.coalesce(F.sum("files").over(before), F.lit(0)).alias("first_file"),
    )
    total = sizes.agg(F.sum("files")).first()[0]
    file_id = F.col("first_file") + F.col("event_number") % F.col("files")
    archives = rows.join(placed, "archive_hour").select(
        "value",
        F.date_format("archive_hour", "yyyy-MM-dd").alias("archive_date"),
        F.date_format("archive_hour", "HH").alias("archive_hour"),
        "event_number",
        file_id.cast("int").alias("file_id"),
    )
    (
        archives.repartitionById(max(1, total or 0), F.col("file_id"))
        .sortWithinPartitions("archive_date", "archive_hour", "event_number")
        .select("value", "archive_date", "archive_hour")
        .write.partitionBy("archive_date", "archive_hour")
        .option("compression", "gzip")
        .text(archive.zone(raw_root))
    )


_WRITTEN: dict[tuple[str, str], str] = {}


def raw_zone(spark: SparkSession, sf_dir: str) -> str:
    """Root of a raw zone holding all derived events; written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN:
        root = scratch_dir(spark, "raw")
        write_archives(lines(spark, sf_dir), root)
        _WRITTEN[key] = root
    return _WRITTEN[key]


def damaged_zone(spark: SparkSession, sf_dir: str) -> str:
    """A raw zone with three bad archives on the first date: a bad line at 05:00, bytes that are
    no gzip file at 06:00, no line at all at 07:00. Everything else is as in `raw_zone`."""
    key = (spark.sparkContext.applicationId, f"damaged {sf_dir}")
    if key not in _WRITTEN:
        root = scratch_dir(spark, "damaged")
        first, _ = date_bounds(spark, sf_dir)
        hour = F.col("archive_hour")
        at = F.when(F.to_date(hour) == F.lit(first), F.hour(hour)).otherwise(-1)
        rows = lines(spark, sf_dir)
        bad = (
            rows.where(at == 5)
            .groupBy("archive_hour")
            .agg(F.max("event_number").alias("event_number"))
            .select(F.lit("{").alias("value"), "archive_hour", "event_number")
        )
        whole = rows.where(~at.isin(6, 7)).select("value", "archive_hour", "event_number")
        write_archives(whole.unionByName(bad), root)
        for number, content in ((6, b"not compressed"), (7, gzip.compress(b""))):
            moment = datetime(first.year, first.month, first.day, number)
            where = f"archive_date={moment:%Y-%m-%d}/archive_hour={moment:%H}"
            name = f"{moment:%Y-%m-%d}-{number}.json.gz"
            put(spark, f"{archive.zone(root)}/{where}/{name}", content)
        _WRITTEN[key] = root
    return _WRITTEN[key]


def replace_archives(spark: SparkSession, raw_root: str, other_root: str, hour: datetime) -> None:
    """Put the archives of an hour from another zone in place of those of this one, under the names
    these have: an hour's sources in a newer version."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    utility = spark._jvm.org.apache.hadoop.fs.FileUtil
    paths = []
    for root in (raw_root, other_root):
        landed = archive.inventory(spark, root, [hour.date()]).where(F.col("hour") == F.lit(hour))
        paths.append([path(row.path) for row in landed.orderBy("source_file").collect()])
    for old, new in zip(*paths, strict=True):
        system = old.getFileSystem(conf)
        utility.copy(new.getFileSystem(conf), new, system, old, False, True, conf)


REFUSED_HOUR, REVISED_HOUR = 5, 9


def first_hour(spark: SparkSession, sf_dir: str, hour: int) -> datetime:
    first, _ = date_bounds(spark, sf_dir)
    return datetime(first.year, first.month, first.day, hour, tzinfo=UTC)


def revised_zone(spark: SparkSession, sf_dir: str) -> str:
    """A new raw zone whose archives of two hours of the first date are older versions: at 05:00
    every event is a push with a counter that Silver refuses, at 09:00 the id of every actor is
    lower by one. Everything else is as in `raw_zone`."""
    root = scratch_dir(spark, "revised")
    hours = [first_hour(spark, sf_dir, h) for h in (REFUSED_HOUR, REVISED_HOUR)]
    refused, revised = (F.col("archive_hour") == F.lit(hour) for hour in hours)
    rows = lines(spark, sf_dir).select("value", "archive_hour", "event_number")
    pushed = F.regexp_replace("value", '"type": "[A-Za-z]+"', '"type": "PushEvent"')
    pushed = F.regexp_replace(pushed, r'"payload": \{', '"payload": {"size": "many", ')
    pushed = F.regexp_replace(pushed, r'"size": "many", *(\}|"size": \d+, )', r'"size": "many"}')
    actor = F.regexp_extract("value", r'"actor": \{"id": (\d+)', 1).cast("bigint")
    lower = F.concat(
        F.regexp_extract("value", r'^(.*"actor": \{"id": )\d+', 1),
        (actor - 1).cast("string"),
        F.regexp_extract("value", r'"actor": \{"id": \d+(.*)$', 1),
    )
    older = F.when(revised, lower).otherwise(F.col("value"))
    rows = rows.withColumn("value", F.when(refused, pushed).otherwise(older))
    write_archives(rows, root)
    return root


def put(spark: SparkSession, path: str, content: bytes) -> None:
    """Write a small file to any store that Spark reaches."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = system.create(target)
    stream.write(bytearray(content))
    stream.close()
