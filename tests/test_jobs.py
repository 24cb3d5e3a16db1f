import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from repo_pulse import submit
from repo_pulse.operators import catalog, gold, reports
from repo_pulse.plans import jobs
from repo_pulse.schema import GOLD, METRICS
from repo_pulse.session import scoped_conf
from repo_pulse.sources import archive, lakehouse
from repo_pulse.sources.lakehouse import Lakehouse, LoadError
from repo_pulse.streaming import incremental
from tests.conftest import DAY, HOUR, event, land, line

TRACKED = {"id": 20, "name": "apache/airflow"}


def push(minute=15, size=2, day=2, hour=3, **changes):
    return line(
        repo=TRACKED,
        created_at=f"2024-05-{day:02d}T{hour:02d}:{minute:02d}:00Z",
        payload={"size": size},
        **changes,
    )


def star(day=2, hour=3, actor=11):
    return line(
        type="WatchEvent",
        repo=TRACKED,
        created_at=f"2024-05-{day:02d}T{hour:02d}:59:00Z",
        actor={"id": actor, "login": "bob"},
        payload={"action": "started"},
    )


def inventory(lake, raw):
    return archive.inventory(lake.spark, str(raw))


def test_tables_are_made_once(lake):
    lake.ensure()
    columns = {r.col_name for r in lake.spark.sql(f"DESCRIBE {lake.silver}").collect()}
    assert {"event_date", "source_file"} <= columns
    parts = lake.spark.sql(f"DESCRIBE EXTENDED {lake.gold}").where("col_name = 'Location'").count()
    assert parts == 1
    assert lake.read_bronze().count() == lake.read_silver().count() == lake.read_gold().count() == 0


def test_bronze_load_and_retry(lake, tmp_path):
    first = land(tmp_path, HOUR, [push(), push(20)])
    assert jobs.load_bronze_paths(lake, str(tmp_path), [first]) == 2
    assert jobs.load_bronze_paths(lake, str(tmp_path), [first]) == 0
    land(tmp_path, HOUR.replace(hour=4), [push(hour=4)])
    assert jobs.load_bronze(lake, str(tmp_path), inventory(lake, tmp_path)) == 1
    rows = lake.read_bronze().orderBy("source_file", "source_line_number").collect()
    assert [(r.source_file, r.source_line_number) for r in rows] == [
        ("2024-05-02-3.json.gz", 1),
        ("2024-05-02-3.json.gz", 2),
        ("2024-05-02-4.json.gz", 1),
    ]
    assert {r.archive_hour.hour for r in rows} == {3, 4}


def test_a_bad_source_is_never_published_in_part(lake, tmp_path):
    bad_lines = [push(n) for n in range(6)] + [line(id=7), line(id=8)]
    land(tmp_path, HOUR, bad_lines)
    land(tmp_path, HOUR.replace(hour=4), [push(hour=4)])
    with pytest.raises(LoadError) as failed:
        jobs.load_bronze(lake, str(tmp_path), inventory(lake, tmp_path))
    assert str(failed.value).startswith(
        "2024-05-02-3.json.gz:7: field 'id' must be str, got int (2 errors)"
    )
    # The clean source is in, nothing of the bad one, which is not tried again as it is.
    assert [r.source_file for r in lake.read_bronze().collect()] == ["2024-05-02-4.json.gz"]
    left = lake.open_rejects("bronze").collect()
    assert [r.source_file for r in left] == ["2024-05-02-3.json.gz"]
    assert lake.pending_archives(inventory(lake, tmp_path)).count() == 0
    with pytest.raises(LoadError):
        jobs.load_bronze(lake, str(tmp_path), inventory(lake, tmp_path))
    assert lake.rejects().count() == 1
    # The repaired archive is another version.
    land(tmp_path, HOUR, bad_lines[:2])
    assert jobs.load_bronze(lake, str(tmp_path), inventory(lake, tmp_path)) == 2
    assert lake.read_bronze().count() == 3


def test_a_crash_before_the_ledger_leaves_nothing_visible(lake, tmp_path, monkeypatch):
    path = land(tmp_path, HOUR, [push(), star()])
    with monkeypatch.context() as patched:
        patched.setattr(Lakehouse, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            jobs.load_bronze_paths(lake, str(tmp_path), [path])
    assert lake.spark.table(lake.bronze).count() == 2 and lake.read_bronze().count() == 0
    assert jobs.load_bronze_paths(lake, str(tmp_path), [path]) == 2
    assert lake.read_bronze().count() == 2
    with monkeypatch.context() as patched:
        patched.setattr(Lakehouse, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            jobs.load_silver(lake)
    assert lake.read_silver().count() == 0
    assert jobs.load_silver(lake) == 2 and lake.read_silver().count() == 2


@pytest.mark.parametrize(
    "settings",
    [
        {},
        {"spark.sql.files.maxPartitionNum": "1"},
        {"spark.sql.files.openCostInBytes": "1", "spark.sql.files.maxPartitionBytes": "3k"},
        {"spark.sql.files.openCostInBytes": "10m", "spark.sql.files.maxPartitionBytes": "10m"},
    ],
)
def test_lines_are_numbered_however_archives_are_packed(lake, tmp_path, settings):
    texts = {}
    for hour in range(1, 13):
        texts[hour] = [push(n % 60, size=n, hour=hour) for n in range(hour * 50)]
        land(tmp_path, HOUR.replace(hour=hour), texts[hour])
    with scoped_conf(lake.spark, settings):
        loaded = jobs.load_bronze(lake, str(tmp_path), inventory(lake, tmp_path))
    assert loaded == sum(len(lines) for lines in texts.values())
    rows = lake.read_bronze().select("source_file", "source_line_number", "payload_json").collect()
    assert {(r[0], r[1], json.loads(r[2])["size"]) for r in rows} == {
        (f"2024-05-02-{hour}.json.gz", n, n - 1)
        for hour, lines in texts.items()
        for n in range(1, len(lines) + 1)
    }
    files = lake.spark.table(lake.bronze).select("_metadata.file_path").distinct().count()
    assert files <= len(texts)


def test_a_load_whose_rows_were_mixed_is_refused(lake, tmp_path, monkeypatch):
    for hour in range(4):
        land(tmp_path, HOUR.replace(hour=hour), [push(n, hour=hour) for n in range(20)])
    read = archive.read_planned
    mixed = lambda *a: read(*a).withColumn(
        "source_line_number", F.monotonically_increasing_id() * 7
    )
    monkeypatch.setattr(archive, "read_planned", mixed)
    with pytest.raises(RuntimeError, match="rows of a source are not in one piece"):
        jobs.load_bronze(lake, str(tmp_path), inventory(lake, tmp_path))
    assert lake.read_bronze().count() == 0 and lake.commits("bronze").count() == 0


def test_more_sources_than_a_load_takes(lake, tmp_path, index, monkeypatch):
    for module in (jobs, lakehouse):
        monkeypatch.setattr(module, "LOAD_SOURCES", 3)
    for hour in range(7):
        land(tmp_path, HOUR.replace(hour=hour), [push(hour=hour), star(hour=hour)])
    summary = jobs.backfill(lake, str(tmp_path), DAY, DAY, index)
    assert summary == jobs.RunSummary(7, 14, 14, 1)
    assert lake.last_load("bronze") == lake.last_load("silver") == 3
    assert lake.read_gold().first().event_count == 14
    assert jobs.backfill(lake, str(tmp_path), DAY, DAY, index) == jobs.RunSummary(7, 0, 0, 1, 7)


def test_only_unreadable_files_are_looked_for(lake, tmp_path, monkeypatch):
    land(tmp_path, HOUR, [push()])
    looked = []
    monkeypatch.setattr(archive, "unreadable", lambda *a: looked.append(a))
    with monkeypatch.context() as patched:
        full = OSError("No space left on device")
        patched.setattr(Lakehouse, "write_load", lambda *a: (_ for _ in ()).throw(full))
        with pytest.raises(OSError, match="No space left"):
            jobs.load_bronze(lake, str(tmp_path), inventory(lake, tmp_path))
    assert not looked and lake.rejects().count() == 0
    assert jobs.load_bronze(lake, str(tmp_path), inventory(lake, tmp_path)) == 1


def test_damaged_archives_do_not_hold_up_the_others(lake, tmp_path):
    land(tmp_path, HOUR, [push(), push(20)])
    half = land(tmp_path, HOUR.replace(hour=4), [push(n % 60, size=n) for n in range(20000)])
    text = land(tmp_path, HOUR.replace(hour=5), [push(hour=5)])
    land(tmp_path, HOUR.replace(hour=6), [push(hour=6), "{"])
    with open(half, "rb") as stream:
        content = stream.read()
    with open(half, "wb") as stream:
        stream.write(content[: len(content) // 2])
    with open(text, "wb") as stream:
        stream.write(b"not compressed")
    with pytest.raises(LoadError) as failed:
        jobs.load_bronze(lake, str(tmp_path), inventory(lake, tmp_path))
    for problem in (
        "2024-05-02-4.json.gz: cannot be read",
        "2024-05-02-5.json.gz: cannot be read",
        "2024-05-02-6.json.gz:2: invalid JSON",
    ):
        assert problem in str(failed.value)
    assert {r.source_file for r in lake.read_bronze().collect()} == {"2024-05-02-3.json.gz"}
    with open(half, "wb") as stream:
        stream.write(content)
    assert jobs.load_bronze_paths(lake, str(tmp_path), [half]) == 20000


def test_broken_files_are_not_opened_again(lake, tmp_path):
    """Neither in their own folder, beside a good file of the hour, nor in other ones."""
    later = HOUR + dt.timedelta(days=1)
    broken = land(tmp_path, HOUR, [])
    with open(broken, "wb") as stream:
        stream.write(b"not compressed")
    run = lambda: jobs.load_bronze(
        lake, str(tmp_path), inventory(lake, tmp_path), "quarantine"
    )
    assert run() == 0
    land(tmp_path, HOUR.replace(hour=4), [push(hour=4)])
    land(tmp_path, later, [push(day=3)])
    assert run() == 2
    second = land(tmp_path, HOUR.replace(hour=9), [push(), push(20)])
    os.rename(second, os.path.join(os.path.dirname(broken), "2024-05-02-3-b.json.gz"))
    assert run() == 2
    assert lake.rejects().count() == 1 and lake.last_load("bronze") == 3


def test_an_empty_archive_is_not_recorded(lake, tmp_path):
    path = land(tmp_path, HOUR, [])
    assert jobs.load_bronze_paths(lake, str(tmp_path), [path]) == 0
    assert lake.commits("bronze").count() == 0
    with pytest.raises(ValueError, match="Bronze source file not found: 2024-05-02-3.json.gz"):
        jobs.load_silver(lake, ["2024-05-02-3.json.gz"])


def test_silver_load(lake, tmp_path):
    path = land(tmp_path, HOUR, [push(), star(), push(day=1, hour=23)])
    jobs.load_bronze_paths(lake, str(tmp_path), [path])
    assert jobs.load_silver(lake, ["2024-05-02-3.json.gz"]) == 3
    assert jobs.load_silver(lake, ["2024-05-02-3.json.gz"]) == 0
    assert lake.read_silver([DAY]).count() == 2
    assert lake.read_silver([DAY - dt.timedelta(days=1)]).count() == 1
    with pytest.raises(ValueError, match="Bronze source file not found: missing.json.gz"):
        jobs.load_silver(lake, ["missing.json.gz", "2024-05-02-3.json.gz"])


def test_silver_source_with_an_error_stays_out(lake, tmp_path):
    land(tmp_path, HOUR, [push(), push(size="not-an-integer")])
    land(tmp_path, HOUR.replace(hour=4), [push(hour=4)])
    jobs.load_bronze(lake, str(tmp_path), inventory(lake, tmp_path))
    with pytest.raises(LoadError, match="2024-05-02-3.json.gz:2: field 'payload.size' must be int"):
        jobs.load_silver(lake)
    assert [r.source_file for r in lake.read_silver().collect()] == ["2024-05-02-4.json.gz"]


def test_nulls_in_required_columns_are_caught_at_the_table(lake, silver_frame):
    absent = F.when(F.col("source_line_number") != 2, F.col("actor_login"))
    rows = silver_frame({}, {}).withColumn("actor_login", absent)
    listed = lake.spark.createDataFrame(
        [("2024-05-02-3.json.gz", HOUR, 10, 1, 0, 2)],
        "source_file string, modified_at timestamp, length bigint, parent bigint, "
        "first_row_id bigint, row_count bigint",
    )
    assert lake.plan("silver", 1, listed) == 1
    written = lake.write_load("silver", 1, rows.withColumn("_error", F.lit(None).cast("string")))
    assert written == (2, 1)
    assert lake.commit_silver(1, *written) == 0
    assert [r.reason for r in lake.open_rejects("silver").collect()] == [
        "null in a required column"
    ]
    assert lake.read_silver().count() == 0
    with pytest.raises(RuntimeError, match="1 rows of 2 were written"):
        lake.plan("silver", 2, listed)
        lake.commit_silver(2, 1, 0)


def test_late_event_enters_gold_at_the_next_build(lake, tmp_path, index):
    land(tmp_path, HOUR, [push(), line(created_at="2024-05-02T03:20:00Z")])
    jobs.load_bronze(lake, str(tmp_path), inventory(lake, tmp_path))
    jobs.load_silver(lake)
    assert jobs.build_gold(lake, [DAY], index) == 1
    land(tmp_path, HOUR + dt.timedelta(days=1), [star(day=2, hour=23)])
    jobs.load_bronze(lake, str(tmp_path), inventory(lake, tmp_path))
    jobs.load_silver(lake)
    assert lake.read_gold().first().event_count == 1
    assert jobs.build_gold(lake, [DAY], index) == 1
    row = lake.read_gold([DAY]).first()
    assert (row.event_count, row.unique_actor_count) == (2, 2)
    assert (row.star_count, row.commit_count) == (1, 2)
    # No tracked event: no row.
    assert jobs.build_gold(lake, [DAY + dt.timedelta(days=1)], index) == 0


def gold_rows(spark, *rows):
    made = []
    for given in rows:
        row = {**dict.fromkeys(METRICS, 0), "technology_id": "trino", "activity_date": DAY}
        row.update(given)
        made.append(tuple(row[name] for name in GOLD.names))
    return spark.createDataFrame(made, GOLD)


def test_replacing_a_date(lake, spark):
    later = DAY + dt.timedelta(days=1)
    both = gold_rows(spark, {"event_count": 1, "commit_count": 2}, {"activity_date": later})
    assert lake.replace_dates(both, [DAY, later]) == 2
    assert lake.replace_dates(gold_rows(spark, {"event_count": 2, "commit_count": 5}), [DAY]) == 1
    row = lake.read_gold([DAY]).collect()
    assert [(r.event_count, r.commit_count) for r in row] == [(2, 5)]
    assert lake.read_gold([later]).count() == 1
    with pytest.raises(ValueError, match="all Gold rows must match activity_date=2024-05-02"):
        lake.replace_dates(both, [DAY])
    # No rows for a date with rows empties it; for a date without rows nothing happens.
    assert lake.replace_dates(both.where(F.lit(False)), [DAY, dt.date(2025, 5, 5)]) == 0
    assert [r.activity_date for r in lake.read_gold().collect()] == [later]


def test_tables_can_be_opened_again(lake, spark, tmp_path, index):
    land(tmp_path, HOUR, [push()])
    jobs.run_hours(lake, str(tmp_path), [HOUR], index)
    lake.drop()
    lake.ensure()
    assert lake.read_silver([DAY]).count() == lake.read_gold([DAY]).count() == 1
    assert jobs.load_bronze(lake, str(tmp_path), inventory(lake, tmp_path)) == 0


def test_one_hour_raw_to_gold_twice(lake, tmp_path, index):
    land(tmp_path, HOUR, [push()])
    first = jobs.run_hours(lake, str(tmp_path), [HOUR], index)
    assert first == jobs.RunSummary(1, 1, 1, 1)
    again = jobs.run_hours(lake, str(tmp_path), [HOUR], index)
    assert again == jobs.RunSummary(1, 0, 0, 1, 1)
    assert lake.read_bronze().count() == lake.read_silver().count() == lake.read_gold().count() == 1
    assert jobs.run_summary(lake).first().asDict() == {
        "archive_count": 1,
        "bronze_rows": 1,
        "silver_rows": 1,
        "gold_rows": 1,
    }


def test_a_rerun_builds_only_dates_that_changed(lake, spark, tmp_path, index, monkeypatch):
    later = DAY + dt.timedelta(days=1)
    built, build = [], jobs.build_gold
    monkeypatch.setattr(jobs, "build_gold", lambda *a: (built.append(a[1]), build(*a))[1])
    land(tmp_path, HOUR, [push()])
    land(tmp_path, HOUR + dt.timedelta(days=1), [push(day=3)])
    for _ in range(2):
        assert jobs.backfill(lake, str(tmp_path), DAY, later, index).gold_rows == 2
    assert built == [[DAY, later]]
    land(tmp_path, (HOUR + dt.timedelta(days=1)).replace(hour=4), [star(day=2, hour=23)])
    jobs.backfill(lake, str(tmp_path), DAY, later, index)
    assert built[1:] == [[DAY]] and lake.read_gold([DAY]).first().event_count == 2
    other = catalog.index(catalog.create(spark, [("x", "X", "c", ["apache/airflow"])]))
    jobs.backfill(lake, str(tmp_path), DAY, later, other)
    assert built[2:] == [[DAY, later]]
    assert {r.technology_id for r in lake.read_gold().collect()} == {"x"}


def test_hours_are_validated(lake, tmp_path, index):
    cases = [
        ([], "at least one archive hour is required"),
        ([HOUR.replace(tzinfo=None)], "archive hours must be timezone-aware"),
        ([HOUR, HOUR + dt.timedelta(days=1)], "all archive hours must belong to the same UTC date"),
        ([HOUR.replace(minute=30)], "archive_hour must be aligned to a full UTC hour"),
    ]
    for hours, message in cases:
        with pytest.raises(ValueError, match=message):
            jobs.run_hours(lake, str(tmp_path), hours, index)
    land(tmp_path, HOUR, [push()])
    with pytest.raises(FileNotFoundError, match="2024-05-02T04"):
        jobs.run_hours(lake, str(tmp_path), [HOUR, HOUR.replace(hour=4)], index)
    with pytest.raises(ValueError, match="date range ends 2024-05-01, before 2024-05-02"):
        jobs.date_range(DAY, DAY - dt.timedelta(days=1))
    with pytest.raises(ValueError, match="daily partitions start at 2015-01-01"):
        jobs.date_range(dt.date(2014, 12, 31), DAY)


def land_day(raw, day, skip=()):
    for hour in range(24):
        if hour not in skip:
            at = dt.datetime(2024, 5, day, hour, tzinfo=dt.UTC)
            land(raw, at, [push(day=day, hour=hour), star(day=day, hour=hour)])


class Recorder:
    """A serving table that only notes what it is given."""

    def __init__(self):
        self.published = []

    def replace_dates(self, rows, dates):
        self.published.append((dates, rows.count()))
        return rows.count()


def test_whole_day_with_checks_and_publication(lake, tmp_path, index):
    land_day(tmp_path, 2)
    assert jobs.materialize_day(lake, str(tmp_path), DAY, index) == jobs.RunSummary(
        24, 48, 48, 1
    )
    target = Recorder()
    assert jobs.publish(lake, [DAY], target) == 1
    assert jobs.publish(lake, [DAY], target) == 1
    assert target.published == [([DAY], 1), ([DAY], 1)]


def test_backfill_and_failing_checks(lake, tmp_path, index):
    land_day(tmp_path, 2)
    land_day(tmp_path, 3, skip=(3, 17))
    later = DAY + dt.timedelta(days=1)
    summary = jobs.backfill(lake, str(tmp_path), DAY, later, index)
    assert summary == jobs.RunSummary(46, 92, 92, 2)
    assert jobs.backfill(lake, str(tmp_path), DAY, later, index).bronze_rows == 0
    failed = jobs.checks(lake, [DAY, later]).where(~F.col("passed")).collect()
    assert [r.check_name for r in failed] == ["complete_archive_hours"]
    assert json.loads(failed[0].details)["missing_hours"] == [
        "2024-05-03T03:00:00+00:00",
        "2024-05-03T17:00:00+00:00",
    ]
    target = Recorder()
    with pytest.raises(jobs.QualityError, match="complete_archive_hours"):
        jobs.publish(lake, [later], target)
    assert target.published == []
    assert jobs.publish(lake, [DAY], target) == 1


def test_jobs_from_the_command_line(spark, tmp_path, monkeypatch):
    made = []

    def open_lake(session, root):
        made.append(Lakehouse(session, root, f"cli{len(str(tmp_path))}_"))
        return made[-1]

    monkeypatch.setattr(submit, "Lakehouse", open_lake)
    path = land(tmp_path, HOUR, [push(), star()])
    common = ["--lake", str(tmp_path / "lake"), "--raw", str(tmp_path)]
    run = lambda *words: submit.run(spark, submit.arguments([*common, *words]))
    assert run("load-bronze", path) == 2
    assert run("load-silver") == 2
    assert run("build-gold", "2024-05-02") == 1
    assert run("backfill", "2024-05-02", "2024-05-03").bronze_rows == 0
    with pytest.raises(jobs.QualityError):
        run("check", "2024-05-02")
    with pytest.raises(FileNotFoundError):
        run("day", "2024-05-02")
    made[-1].drop()


def test_stream_loads_each_archive_once(lake, tmp_path, index):
    land(tmp_path, HOUR, [push()])
    checkpoint = str(tmp_path / "checkpoint")
    incremental.stream_bronze(lake, str(tmp_path), checkpoint).awaitTermination()
    assert lake.read_bronze().count() == 1
    land(tmp_path, HOUR.replace(hour=4), [push(hour=4), star(hour=4)])
    incremental.stream_bronze(lake, str(tmp_path), checkpoint).awaitTermination()
    assert lake.read_bronze().count() == 3
    # A lost checkpoint offers everything again.
    incremental.stream_bronze(lake, str(tmp_path), checkpoint + "2").awaitTermination()
    assert lake.read_bronze().count() == 3


def test_stream_rebuilds_touched_dates(lake, tmp_path, index):
    checkpoint = str(tmp_path / "checkpoint")
    run = lambda: incremental.stream_refresh(
        lake, str(tmp_path), checkpoint, index, max_files=1
    ).awaitTermination()
    land(tmp_path, HOUR, [push()])
    run()
    assert lake.read_gold([DAY]).first().event_count == 1
    late = land(tmp_path, HOUR + dt.timedelta(days=1), [star(day=2, hour=23), push(day=3)])
    run()
    assert lake.read_gold([DAY]).first().event_count == 2
    assert lake.read_gold([DAY + dt.timedelta(days=1)]).first().event_count == 1
    assert late.endswith("2024-05-03-3.json.gz")


def test_stream_goes_on_past_a_bad_source_and_takes_it_once_repaired(lake, tmp_path, index):
    checkpoint = str(tmp_path / "checkpoint")

    def stream():
        query = incremental.stream_refresh(lake, str(tmp_path), checkpoint, index, max_files=1)
        query.awaitTermination()

    land(tmp_path, HOUR, [push(), "{"])
    land(tmp_path, HOUR.replace(hour=4), [push(hour=4)])
    stream()
    assert lake.read_bronze().count() == lake.read_silver().count() == 1
    land(tmp_path, HOUR.replace(hour=5), [push(hour=5)])
    stream()
    assert lake.read_gold([DAY]).first().event_count == 2
    left = [r.source_file for r in lake.open_rejects("bronze").collect()]
    assert left == ["2024-05-02-3.json.gz"]
    time.sleep(1.1)  # file times may count whole seconds
    land(tmp_path, HOUR, [push()])
    stream()
    assert lake.read_gold([DAY]).first().event_count == 3
    assert lake.open_rejects("bronze").count() == 0


def test_bad_sources_hold_up_neither_the_others_nor_their_dates(lake, tmp_path, index):
    days = [DAY, DAY + dt.timedelta(days=1)]
    land(tmp_path, HOUR, [push(), "{"])
    land(tmp_path, HOUR.replace(hour=4), [push(hour=4)])
    land(tmp_path, HOUR.replace(hour=5), [])
    land(tmp_path, HOUR.replace(hour=6), [push(hour=6), push(size="many")])
    cut = land(tmp_path, HOUR.replace(hour=7), [push(n % 60, hour=7, size=n) for n in range(2000)])
    land(tmp_path, HOUR + dt.timedelta(days=1), [push(day=3)])
    with open(cut, "rb+") as stream:
        stream.truncate(os.path.getsize(cut) // 2)
    with pytest.raises(LoadError) as failed:
        jobs.backfill(lake, str(tmp_path), *days, index)
    for problem in (
        "2024-05-02-3.json.gz:2: invalid JSON",
        "Bronze source file not found: 2024-05-02-5.json.gz",
        "2024-05-02-6.json.gz:2: field 'payload.size' must be int",
        "2024-05-02-7.json.gz: cannot be read",
    ):
        assert problem in str(failed.value)
    assert [r.event_count for r in lake.read_gold().orderBy("activity_date").collect()] == [1, 1]
    again = jobs.backfill(lake, str(tmp_path), *days, index, mode="quarantine")
    # The Bronze rows of the source with a bad size are finished; Silver leaves it out again.
    assert again == jobs.RunSummary(6, 0, 0, 2, 3, 4)
    land(tmp_path, HOUR, [push()])
    assert jobs.backfill(lake, str(tmp_path), *days, index, mode="quarantine").bronze_rows == 1
    assert lake.read_gold([DAY]).first().event_count == 2


def test_every_bad_source_is_recorded_and_unreadable_ones_cost_one_more_write(
    lake, tmp_path, monkeypatch
):
    hours = [HOUR.replace(hour=h) + dt.timedelta(days=d) for h in range(12) for d in range(2)]
    for hour in hours:
        land(tmp_path, hour, ["{"])
    broken = [land(tmp_path, HOUR.replace(hour=20 + h), [push(hour=20 + h)]) for h in range(3)]
    land(tmp_path, HOUR.replace(hour=23), [push(hour=23)])
    for path in broken:
        with open(path, "wb") as stream:
            stream.write(b"not compressed")
    writes = []
    write = Lakehouse.write_load
    monkeypatch.setattr(Lakehouse, "write_load", lambda *a: (writes.append(1), write(*a))[1])
    with pytest.raises(LoadError, match="27 sources in all; see .*source_rejects"):
        jobs.load_bronze(lake, str(tmp_path), inventory(lake, tmp_path))
    assert len(writes) == 2 and lake.rejects().count() == 27
    assert lake.read_bronze().count() == 1


def test_a_root_is_not_opened_under_another_ones_tables(lake, spark, tmp_path):
    prefix = lake.bronze.removesuffix("bronze.gharchive_events")
    assert Lakehouse(spark, lake.root + "/", prefix).root == lake.root
    with pytest.raises(ValueError, match="lies at"):
        Lakehouse(spark, str(tmp_path / "other"), prefix)


def test_payload_survives_the_loads(lake, tmp_path):
    payload = {"size": 1, "text": "é😀 \\ \" {", "n": [1, 2.5, None]}
    path = land(tmp_path, HOUR, [json.dumps(event(payload=payload), ensure_ascii=False)])
    jobs.load_bronze_paths(lake, str(tmp_path), [path])
    assert json.loads(lake.read_bronze().first().payload_json) == payload


def test_daily_activity_of_the_tables_equals_that_of_the_rows(lake, tmp_path, index, spark):
    land_day(tmp_path, 2)
    jobs.run_day(lake, str(tmp_path), DAY, index)
    direct = gold.daily_activity(lake.read_silver(), catalog.index(catalog.default(spark)))
    assert direct.exceptAll(lake.read_gold()).count() == 0


def sizes(rows):
    return sorted(r.commit_count for r in rows.collect() if r.commit_count is not None)


def test_a_source_that_silver_refused_is_taken_once_repaired(lake, tmp_path, index):
    land(tmp_path, HOUR, [push(), push(size="many")])
    land(tmp_path, HOUR.replace(hour=4), [push(hour=4)])
    run = lambda: jobs.backfill(
        lake, str(tmp_path), DAY, DAY, index, mode="quarantine"
    )
    assert run() == jobs.RunSummary(2, 3, 1, 1, 0, 1)
    assert run() == jobs.RunSummary(2, 0, 0, 1, 2, 1)
    assert lake.rejects().count() == 1
    land(tmp_path, HOUR, [push(), push(size=9), push(size=8)])
    assert run() == jobs.RunSummary(2, 3, 3, 1, 1, 0)
    assert sizes(lake.read_silver()) == [2, 2, 8, 9] and lake.read_bronze().count() == 4
    assert lake.read_gold().first().event_count == 4
    assert lake.open_rejects("silver").count() == 0 and lake.open_rejects("bronze").count() == 0


def test_a_newer_version_replaces_rows_and_touches_old_dates(lake, tmp_path, index):
    later = DAY + dt.timedelta(days=1)
    path = land(tmp_path, HOUR, [push(size=1), push(size=2, day=1, hour=23), star()])
    days = [DAY - dt.timedelta(days=1), DAY]
    jobs.backfill(lake, str(tmp_path), DAY, DAY, index)
    jobs.refresh(lake, index)
    assert [r.event_count for r in lake.read_gold(days).orderBy("activity_date").collect()] == [1, 2]
    before = lake.last_load("silver")
    # The event of the day before is gone, one of the day after is new.
    land(tmp_path, HOUR, [push(size=5), push(size=6, day=3, hour=0)])
    jobs.load_bronze_paths(lake, str(tmp_path), [path])
    # Until Silver has the new version it shows the last good one.
    assert sizes(lake.read_silver()) == [1, 2] and lake.read_bronze().count() == 2
    assert jobs.load_silver(lake) == 2
    assert sizes(lake.read_silver()) == [5, 6] and lake.read_silver(days[:1]).count() == 0
    assert sizes(lake.read_silver(upto=before)) == [1, 2]
    assert jobs.refresh(lake, index) == [*days, later]
    assert {r.activity_date: r.event_count for r in lake.read_gold().collect()} == {
        DAY: 1, later: 1
    }
    assert jobs.refresh(lake, index) == []
    # A bad version leaves the last good one in sight.
    land(tmp_path, HOUR, ["{"])
    assert jobs.load_bronze_paths(lake, str(tmp_path), [path], "quarantine") == 0
    assert sizes(lake.read_silver()) == [5, 6] and lake.read_bronze().count() == 2
    assert lake.open_rejects("bronze").count() == 1
    summary = jobs.run_summary(lake).first()
    assert (summary.archive_count, summary.bronze_rows, summary.silver_rows) == (1, 2, 2)


def test_a_silver_refused_source_is_repaired_within_a_stream(lake, tmp_path, index):
    checkpoint = str(tmp_path / "checkpoint")
    bad = land(tmp_path, HOUR, [push(size="many")])
    land(tmp_path, HOUR.replace(hour=4), [push(hour=4)])
    repairs = []

    # The archive is repaired while the stream runs: its second batch takes it.
    def rebuilt(*given):
        if not repairs:
            repairs.append(land(tmp_path, HOUR, [push(size=7), push(size=8)]))
        return build(*given)

    build = jobs.refresh
    jobs.refresh = rebuilt
    try:
        incremental.stream_refresh(
            lake, str(tmp_path), checkpoint, index, max_files=1
        ).awaitTermination()
    finally:
        jobs.refresh = build
    assert repairs == [bad]
    assert sizes(lake.read_silver()) == [2, 7, 8]
    assert lake.read_gold().first().event_count == 3 and lake.open_rejects("silver").count() == 0


def test_a_crash_between_write_and_ledger_is_replayed(lake, tmp_path, index, monkeypatch):
    checkpoint = str(tmp_path / "checkpoint")
    for hour in (3, 4):
        land(tmp_path, HOUR.replace(hour=hour), [push(hour=hour), star(hour=hour)])

    def stream():
        return incremental.stream_refresh(lake, str(tmp_path), checkpoint, index)

    for layer in ("bronze", "silver", "gold"):
        commit = Lakehouse._commit

        def crash(self, at, *rest, commit=commit, layer=layer):
            if at == layer:
                raise OSError("lost")
            commit(self, at, *rest)

        with monkeypatch.context() as patched:
            patched.setattr(Lakehouse, "_commit", crash)
            with pytest.raises(Exception, match="lost"):
                stream().awaitTermination()
        assert lake.commits(layer, "load").count() == 0
    stream().awaitTermination()
    assert lake.read_bronze().count() == lake.read_silver().count() == 4
    assert lake.read_gold().first().event_count == 4
    assert lake.last_load("bronze") == lake.last_load("silver") == 1
    assert lake.is_committed("bronze", f"{checkpoint}#0")
    with pytest.raises(ValueError, match="max_files"):
        incremental.stream_bronze(lake, str(tmp_path), checkpoint, max_files=10**6)


def test_a_reader_sees_the_old_date_or_the_new_one(lake, spark, monkeypatch):
    later = DAY + dt.timedelta(days=1)
    old = gold_rows(spark, {"event_count": 1}, {"event_count": 2, "activity_date": later})
    lake.replace_dates(old, [DAY, later])
    opened = lake.read_gold()
    seen = []
    commit = Lakehouse._commit

    def watched(self, *given):
        seen.append(sorted(r.event_count for r in lake.read_gold([DAY, later]).collect()))
        commit(self, *given)
        seen.append(sorted(r.event_count for r in lake.read_gold([DAY, later]).collect()))

    monkeypatch.setattr(Lakehouse, "_commit", watched)
    lake.replace_dates(gold_rows(spark, {"event_count": 5}), [DAY])
    lake.replace_dates(old.where(F.lit(False)), [DAY, later])
    assert seen == [[1, 2], [2, 5], [2, 5], []]
    # A plan made before a replacement still finds the rows it points to.
    assert sorted(r.event_count for r in opened.collect()) in ([1, 2], [2, 5], [])
    assert lake.commits("gold", "load").count() == 3


def test_actors_over_any_range_are_exact(lake, tmp_path, index, spark):
    land_day(tmp_path, 2)
    land(tmp_path, HOUR + dt.timedelta(days=1), [
        star(day=3, actor=actor) for actor in (11, 11, 32768, 32769, 10**12, 0)
    ])
    later = DAY + dt.timedelta(days=1)
    jobs.backfill(lake, str(tmp_path), DAY, later, index)
    for days in ([DAY], [later], [DAY, later]):
        found = reports.distinct_actors_range(lake.read_actors(days)).collect()
        exact = reports.distinct_actors(lake.read_silver(days), index).collect()
        assert sorted(map(tuple, found)) == sorted(map(tuple, exact))
    assert exact[0].actor_count == 6
