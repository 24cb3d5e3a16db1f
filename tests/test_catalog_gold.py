import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from repo_pulse.operators import catalog, gold, quality, reports
from repo_pulse.schema import GOLD, METRICS
from tests.conftest import DAY




def write_catalog(path, *entries):
    text = ""
    for key, repositories in entries:
        listed = ", ".join(f'"{name}"' for name in repositories)
        text += (
            f'[[technologies]]\nid = "{key}"\nname = "N"\ncategory = "c"\n'
            f"repositories = [{listed}]\n\n"
        )
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_default_catalog_is_valid(spark):
    rows = catalog.validate(catalog.default(spark)).collect()
    assert len(rows) == 12 and all(row.repositories for row in rows)


def test_load_normalizes(spark, tmp_path):
    path = write_catalog(tmp_path / "c.toml", (" Tool ", [" Org/Tool\\t", "org/other"]))
    row = catalog.load(spark, path).first()
    assert (row.technology_id, row.repositories) == ("tool", ["org/tool", "org/other"])


@pytest.mark.parametrize(
    ("entries", "message"),
    [
        (
            [("a", ["Apache/Airflow"]), ("b", ["apache/airflow"])],
            "repository 'apache/airflow' is assigned to multiple technologies",
        ),
        (
            [("a", ["apache/airflow", "Apache/Airflow"])],
            "repository 'apache/airflow' is assigned to multiple technologies",
        ),
        (
            [("apache-airflow", ["a/b"]), ("Apache-Airflow", ["c/d"])],
            "technology id 'apache-airflow' is duplicated",
        ),
        ([("a", ["apache-airflow"])], "repository 'apache-airflow' must have 'owner/name' format"),
        ([("a", ["a/b/c"])], "repository 'a/b/c' must have 'owner/name' format"),
        ([("a", ["/b"])], "repository '/b' must have 'owner/name' format"),
        ([("a", ["b/"])], "repository 'b/' must have 'owner/name' format"),
    ],
)
def test_load_rejects(spark, tmp_path, entries, message):
    with pytest.raises(ValueError) as refused:
        catalog.load(spark, write_catalog(tmp_path / "c.toml", *entries))
    assert message in str(refused.value)


def test_index_has_a_row_per_repository(spark):
    rows = catalog.index(catalog.create(spark, [("a", "A", "c", ["x/y", "x/z"])])).collect()
    assert {(r.repository, r.technology_id) for r in rows} == {("x/y", "a"), ("x/z", "a")}


def test_pushes_and_a_star(silver_frame, index):
    """Five commits in two pushes by one person, then a star by another, worked out by hand."""
    rows = gold.daily_activity(
        silver_frame(
            {"repo_name": "duckdb/duckdb", "commit_count": 5, "actor_id": 301},
            {"repo_name": "DuckDB/duckdb ", "commit_count": 0, "actor_id": 301},
            {
                "event_type": "WatchEvent",
                "action": "started",
                "actor_id": 302,
                "repo_name": " DUCKDB/DUCKDB",
            },
        ),
        index,
    ).collect()
    assert len(rows) == 1 and rows[0].asDict() == {
        **dict.fromkeys(METRICS, 0),
        "technology_id": "duckdb",
        "activity_date": DAY,
        "event_count": 3,
        "unique_actor_count": 2,
        "push_count": 2,
        "commit_count": 5,
        "star_count": 1,
    }


def test_mixed_events(silver_frame, index):
    row = gold.daily_activity(
        silver_frame(
            {"event_type": "PullRequestEvent", "is_merged": True, "action": "closed"},
            {"event_type": "PullRequestEvent", "is_merged": None},
            {"event_type": "IssuesEvent"},
            {"event_type": "ForkEvent", "actor_id": 11},
            {"event_type": "ReleaseEvent", "actor_id": 12},
            # Only a started watch is a star; a merge counts only on a pull request.
            {"event_type": "WatchEvent", "action": "other"},
            {"event_type": "WatchEvent"},
            {"event_type": "GollumEvent", "is_merged": True, "commit_count": 9},
        ),
        index,
    ).first()
    assert (row.event_count, row.unique_actor_count) == (8, 3)
    assert (row.pull_request_count, row.merged_pull_request_count) == (2, 1)
    assert (row.issue_count, row.fork_count, row.release_count) == (1, 1, 1)
    assert (row.star_count, row.push_count, row.commit_count) == (0, 0, 0)


def test_unknown_repositories_and_repeats(silver_frame, index):
    rows = gold.daily_activity(
        silver_frame(
            {"commit_count": 2, "event_id": "same"},
            {"commit_count": None, "event_id": "same"},
            {"commit_count": 100, "repo_name": "example/unknown"},
        ),
        index,
    ).collect()
    assert [(r.event_count, r.push_count, r.commit_count) for r in rows] == [(2, 2, 2)]


def test_output_order_and_types(silver_frame, index):
    rows = gold.in_order(
        gold.daily_activity(
            silver_frame(
                {"repo_name": "trinodb/trino"},
                {"event_date": dt.date(2024, 5, 3)},
                {},
            ),
            index,
        )
    )
    assert [f.dataType for f in rows.schema] == [f.dataType for f in GOLD]
    assert [(r.technology_id, r.activity_date.day) for r in rows.collect()] == [
        ("apache-airflow", 2),
        ("apache-airflow", 3),
        ("trino", 2),
    ]


def brute_force(events):
    """The counters of (technology, date) written as a loop, as a second opinion."""
    names = {r: t[0] for t in catalog.DEFAULT_TECHNOLOGIES for r in t[3]}
    found, actors = {}, {}
    for e in events:
        technology = names.get(e["repo_name"].strip().casefold())
        if technology is None:
            continue
        key = (technology, e["event_date"])
        row = found.setdefault(key, dict.fromkeys(METRICS, 0))
        row["event_count"] += 1
        actors.setdefault(key, set()).add(e["actor_id"])
        row["unique_actor_count"] = len(actors[key])
        kind = e["event_type"]
        row["push_count"] += kind == "PushEvent"
        row["commit_count"] += (e["commit_count"] or 0) if kind == "PushEvent" else 0
        row["pull_request_count"] += kind == "PullRequestEvent"
        row["merged_pull_request_count"] += kind == "PullRequestEvent" and e["is_merged"] is True
        row["issue_count"] += kind == "IssuesEvent"
        row["star_count"] += kind == "WatchEvent" and e["action"] == "started"
        row["fork_count"] += kind == "ForkEvent"
        row["release_count"] += kind == "ReleaseEvent"
    return found


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_hot_repository_and_actor_against_brute_force(spark, silver_frame, index, broadcast):
    """Nine tenths of the events on one repository, half of them by one actor; with the index
    broadcast, and with a shuffle join where it may not be."""
    rng = random.Random(7)
    kinds = ["PushEvent", "PullRequestEvent", "IssuesEvent", "WatchEvent", "ForkEvent"]
    events = [
        {
            "event_type": rng.choice(kinds),
            "repo_name": "Apache/Spark" if rng.random() < 0.9 else rng.choice(
                ["apache/flink", " duckdb/duckdb ", "who/knows"]
            ),
            "actor_id": 1 if rng.random() < 0.5 else rng.randrange(200),
            "event_date": DAY + dt.timedelta(days=rng.randrange(3)),
            "commit_count": rng.choice([None, 0, 1, 5]),
            "is_merged": rng.choice([None, True, False]),
            "action": rng.choice([None, "started", "closed"]),
        }
        for _ in range(3000)
    ]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        rows = gold.daily_activity(silver_frame(*events), index).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    found = {(r.technology_id, r.activity_date): {m: r[m] for m in METRICS} for r in rows}
    assert found == brute_force(events)


def gold_frame(spark, *rows):
    made = []
    for given in rows:
        row = {**dict.fromkeys(METRICS, 0), "technology_id": "spark", "activity_date": DAY}
        row.update(given)
        made.append(tuple(row[name] for name in GOLD.names))
    return spark.createDataFrame(made, GOLD)


def test_unique_keys(spark):
    rows = gold_frame(spark, {}, {"technology_id": "kafka"}, {})
    assert quality.unique_gold_keys(rows).first().asDict() == {
        "row_count": 3,
        "duplicate_key_count": 1,
        "passed": False,
    }
    assert quality.unique_gold_keys(rows.distinct()).first().passed
    assert quality.unique_gold_keys(rows.limit(0)).first().asDict() == {
        "row_count": 0,
        "duplicate_key_count": 0,
        "passed": True,
    }


@pytest.mark.parametrize(
    ("given", "invalid"),
    [
        ({"event_count": 3, "unique_actor_count": 2, "push_count": 3, "commit_count": 99}, 0),
        ({"star_count": -1}, 1),
        ({"commit_count": -1}, 1),
        ({"event_count": 1, "unique_actor_count": 2}, 1),
        ({"event_count": 1, "merged_pull_request_count": 1}, 1),
        ({"event_count": 1, "push_count": 2}, 1),
        ({"event_count": 1, "release_count": 2}, 1),
    ],
)
def test_valid_metrics(spark, given, invalid):
    row = quality.valid_gold_metrics(gold_frame(spark, given)).first()
    assert (row.row_count, row.invalid_row_count, row.passed) == (1, invalid, invalid == 0)


def test_complete_hours(spark, silver_frame):
    hours = [n for n in range(24) if n not in (3, 17)]
    events = [
        {"archive_hour": dt.datetime(2024, 5, 2, n, tzinfo=dt.UTC)} for n in (*hours, 5, 5)
    ]
    # An hour of the next day that brought an event of this one does not count for this day.
    events.append({"archive_hour": dt.datetime(2024, 5, 3, 0, tzinfo=dt.UTC)})
    dates = spark.createDataFrame([(DAY,), (DAY + dt.timedelta(days=1),)], "event_date date")
    rows = quality.complete_archive_hours(silver_frame(*events), dates).orderBy("event_date")
    first, second = rows.collect()
    assert (first.expected_hour_count, first.present_hour_count) == (24, 22)
    assert first.missing_hours == ["2024-05-02T03:00:00+00:00", "2024-05-02T17:00:00+00:00"]
    assert not first.passed
    assert (second.present_hour_count, second.missing_hour_count) == (0, 24)
    filled = [{"archive_hour": dt.datetime(2024, 5, 2, n, tzinfo=dt.UTC)} for n in range(24)]
    passed = quality.complete_archive_hours(silver_frame(*filled), dates.limit(1)).first()
    assert passed.passed and passed.missing_hours == [] and passed.present_hour_count == 24


def test_reports(spark):
    later = DAY + dt.timedelta(days=1)
    rows = gold_frame(
        spark,
        {"event_count": 5, "push_count": 2, "star_count": 3, "unique_actor_count": 4},
        {"activity_date": later, "event_count": 1, "fork_count": 1, "unique_actor_count": 1},
        {"technology_id": "kafka", "event_count": 6, "issue_count": 6},
        {"technology_id": "airbyte", "event_count": 6},
    )
    ranking = [(r.technology_id, r.event_count) for r in reports.technology_ranking(rows).collect()]
    assert ranking == [("airbyte", 6), ("kafka", 6), ("spark", 6)]
    trend = reports.activity_trend(rows, ["spark"]).orderBy("activity_date").collect()
    assert [(r.activity_date, r.event_count) for r in trend] == [(DAY, 5), (later, 1)]
    mix = {(r.activity_date, r.measure): r.event_count for r in reports.event_mix(rows).collect()}
    assert len(mix) == 12 and mix[DAY, "star_count"] == 3 and mix[later, "fork_count"] == 1
    assert mix[DAY, "issue_count"] == 6
    assert reports.activity_trend(rows, []).count() == 0
    totals = {r.technology_id: r for r in reports.technology_totals(rows).collect()}
    assert totals["spark"].unique_actor_count == 5


def test_distinct_actors(silver_frame, index):
    events = silver_frame(
        {"actor_id": 1}, {"actor_id": 1, "event_date": DAY + dt.timedelta(days=1)}, {"actor_id": 2}
    )
    assert reports.distinct_actors(events, index).select(F.max("actor_count")).first()[0] == 2


def test_a_repository_of_two_technologies_is_refused(spark):
    twice = [("a", "A", "c", ["x/y"]), ("b", "B", "c", ["X/Y "])]
    with pytest.raises(ValueError, match="assigned to multiple technologies"):
        catalog.create(spark, twice)
    assert catalog.violations(catalog.default(spark)).count() == 0
