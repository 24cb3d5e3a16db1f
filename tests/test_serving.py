import datetime as dt

import pytest

from repo_pulse.schema import GOLD, METRICS
from repo_pulse.sources import serving
from tests.conftest import DAY
from tests.test_jobs import gold_rows

LATER = DAY + dt.timedelta(days=1)


class Cursor:
    def __init__(self, connection):
        self.connection = connection

    def execute(self, statement):
        if self.connection.fail_on and statement.startswith(self.connection.fail_on):
            raise RuntimeError("refused")
        self.connection.log.append(statement)

    def close(self):
        pass


class Connection:
    """A DB-API connection that notes what happens and fails where told."""

    def __init__(self, fail_on=None):
        self.log, self.fail_on = [], fail_on

    def cursor(self):
        return Cursor(self)

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


def test_statements_name_every_column():
    schema, table = serving.create_statements()
    assert schema == "CREATE SCHEMA IF NOT EXISTS analytics"
    assert "PRIMARY KEY (technology_id, activity_date)" in table
    assert "published_at TIMESTAMPTZ NOT NULL DEFAULT CURRENT_TIMESTAMP" in table
    upsert = serving.upsert_statement()
    for name in GOLD.names:
        assert name in table and name in upsert
    for name in METRICS:
        assert f"{name} = EXCLUDED.{name}" in upsert
    assert "technology_id = EXCLUDED" not in upsert
    assert serving.delete_statement([DAY]).endswith("activity_date IN (DATE '2024-05-02')")


def test_a_transaction_is_all_or_nothing():
    good = Connection()
    serving.run_transaction(lambda: good, ["a", "b"])
    assert good.log == ["a", "b", "commit", "close"]
    bad = Connection(fail_on="b")
    with pytest.raises(RuntimeError):
        serving.run_transaction(lambda: bad, ["a", "b", "c"])
    assert "commit" not in bad.log and "rollback" in bad.log and "c" not in bad.log


def test_replacing_dates_deletes_and_inserts_in_one_transaction(spark, monkeypatch):
    opened, staged = [], []

    def connect():
        opened.append(Connection())
        return opened[-1]

    def stage(rows, url, properties, name):
        staged.append((rows.count(), name))

    monkeypatch.setattr(serving, "stage", stage)
    target = serving.JdbcServing("jdbc:x", {}, connect)
    rows = gold_rows(spark, {}, {"technology_id": "duckdb"})
    assert target.replace_dates(rows, [DAY]) == 2
    log = [entry.split(" ")[0] for entry in opened[-1].log]
    assert log[:4] == ["DELETE", "INSERT", "DROP", "commit"]
    assert target.upsert(rows) == 2
    log = [entry.split(" ")[0] for entry in opened[-1].log]
    assert log[:3] == ["INSERT", "DROP", "commit"]
    (count, first), (_, second) = staged
    assert count == 2 and first != second
    assert f" FROM {second} " in opened[-1].log[0] and opened[-1].log[1].endswith(second)


def test_input_is_checked_before_anything_is_written(spark):
    target = serving.JdbcServing("jdbc:x", {}, lambda: pytest.fail("no connection expected"))
    other = gold_rows(spark, {"activity_date": LATER})
    with pytest.raises(ValueError, match="all serving rows must match activity_date=2024-05-02"):
        target.replace_dates(other, [DAY])
    with pytest.raises(ValueError, match="repeat"):
        target.upsert(gold_rows(spark, {}, {}))


def as_dict(rows):
    return {(r.technology_id, r.activity_date): r.event_count for r in rows.collect()}


def test_upsert_keeps_and_replacing_drops_stale_rows(spark):
    current = gold_rows(
        spark,
        {"event_count": 10},
        {"technology_id": "stale", "event_count": 3},
        {"activity_date": LATER, "event_count": 7},
    )
    incoming = gold_rows(spark, {"event_count": 11}, {"technology_id": "new", "event_count": 1})
    assert as_dict(serving.upserted(current, incoming)) == {
        ("trino", DAY): 11,
        ("stale", DAY): 3,
        ("new", DAY): 1,
        ("trino", LATER): 7,
    }
    assert as_dict(serving.dates_replaced(current, incoming, [DAY])) == {
        ("trino", DAY): 11,
        ("new", DAY): 1,
        ("trino", LATER): 7,
    }
