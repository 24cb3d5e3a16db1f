import datetime as dt
import gzip
import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from repo_pulse import schema, session  # noqa: E402
from repo_pulse.operators import catalog  # noqa: E402
from repo_pulse.sources import archive  # noqa: E402
from repo_pulse.sources.lakehouse import Lakehouse  # noqa: E402

DAY = dt.date(2024, 5, 2)
HOUR = dt.datetime(2024, 5, 2, 3, tzinfo=dt.UTC)

# A made-up push: three commits to a tool that sorts seeds.
EVENT = {
    "id": "90210077",
    "type": "PushEvent",
    "created_at": "2024-05-02T03:41:07Z",
    "public": True,
    "actor": {"id": 7001, "login": "noor", "display_login": "Noor"},
    "repo": {"id": 555, "name": "fern/seed-sorter"},
    "org": {"id": 42, "login": "fern"},
    "payload": {"push_id": 8, "size": 3, "ref": "refs/heads/trunk"},
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    built = (
        SparkSession.builder.master("local[*]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .getOrCreate()
    )
    built.sparkContext.setLogLevel("ERROR")
    yield session.configure(built)
    built.stop()


@pytest.fixture
def lake(spark, tmp_path):
    made = Lakehouse(spark, str(tmp_path / "lake"), f"t{abs(hash(str(tmp_path)))}_")
    yield made
    made.drop()


@pytest.fixture
def index(spark):
    return catalog.index(catalog.default(spark))


@pytest.fixture
def lines_frame(spark):
    """Lines of one source as the parser takes them, numbered from 1."""

    def build(lines, source_file="2024-05-02-3.json.gz"):
        rows = [(text, HOUR, source_file, n) for n, text in enumerate(lines, start=1)]
        return spark.createDataFrame(
            rows,
            "value string, archive_hour timestamp, source_file string, source_line_number bigint",
        )

    return build


@pytest.fixture
def silver_frame(spark):
    """Silver rows from a few members; the rest is filled in."""

    def build(*events):
        rows = []
        for n, given in enumerate(events, start=1):
            row = {
                "event_id": str(n),
                "event_type": "PushEvent",
                "event_date": DAY,
                "created_at": HOUR,
                "actor_id": EVENT["actor"]["id"],
                "actor_login": EVENT["actor"]["login"],
                "repo_id": EVENT["repo"]["id"],
                "repo_name": "apache/airflow",
                "org_id": None,
                "org_login": None,
                "action": None,
                "commit_count": None,
                "is_merged": None,
                "archive_hour": HOUR,
                "source_file": "2024-05-02-3.json.gz",
                "source_line_number": n,
            }
            row.update(given)
            rows.append(tuple(row[name] for name in schema.SILVER.names))
        return spark.createDataFrame(rows, schema.SILVER)

    return build


def event(**changes):
    """A raw event with members changed, or removed where given as `...`."""
    made = json.loads(json.dumps(EVENT))
    for key, value in changes.items():
        if value is ...:
            made.pop(key)
        else:
            made[key] = value
    return made


def line(**changes):
    return json.dumps(event(**changes))


def land(raw_root, hour, lines, newline="\n"):
    """Write one archive where a downloader would put it; returns its path."""
    folder = (
        f"{archive.zone(str(raw_root))}/archive_date={hour:%Y-%m-%d}/archive_hour={hour.hour:02d}"
    )
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{hour:%Y-%m-%d}-{hour.hour}.json.gz"
    with gzip.open(path, "wb") as stream:
        stream.write("".join(text + newline for text in lines).encode())
    return path
