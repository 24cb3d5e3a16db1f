"""What the plans must look like at scale, whatever the size of the test data."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from repo_pulse.operators import bronze, catalog, gold, silver
from repo_pulse.plans import jobs
from repo_pulse.session import scoped_conf
from repo_pulse.sources import archive, lakehouse
from repo_pulse.workload import derived
from tests.conftest import DAY, HOUR, land
from tests.test_jobs import push

SF = "/root/testdata/sf0.001"


def explained(rows, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        rows.explain(mode)
    return out.getvalue()


def test_generated_methods_stay_compilable(lines_frame):
    """The JVM does not compile methods over 8,000 bytes of bytecode."""
    parsed = bronze.parse_events(lines_frame([push()]))
    clean = parsed.where(F.col(bronze.ERROR).isNull())
    for rows in (parsed, bronze.rejects(parsed), silver.to_silver(clean)):
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", explained(rows, "codegen"))]
        assert sizes and max(sizes) < 8000


def test_lines_are_parsed_once_and_filters_do_not_repeat_it(lines_frame):
    parsed = bronze.parse_events(lines_frame([push()]))
    rejected = parsed.where(F.col(bronze.ERROR).isNotNull())
    for rows in (parsed, rejected, silver.to_silver(parsed.where(F.col("_error").isNull()))):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(ArrayType") == 1


def manifest(lake, count):
    """A planned load of so many archives, one of which has landed."""
    names = lake.spark.range(count).selectExpr(
        "IF(id = 0, '2024-05-02-3.json.gz', concat('absent-', id, '.json.gz')) AS source_file",
        "DATE'2024-05-02' AS archive_date",
        "CAST(3 AS BIGINT) AS archive_hour",
    )
    assert lake.plan("bronze", 1, names) == count
    return lake.manifest("bronze", 1)


def test_bronze_load_neither_shuffles_nor_sorts_and_prunes_hours(spark, lake, tmp_path):
    land(tmp_path, HOUR, [push()])
    land(tmp_path, HOUR.replace(hour=4), [push(hour=4)])
    lines = archive.read_planned(spark, str(tmp_path), manifest(lake, 1), [DAY])
    parsed = bronze.parse_events(lines, located=False)
    assert parsed.count() == 1
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    # What is exchanged is the list of sources, never a line.
    lines_side = plan[plan.index("Scan text") - 400 : plan.index("Scan text")]
    assert "Exchange hashpartitioning" not in lines_side and "BroadcastHashJoin" in plan
    assert "dynamicpruning" in explained(parsed)


def test_plans_do_not_grow_with_the_number_of_sources(spark, lake, tmp_path, monkeypatch):
    land(tmp_path, HOUR, [push()])
    monkeypatch.setattr(lakehouse, "LOAD_SOURCES", 100_000)
    sizes = []
    for count in (1, 100_000):
        lines = archive.read_planned(spark, str(tmp_path), manifest(lake, count), [DAY])
        sizes.append(len(explained(lines, "simple")))
        assert lines.count() == 1
    assert abs(sizes[1] - sizes[0]) < 0.02 * sizes[0]


def test_known_index_is_broadcast_and_unknown_names_drop_before_the_shuffle(spark, index):
    plan = explained(gold.daily_activity(derived.silver(spark, SF), index))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # Pre-aggregated by key and actor, shuffled by key and actor, then by key.
    partitioned = re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", plan)
    assert len(partitioned) == 2
    assert "actor_id" in partitioned[0] + partitioned[1]


def test_hot_repository_is_split_when_the_index_cannot_be_broadcast(spark, index):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    def counts(rows):
        return rows.groupBy("technology_id").agg(
            F.count(F.lit(1)), F.sum(F.col("event_id").cast("bigint")), F.max("created_at")
        )

    events = derived.silver(spark, "/root/testdata/sf0.1").repartition(8)
    hot = F.when(F.col("actor_id") % 10 < 9, "apache/spark").otherwise(F.col("repo_name"))
    events = events.withColumn("repo_name", hot)
    with scoped_conf(spark, settings):
        counted = counts(catalog.classify(events, index))
        found = counted.collect()
        plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    assert sorted(found) == sorted(counts(catalog.classify(events, index)).collect())


def test_reads_prune_partitions_and_columns(spark, lake, tmp_path, index):
    land(tmp_path, HOUR, [push()])
    jobs.run_hours(lake, str(tmp_path), [HOUR], index)
    plan = explained(lake.read_silver([DAY]).select("archive_hour"))
    assert re.search(r"PartitionFilters: \[.*event_date#\d+ (IN|=) ", plan)
    assert "payload" not in plan and "actor_login" not in plan
    plan = explained(lake.read_bronze(["2024-05-02-3.json.gz"]).select("event_id"))
    assert "payload_json" not in plan
    plan = explained(lake.read_gold([DAY]).select("technology_id"))
    assert re.search(r"PushedFilters: \[.*EqualTo\(activity_date,2024-05-02\)", plan)


@pytest.mark.parametrize("columns", [("path",), ("path", "hour", "length")])
def test_listing_never_reads_content(spark, tmp_path, columns):
    land(tmp_path, HOUR, [push()])
    plan = explained(archive.inventory(spark, str(tmp_path)).select(*columns))
    assert "content" not in plan
