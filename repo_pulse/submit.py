"""Run one job: `spark-submit repo_pulse/submit.py --lake <root> --raw <root> day 2015-01-01`."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date
from importlib import import_module

from pyspark.sql import SparkSession

from repo_pulse.operators import catalog
from repo_pulse.plans import jobs
from repo_pulse.sources import archive
from repo_pulse.sources.lakehouse import Lakehouse
from repo_pulse.sources.serving import JdbcServing


def arguments(given: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="repo_pulse")
    parser.add_argument("--lake", required=True, help="root folder of the tables")
    parser.add_argument("--prefix", default="", help="what the names of the tables begin with")
    parser.add_argument("--raw", help="root folder of the archives")
    parser.add_argument("--catalog", help="TOML file of technologies; the built-in ones if absent")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("load-bronze").add_argument("paths", nargs="+")
    commands.add_parser("load-silver").add_argument("sources", nargs="*")
    for name in ("build-gold", "check", "day"):
        commands.add_parser(name).add_argument("date", type=date.fromisoformat)
    backfill = commands.add_parser("backfill")
    backfill.add_argument("from_date", type=date.fromisoformat)
    backfill.add_argument("to_date", type=date.fromisoformat)
    backfill.add_argument("--quarantine", action="store_true", help="bad archives are no error")
    publish = commands.add_parser("publish")
    publish.add_argument("dates", nargs="+", type=date.fromisoformat)
    publish.add_argument("--url", required=True, help="JDBC address the executors write to")
    publish.add_argument(
        "--connect", required=True, help="module:function that opens a DB-API connection to it"
    )
    publish.add_argument("--property", action="append", default=[], help="name=value for JDBC")
    return parser.parse_args(given)


def run(spark: SparkSession, asked: argparse.Namespace) -> object:
    """The result of the job; `day` builds one date and requires its checks to pass."""
    # Names begin with nothing unless a prefix is given.
    lake = Lakehouse(spark, asked.lake, *filter(None, [asked.prefix]))
    technologies = (
        catalog.load(spark, asked.catalog) if asked.catalog else catalog.default(spark)
    )
    index = catalog.index(technologies)
    if asked.command in ("load-bronze", "day", "backfill") and not asked.raw:
        raise ValueError(f"{asked.command} needs --raw")
    if asked.command == "load-bronze":
        return jobs.load_bronze(lake, asked.raw, archive.listed(spark, asked.paths))
    if asked.command == "load-silver":
        return jobs.load_silver(lake, asked.sources or None)
    if asked.command == "build-gold":
        return jobs.build_gold(lake, [asked.date], index)
    if asked.command == "check":
        return jobs.require_checks(lake, [asked.date])
    if asked.command == "day":
        return jobs.materialize_day(lake, asked.raw, asked.date, index)
    if asked.command == "publish":
        return jobs.publish(lake, asked.dates, serving_table(asked))
    mode = "quarantine" if asked.quarantine else "fail"
    return jobs.backfill(lake, asked.raw, asked.from_date, asked.to_date, index, mode)


def serving_table(asked: argparse.Namespace) -> JdbcServing:
    module, function = asked.connect.split(":")
    properties = dict(item.split("=", 1) for item in asked.property)
    return JdbcServing(asked.url, properties, getattr(import_module(module), function))


if __name__ == "__main__":
    print(run(SparkSession.builder.appName("repo_pulse").getOrCreate(), arguments()))
