"""Command line of the jobs, for ``spark-submit``.

::

    spark-submit --py-files trailmill.zip run_job.py session --task-id 1 \\
        --params '{"startAge": ["20"], ...}' --actions hdfs:///user_visit_action \\
        --users hdfs:///user_info --out hdfs:///results

Parameters are the task's JSON object of one-element arrays. City data may be a stored table or,
with ``--jdbc-url``, a database table.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..params import JobParams
from ..sources import adlog, jdbc, tables
from ..streaming import adclicks
from . import reports
from .session import build_session


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="trailmill")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("session", "page", "product"):
        job = jobs.add_parser(name)
        job.add_argument("--task-id", type=int, required=True)
        job.add_argument("--params", required=True, help="task parameters as JSON")
        job.add_argument("--actions", required=True, help="user_visit_action table")
        job.add_argument("--out", required=True, help="folder of the result tables")
        job.add_argument("--format", default="parquet")
        job.add_argument("--out-jdbc-url", help="append the task's results to this database too")
        _add_options(job, "--jdbc-option", "of the database: user=…, password=…, partitionColumn=…")
        if name == "session":
            job.add_argument("--users", required=True, help="user_info table")
            job.add_argument("--sample", type=int, default=100)
            job.add_argument("--seed", type=int, default=0)
        if name == "product":
            job.add_argument("--products", required=True, help="product_info table")
            job.add_argument("--cities", default="city_info", help="city_info table")
            job.add_argument("--jdbc-url", help="read the cities from this database")
    ads = jobs.add_parser("ads")
    ads.add_argument("--brokers", required=True)
    ads.add_argument("--topics", required=True)
    ads.add_argument("--out", required=True, help="folder of the tables and checkpoints")
    ads.add_argument("--threshold", type=int, default=15)
    ads.add_argument("--starting", default="earliest", help="offsets of a first start")
    _add_options(ads, "--kafka-option", "of the Kafka source: maxOffsetsPerTrigger=…, kafka.security.protocol=…")
    return parser


# How often the streaming jobs delete the clean clicks that were counted.
_TRIM_SECONDS = 60


def _add_options(parser: argparse.ArgumentParser, flag: str, of: str) -> None:
    parser.add_argument(flag, action="append", default=[], metavar="NAME=VALUE", type=_pair, help=f"option {of}")


def _pair(text: str) -> tuple[str, str]:
    name, found, value = text.partition("=")
    if not name or not found:
        raise argparse.ArgumentTypeError(f"{text!r} is not NAME=VALUE")
    return name, value


def _cities(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.jdbc_url:
        return jdbc.read_jdbc(spark, args.jdbc_url, args.cities, **dict(args.jdbc_option))
    return tables.read_table(spark, args.cities, "city_info", args.format)


def run(args: argparse.Namespace, spark: SparkSession) -> None:
    if args.job == "ads":
        options = dict(args.kafka_option)
        lines = adlog.kafka_lines(spark, args.brokers, args.topics, args.starting, **options)
        kept = adclicks.AdTables(args.out)
        adclicks.start_reject_query(lines, kept)
        followers = adclicks.start_all(adlog.parse_ad_log(lines), kept, args.threshold)[2:]
        while not spark.streams.awaitAnyTermination(_TRIM_SECONDS):
            adclicks.trim_clean(spark, kept, followers)
        return
    params = JobParams.from_task(args.task_id, args.params)
    actions = tables.read_table(spark, args.actions, "user_visit_action", args.format)
    if args.job == "session":
        users = tables.read_table(spark, args.users, "user_info", args.format)
        reports.session_report(spark, actions, users, params, args.out, args.sample, args.seed)
    elif args.job == "page":
        reports.page_report(actions, params, args.out)
    else:
        products = tables.read_table(spark, args.products, "product_info", args.format)
        reports.product_report(actions, _cities(spark, args), products, params, args.out)
    if args.out_jdbc_url:
        _export(spark, args)


def _export(spark: SparkSession, args: argparse.Namespace) -> None:
    """Append the task's rows of each result table to the database, under the table's name."""
    for name, schema in reports.RESULTS[args.job].items():
        rows = reports.read_result(spark, args.out, name, schema).where(F.col("task_id") == args.task_id)
        jdbc.write_jdbc(rows, args.out_jdbc_url, name, **dict(args.jdbc_option))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    run(args, spark or build_session(f"trailmill-{args.job}"))
