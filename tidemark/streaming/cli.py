"""Starts the jobs of one or all layers, e.g. with spark-submit:

    spark-submit tidemark/streaming/cli.py bronze --root s3a://lake --servers kafka:9093
    spark-submit tidemark/streaming/cli.py all --root /lake --topics /dumps --catch-up
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.layout import Layout
from tidemark.session import build_session
from tidemark.sources import feed
from tidemark.spec import ENTITIES
from tidemark.streaming import jobs, run

JOBS = ("bronze", "silver-transactions", "silver-customers", "gold", "all")


def parse(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--root", required=True, help="where the tables live")
    source = parser.add_mutually_exclusive_group()
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--topics", help="folder with one folder of message files per entity")
    parser.add_argument("--max-offsets", type=int, help="per Kafka trigger; no limit if left out")
    parser.add_argument("--max-files", type=int, help="per file trigger")
    parser.add_argument(
        "--envelopes", action="store_true", help="topics hold nested change envelopes"
    )
    parser.add_argument("--catch-up", action="store_true", help="read what is there, then stop")
    options = parser.parse_args(argv)
    if options.job in ("bronze", "all") and not (options.servers or options.topics):
        parser.error("bronze needs --servers or --topics")
    return options


def message_stream(spark: SparkSession, options: argparse.Namespace, entity: str) -> DataFrame:
    if options.servers:
        return feed.stream_kafka(spark, entity, options.servers, max_offsets=options.max_offsets)
    return feed.stream_files(spark, f"{options.topics}/{entity}", options.max_files)


def start(spark: SparkSession, options: argparse.Namespace) -> list[StreamingQuery]:
    layout = Layout(options.root)
    if options.job == "bronze":
        return [
            start_one(
                message_stream(spark, options, name), name, layout, envelopes=options.envelopes
            )
            for name in ENTITIES
            for start_one in (jobs.start_bronze, jobs.start_quarantine)
        ]
    if options.job == "silver-transactions":
        return [jobs.start_silver_transactions(spark, layout)]
    if options.job == "silver-customers":
        return [jobs.start_silver_customers(spark, layout)]
    if options.job == "gold":
        return [jobs.start_metrics(spark, layout), jobs.start_alerts(spark, layout)]
    return run.start_all(
        spark,
        lambda name: message_stream(spark, options, name),
        layout,
        envelopes=options.envelopes,
    )


def catch_up(spark: SparkSession, options: argparse.Namespace) -> None:
    layout = Layout(options.root)

    def messages(name: str) -> DataFrame:
        return message_stream(spark, options, name)

    if options.job in ("bronze", "all"):
        run.catch_up_bronze(messages, layout, ENTITIES, options.envelopes)
    if options.job in ("silver-transactions", "all"):
        run.await_all([jobs.start_silver_transactions(spark, layout, jobs.CATCH_UP)])
    if options.job in ("silver-customers", "all"):
        run.await_all([jobs.start_silver_customers(spark, layout, jobs.CATCH_UP)])
    if options.job in ("gold", "all"):
        run.catch_up_gold(spark, layout)


def main(argv: list[str] | None = None) -> None:
    options = parse(argv)
    logging.basicConfig(level=logging.INFO)
    spark = build_session(f"tidemark-{options.job}")
    run.log_batches(spark)
    if options.catch_up:
        catch_up(spark, options)
    else:
        run.await_any(spark, start(spark, options))


if __name__ == "__main__":
    main()
