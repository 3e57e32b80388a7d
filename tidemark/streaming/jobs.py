"""The streaming queries of the three layers.

Each ``start_*`` returns a started query. ``trigger`` takes the arguments of
``DataStreamWriter.trigger``; ``CATCH_UP`` reads what is there and stops, which is what
backfills and tests use.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.risk import RULES, RiskRules
from tidemark.operators import bronze, customers, metrics, quality, transactions
from tidemark.plans import silver
from tidemark.plans.layout import Layout
from tidemark.sources import tables
from tidemark.spec import GOLD_ALERTS, GOLD_METRICS, INSERT_OPS, Entity, ddl, entity
from tidemark.streaming import duplicates

CATCH_UP = {"availableNow": True}

# How often each layer looks for new rows.
BRONZE_TRIGGER = {"processingTime": "10 seconds"}
SILVER_TRIGGER = {"processingTime": "15 seconds"}
GOLD_TRIGGER = {"processingTime": "10 seconds"}


def _name(job: str, layout: Layout) -> str:
    """A session refuses a second query of the same name: one job per installation."""
    return f"{job}@{layout.root}"


def _sink(df: DataFrame, name: str, path: str, layout: Layout, trigger: dict):
    return (
        df.writeStream.queryName(_name(name, layout))
        .format("parquet")
        .outputMode("append")
        .option("checkpointLocation", layout.checkpoint(name))
        .option("path", path)
        .trigger(**trigger)
    )


def start_bronze(
    feed: DataFrame,
    spec: str | Entity,
    layout: Layout,
    trigger: dict = BRONZE_TRIGGER,
    envelopes: bool = False,
) -> StreamingQuery:
    """Messages of one entity to its append-only table, partitioned by day of arrival.

    ``envelopes`` says that the topic holds nested change envelopes, not flat messages.
    """
    spec = entity(spec)
    path = layout.bronze(spec.name)
    tables.create_if_missing(feed.sparkSession, path, spec.bronze_schema, "_ingestion_date")
    parse = bronze.parse_envelopes if envelopes else bronze.parse_events
    rows = parse(feed, spec).observe(
        f"bronze_{spec.name}", F.count(F.lit(1)).alias("rows")
    )
    return (
        _sink(rows, f"bronze-{spec.name}", path, layout, trigger)
        .partitionBy("_ingestion_date")
        .start()
    )


def start_quarantine(
    feed: DataFrame,
    spec: str | Entity,
    layout: Layout,
    trigger: dict = BRONZE_TRIGGER,
    envelopes: bool = False,
) -> StreamingQuery:
    """Messages that :func:`start_bronze` leaves out. A query of its own, so that both sinks
    write each message exactly once; it parses nothing but the key."""
    spec = entity(spec)
    pick = bronze.rejected_envelopes if envelopes else bronze.rejected_messages
    rows = pick(feed, spec)
    return _sink(
        rows, f"rejected-{spec.name}", layout.quarantine(spec.name), layout, trigger
    ).start()


def start_violations(
    spark: SparkSession,
    spec: str | Entity,
    layout: Layout,
    trigger: dict = SILVER_TRIGGER,
) -> StreamingQuery:
    """Bronze rows that break a source constraint, with the rules they break."""
    spec = entity(spec)
    rows = quality.row_violations(stream_bronze_table(spark, spec, layout), spec.name)
    path = layout.violations(spec.name)
    return _sink(rows, f"violations-{spec.name}", path, layout, trigger).start()


def stream_bronze_table(spark: SparkSession, spec: str | Entity, layout: Layout) -> DataFrame:
    spec = entity(spec)
    schema = tables.folders_last(spec.bronze_schema, "_ingestion_date")
    return spark.readStream.schema(schema).parquet(layout.bronze(spec.name))


def start_silver_transactions(
    spark: SparkSession,
    layout: Layout,
    trigger: dict = SILVER_TRIGGER,
    insert_ops: Sequence[str] = INSERT_OPS,
    merge_every: int = silver.MERGE_EVERY,
) -> StreamingQuery:
    """The keyed merge. ``merge_every`` batches are folded by readers before they are merged into
    the buckets they touch: fewer rewrites against less work for readers."""
    events = transactions.clean_transactions(
        stream_bronze_table(spark, "transactions", layout)
    ).observe("silver_transactions", F.count(F.lit(1)).alias("valid_rows"))

    def apply(batch: DataFrame, batch_id: int) -> None:
        silver.compact_transactions(spark, layout, merge_every, before=batch_id)
        if not batch.isEmpty():
            silver.apply_transactions(batch, batch_id, layout, insert_ops)

    return (
        events.writeStream.queryName(_name("silver-transactions", layout))
        .foreachBatch(apply)
        .outputMode("update")
        .option("checkpointLocation", layout.checkpoint("silver-transactions"))
        .trigger(**trigger)
        .start()
    )


def start_silver_customers(
    spark: SparkSession,
    layout: Layout,
    trigger: dict = SILVER_TRIGGER,
    compact_every: int = silver.MERGE_EVERY,
) -> StreamingQuery:
    """The customer history. After ``compact_every`` batches the last events are put together."""
    events = customers.clean_customers(
        stream_bronze_table(spark, "customers", layout)
    ).observe("silver_customers", F.count(F.lit(1)).alias("valid_rows"))

    def apply(batch: DataFrame, batch_id: int) -> None:
        silver.compact_customers(spark, layout, compact_every)
        if not batch.isEmpty():
            silver.apply_customers(batch, batch_id, layout)

    return (
        events.writeStream.queryName(_name("silver-customers", layout))
        .foreachBatch(apply)
        .outputMode("update")
        .option("checkpointLocation", layout.checkpoint("silver-customers"))
        .trigger(**trigger)
        .start()
    )


def insert_log(spark: SparkSession, layout: Layout) -> DataFrame:
    """First inserts as a stream, each transaction once: what the upsert found not yet inserted.

    Rows that the upsert saw come too late for their window are left out. Its clock is never
    behind that of a query that reads the log, in whatever portions, so every other row counts.
    """
    folders = [T.StructField("batch_id", T.LongType()), T.StructField(silver.LATE, T.BooleanType())]
    schema = T.StructType([*silver.insert_schema().fields, *folders])
    log = spark.readStream.schema(schema).option("ignoreMissingFiles", "true")
    return (
        log.parquet(layout.inserts)
        .where(~F.col(silver.LATE))
        .drop(*[f.name for f in folders])
        .withWatermark("transaction_timestamp", metrics.LATENESS)
    )


def start_metrics(
    spark: SparkSession, layout: Layout, trigger: dict = GOLD_TRIGGER
) -> StreamingQuery:
    """Closed account windows, appended once the watermark has passed them."""
    tables.ensure_folder(spark, layout.inserts)
    tables.create_if_missing(spark, layout.metrics, ddl(GOLD_METRICS))
    rows = metrics.metrics_table(metrics.account_windows(insert_log(spark, layout)))
    return _sink(rows, "gold-metrics", layout.metrics, layout, trigger).start()


def start_repeated_payments(
    spark: SparkSession, layout: Layout, trigger: dict = GOLD_TRIGGER, minutes: int = 10
) -> StreamingQuery:
    """Payments that repeat one shortly before, off the Bronze table."""
    events = transactions.clean_transactions(stream_bronze_table(spark, "transactions", layout))
    inserts = events.where(F.col("cdc_operation").isin(*INSERT_OPS))
    rows = duplicates.repeated_payments(inserts, minutes)
    return _sink(rows, "repeated-payments", layout.repeated_payments, layout, trigger).start()


def start_alerts(
    spark: SparkSession,
    layout: Layout,
    trigger: dict = GOLD_TRIGGER,
    rules: RiskRules = RULES,
) -> StreamingQuery:
    """Alerts off the metrics table: the windows are computed, and their state kept, once."""
    tables.create_if_missing(spark, layout.alerts, ddl(GOLD_ALERTS))
    windows = spark.readStream.schema(ddl(GOLD_METRICS)).parquet(layout.metrics)
    rows = metrics.alerts(windows.drop("_gold_processed_at"), rules)
    return _sink(rows, "gold-aml-alerts", layout.alerts, layout, trigger).start()
