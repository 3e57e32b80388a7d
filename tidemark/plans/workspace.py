"""Feeds and tables built from one folder of source tables, for checks and the bench.

Each piece is built by Spark on first use, from whole source tables, into a run folder under
the shared directory, and kept for the session, as the topics and tables of an installation
would be.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import bronze
from tidemark.plans import silver
from tidemark.plans.layout import Layout
from tidemark.session import new_run_dir
from tidemark.sources import derived, feed, tables
from tidemark.spec import entity
from tidemark.streaming import jobs, run

SLICES = 3
MERGE_EVERY = 2  # so that of the few batches some are merged and some are not

_OPEN: dict[tuple[str, str], "Workspace"] = {}


class Workspace:
    def __init__(self, spark: SparkSession, source: str):
        self.spark = spark
        self.source = source.rstrip("/")
        self.root = new_run_dir(spark, "tidemark")
        self._feeds: dict[str, int] = {}
        self._bronze: set[str] = set()
        self._streamed: set[str] = set()

    @classmethod
    def of(cls, spark: SparkSession, source: str) -> "Workspace":
        key = (spark.sparkContext.applicationId, source.rstrip("/"))
        if key not in _OPEN:
            _OPEN[key] = cls(spark, source)
        return _OPEN[key]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.source}/{name}.parquet")

    # --- topics ----------------------------------------------------------------------------

    def _changes(self, topic: str):
        """What a topic's messages are made of, and how."""
        if topic == "customers":
            return self._customer_changes, derived.customer_records
        if topic == "accounts":
            return derived.account_changes(self.table("customer")), derived.account_records
        rows = derived.transaction_changes(self.table("events"))
        if topic == "transactions":
            return rows, derived.transaction_records
        return rows, derived.envelope_records

    @cached_property
    def _customer_changes(self) -> DataFrame:
        """Stored, as they come from a join: finding the cuts of the feed and writing each of its
        slices would join again. (Changes of transactions cost less to work out than to store.)"""
        path = f"{self.root}/changes/customers"
        derived.customer_changes(self.table("customer"), self.table("orders")).write.parquet(path)
        return self.spark.read.parquet(path)

    def _topic(self, topic: str) -> str:
        path = f"{self.root}/topics/{topic}"
        if topic not in self._feeds:
            slices = SLICES if topic in ("transactions", "customers") else 1
            rows, records = self._changes(topic)
            self._feeds[topic] = derived.write_slices(
                rows, f"{path}/messages", slices, derived.FILES_PER_SLICE, records=records
            )
        return path

    def feed(self, topic: str) -> DataFrame:
        """The topic's messages as a batch."""
        return feed.read_files(self.spark, f"{self._topic(topic)}/messages")

    @cached_property
    def _heartbeat(self) -> str:
        last = self.table("events").agg(F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()
        micros = derived.T0 + (last[0] - derived.T0) // derived.SQUEEZE
        path = f"{self._topic('transactions')}/heartbeat"
        derived.heartbeat(self.spark, micros, 10**15).coalesce(1).write.parquet(path)
        return path

    def feed_stream(self, topic: str) -> DataFrame:
        """The topic's messages as a stream, one slice per micro-batch, heartbeat last."""
        path = self._topic(topic)
        if topic == "transactions":
            _ = self._heartbeat
        return feed.stream_files(self.spark, f"{path}/*", self._feeds[topic])

    def batch_log(self) -> DataFrame:
        """A second run of Bronze and Silver, with its batches logged."""
        layout = Layout(f"{self.root}/logged")

        def bring() -> None:
            table = run.batch_table(self.spark, layout)
            try:
                run.catch_up_bronze(self.feed_stream, layout, ["transactions", "customers"])
                run.catch_up_silver(self.spark, layout)
                # Reports come from a bus of their own, soon after the batches.
                self.spark._jsc.sc().listenerBus().waitUntilEmpty()
                table.flush(self.spark)
            finally:
                self.spark.streams.removeListener(table)

        self._once("logged", bring)
        return run.read_batch_log(self.spark, layout)

    # --- tables ----------------------------------------------------------------------------

    def bronze(self, name: str) -> DataFrame:
        """The Bronze table of an entity, written from its topic in one batch."""
        path = Layout(f"{self.root}/batch").bronze(name)
        spec = entity(name)
        if name not in self._bronze:
            rows = bronze.parse_events(self.feed(name), spec)
            rows.write.partitionBy("_ingestion_date").parquet(path)
            self._bronze.add(name)
        return self.spark.read.schema(spec.bronze_schema).parquet(path)

    @property
    def streamed(self) -> Layout:
        return Layout(f"{self.root}/streamed")

    def _once(self, step: str, action) -> None:
        if step not in self._streamed:
            action()
            self._streamed.add(step)

    def _together(self, starts: dict[str, Callable[[], StreamingQuery]]) -> None:
        """Runs those of the steps, named queries that end by themselves, that have not been run."""
        new = {step: start for step, start in starts.items() if step not in self._streamed}
        run.await_all([start() for start in new.values()])
        self._streamed.update(new)

    def catch_up_bronze(self, *names: str) -> None:
        """Bronze of some entities at once. Messages put aside are a query of their own, which
        :meth:`stream_quarantine` runs; Bronze rows do not need it."""

        def start(name: str) -> StreamingQuery:
            return jobs.start_bronze(self.feed_stream(name), name, self.streamed, jobs.CATCH_UP)

        self._together({f"bronze-{name}": lambda name=name: start(name) for name in names})

    def stream_bronze(self, name: str) -> DataFrame:
        self.catch_up_bronze(name)
        return tables.read_folders(
            self.spark, entity(name).bronze_schema, [self.streamed.bronze(name)]
        )

    def stream_envelopes(self) -> DataFrame:
        layout = Layout(f"{self.root}/enveloped")
        self._together(
            {
                "bronze-envelopes": lambda: jobs.start_bronze(
                    self.feed_stream("envelopes"),
                    "transactions",
                    layout,
                    jobs.CATCH_UP,
                    envelopes=True,
                )
            }
        )
        schema = entity("transactions").bronze_schema
        return tables.read_folders(self.spark, schema, [layout.bronze("transactions")])

    def stream_quarantine(self, name: str) -> DataFrame:
        """What Bronze leaves out of an entity's topic."""
        self._together(
            {
                f"quarantine-{name}": lambda: jobs.start_quarantine(
                    self.feed_stream(name), name, self.streamed, jobs.CATCH_UP
                )
            }
        )
        schema = bronze.rejected_messages(self.feed(name), name).schema
        return self.spark.read.schema(schema).parquet(self.streamed.quarantine(name))

    def catch_up_violations(self, *names: str) -> None:
        """Bronze of some entities, then the rows of each that break a rule."""
        self.catch_up_bronze(*names)

        def start(name: str) -> StreamingQuery:
            return jobs.start_violations(self.spark, name, self.streamed, jobs.CATCH_UP)

        self._together({f"violations-{name}": lambda name=name: start(name) for name in names})

    def stream_violations(self, name: str) -> DataFrame:
        self.catch_up_violations(name)
        return self.spark.read.parquet(self.streamed.violations(name))

    def _in_portions(self, name: str, *portions) -> Layout:
        """Bronze rows that reach the Silver stream one portion after the other."""
        layout = Layout(f"{self.root}/{name}")

        def bring() -> None:
            for chosen in portions:
                part = self.bronze("transactions").where(chosen)
                path = layout.bronze("transactions")
                part.write.mode("append").partitionBy("_ingestion_date").parquet(path)
                run.await_all(
                    [
                        jobs.start_silver_transactions(
                            self.spark, layout, jobs.CATCH_UP, merge_every=1
                        )
                    ]
                )

        self._once(name, bring)
        return layout

    def versions(self, until_ms: int) -> Layout:
        """The feed up to an instant, then the rest: two batches, each merged."""
        early = F.col("cdc_timestamp_ms") <= until_ms
        layout = self._in_portions("versions", early, ~early)
        self._once("versions-merged", lambda: silver.compact_transactions(self.spark, layout))
        return layout

    def late_inserts(self, until_ms: int) -> DataFrame:
        """The same with some messages of the first part delayed until the second."""
        delayed = F.floor(F.col("_feed_offset") / 10) % 70 == 13
        early = (F.col("cdc_timestamp_ms") <= until_ms) & ~delayed
        return silver.late_inserts(self.spark, self._in_portions("delayed", early, ~early))

    def catch_up_silver(self, *names: str) -> None:
        """Bronze, then Silver of transactions, customers or both at once."""
        self.catch_up_bronze(*names)
        starts = {
            "transactions": lambda: jobs.start_silver_transactions(
                self.spark, self.streamed, jobs.CATCH_UP, merge_every=MERGE_EVERY
            ),
            "customers": lambda: jobs.start_silver_customers(
                self.spark, self.streamed, jobs.CATCH_UP
            ),
        }
        self._together({f"silver-{name}": starts[name] for name in names})

    def stream_transactions(self) -> DataFrame:
        self.catch_up_silver("transactions")
        return silver.read_transactions(self.spark, self.streamed)

    def stream_customers(self) -> DataFrame:
        self.catch_up_silver("customers")
        return silver.read_customers(self.spark, self.streamed)

    def stream_metrics(self) -> DataFrame:
        self.stream_transactions()
        self._once(
            "gold-metrics",
            lambda: run.await_all([jobs.start_metrics(self.spark, self.streamed, jobs.CATCH_UP)]),
        )
        return self.spark.read.parquet(self.streamed.metrics)

    def stream_duplicates(self) -> DataFrame:
        self.stream_bronze("transactions")
        self._once(
            "repeated-payments",
            lambda: run.await_all(
                [jobs.start_repeated_payments(self.spark, self.streamed, jobs.CATCH_UP)]
            ),
        )
        return self.spark.read.parquet(self.streamed.repeated_payments)

    def stream_alerts(self) -> DataFrame:
        self.stream_metrics()
        self._once(
            "gold-alerts",
            lambda: run.await_all([jobs.start_alerts(self.spark, self.streamed, jobs.CATCH_UP)]),
        )
        return self.spark.read.parquet(self.streamed.alerts)
