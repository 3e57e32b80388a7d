"""Running several queries together, and the layers in order."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.plans.layout import Layout
from tidemark.sources import tables
from tidemark.spec import ddl
from tidemark.streaming import jobs

LOG = logging.getLogger(__name__)

Feed = Callable[[str], DataFrame]


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


def await_any(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Blocks until one of the queries ends, then stops the rest. A failure is raised whichever
    query it came from; an interrupt stops all of them."""
    try:
        # Other queries of the session that have ended before are no reason to return.
        spark.streams.resetTerminated()
        if all(query.isActive for query in queries):
            spark.streams.awaitAnyTermination()
    finally:
        stop_all(queries)
    for query in queries:
        if query.exception() is not None:
            raise query.exception()


def await_all(queries: list[StreamingQuery]) -> None:
    """Waits for queries that end by themselves; if one fails, the others are stopped."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        stop_all(queries)


def catch_up_bronze(
    feed: Feed, layout: Layout, entities: Iterable[str], envelopes: bool = False
) -> None:
    """Every message to Bronze or, if it has no key, to the rejected messages."""
    await_all(
        [
            start(feed(e), e, layout, jobs.CATCH_UP, envelopes)
            for e in entities
            for start in (jobs.start_bronze, jobs.start_quarantine)
        ]
    )


def catch_up_silver(spark: SparkSession, layout: Layout) -> None:
    await_all(
        [
            jobs.start_silver_transactions(spark, layout, jobs.CATCH_UP),
            jobs.start_silver_customers(spark, layout, jobs.CATCH_UP),
        ]
    )


def catch_up_gold(spark: SparkSession, layout: Layout) -> None:
    await_all([jobs.start_metrics(spark, layout, jobs.CATCH_UP)])
    await_all([jobs.start_alerts(spark, layout, jobs.CATCH_UP)])


def catch_up(
    spark: SparkSession,
    feed: Feed,
    layout: Layout,
    entities: Iterable[str] = ("transactions", "customers", "accounts"),
) -> None:
    """Bronze, then Silver, then Gold, each up to what the layer before it has."""
    catch_up_bronze(feed, layout, entities)
    catch_up_silver(spark, layout)
    catch_up_gold(spark, layout)


def start_all(
    spark: SparkSession,
    feed: Feed,
    layout: Layout,
    trigger: dict | None = None,
    envelopes: bool = False,
) -> list[StreamingQuery]:
    """All layers at once, each on its own trigger or all on the one given."""
    chosen = {"trigger": trigger} if trigger else {}
    return [
        *[
            start(feed(e), e, layout, envelopes=envelopes, **chosen)
            for e in ("transactions", "customers", "accounts")
            for start in (jobs.start_bronze, jobs.start_quarantine)
        ],
        jobs.start_silver_transactions(spark, layout, **chosen),
        jobs.start_silver_customers(spark, layout, **chosen),
        jobs.start_metrics(spark, layout, **chosen),
        jobs.start_alerts(spark, layout, **chosen),
    ]


class BatchLog(StreamingQueryListener):
    """Logs each micro-batch of every query: name, batch, rows read and what was observed."""

    def onQueryStarted(self, event) -> None:
        LOG.info("started %s", event.name)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {name: row.asDict() for name, row in (p.observedMetrics or {}).items()}
        if p.numInputRows or observed:
            LOG.info("%s batch %d: %d rows, %s", p.name, p.batchId, p.numInputRows, observed)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            LOG.error("query %s failed: %s", event.id, event.exception)


def log_batches(spark: SparkSession) -> BatchLog:
    """Adds a :class:`BatchLog` to the session; ``spark.streams.removeListener`` takes it away."""
    listener = BatchLog()
    spark.streams.addListener(listener)
    return listener


BATCH_LOG = (
    "query string, batch_id long, started_at timestamp, input_rows long, observed map<string,long>, "
    "duration_ms long"
)


class BatchTable(StreamingQueryListener):
    """Keeps a row per micro-batch and writes the rows it has to the batch log when asked to.

    ``flush`` appends one small file; call it now and then, and at the end. A batch that is
    reported again, as after a restart, is there twice: readers take the last report.
    """

    def __init__(self, layout: Layout):
        self.layout, self._rows, self._lock = layout, [], threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {
            f"{name}.{key}": int(value)
            for name, row in (p.observedMetrics or {}).items()
            for key, value in row.asDict().items()
            if value is not None
        }
        if not p.numInputRows and not observed:
            return
        job = (p.name or "").rsplit("@", 1)
        if len(job) == 2 and job[1] != self.layout.root:
            return  # a job of another installation in the same session
        started = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        took = sum((p.durationMs or {}).get(k, 0) for k in ("triggerExecution",))
        with self._lock:
            self._rows.append((job[0], p.batchId, started, p.numInputRows, observed, took))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def flush(self, spark: SparkSession) -> int:
        """Writes the rows so far; returns how many."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            frame = spark.createDataFrame(rows, BATCH_LOG).coalesce(1)
            frame.write.mode("append").parquet(self.layout.batch_log)
        return len(rows)


def batch_table(spark: SparkSession, layout: Layout) -> BatchTable:
    """Adds a :class:`BatchTable` to the session."""
    listener = BatchTable(layout)
    spark.streams.addListener(listener)
    return listener


def read_batch_log(spark: SparkSession, layout: Layout) -> DataFrame:
    """The last report of each batch."""
    tables.create_if_missing(spark, layout.batch_log, ddl(BATCH_LOG))
    rows = spark.read.schema(BATCH_LOG).parquet(layout.batch_log)
    rest = [c for c in rows.columns if c not in ("query", "batch_id")]
    last = F.max_by(F.struct(*rest), "started_at").alias("last")
    return rows.groupBy("query", "batch_id").agg(last).select("query", "batch_id", "last.*")


def progress_report(query: StreamingQuery) -> list[dict]:
    """Rows read and observed per micro-batch that Spark still remembers."""
    return [
        {
            "batch_id": p["batchId"],
            "input_rows": p["numInputRows"],
            "observed": {
                name: row.asDict() for name, row in (p["observedMetrics"] or {}).items()
            },
        }
        for p in query.recentProgress
    ]
