"""The Silver tables as stored: applying a batch, reading, compacting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import customers, metrics, snapshot, transactions
from tidemark.operators.skew import filter_by_keys
from tidemark.plans.layout import Layout
from tidemark.sources import buckets, tables
from tidemark.spec import CUSTOMERS, INSERT_OPS, SILVER_TRANSACTIONS, ddl


def transaction_state_schema() -> T.StructType:
    types = {f.name: f.dataType for f in ddl(SILVER_TRANSACTIONS).fields}
    image = T.StructType(
        [
            T.StructField("_source_ts_ms", T.LongType()),
            T.StructField("_source_offset", T.LongType()),
            *[T.StructField(c, types[c]) for c in transactions.BUSINESS],
            T.StructField("_is_deleted", T.BooleanType()),
        ]
    )
    return T.StructType(
        [
            T.StructField(transactions.KEY, T.StringType()),
            T.StructField(transactions.FIRST, image),
            T.StructField(transactions.LAST, image),
        ]
    )


def customer_event_schema() -> T.StructType:
    types = {f.name: f.dataType for f in CUSTOMERS.bronze_schema.fields}
    types.update(_source_ts_ms=T.LongType(), _source_offset=T.LongType())
    return T.StructType([T.StructField(c, types[c]) for c in customers.EVENT_COLUMNS])


def followed_event_schema() -> T.StructType:
    return T.StructType(
        [*customer_event_schema().fields, T.StructField("_next_ts_ms", T.LongType())]
    )


def insert_schema() -> T.StructType:
    image = transaction_state_schema()[transactions.FIRST].dataType
    return T.StructType([T.StructField(transactions.KEY, T.StringType()), *image.fields])


# --- transactions ------------------------------------------------------------------------------
#
# A batch adds its state, one row per key that it touches. Every so many batches these are merged into
# the table proper: typed rows in buckets of the key, of which only touched buckets are rewritten.

MERGE_EVERY = 20
"""Batches that wait to be merged at most; readers fold that many."""
PRESENT = "_is_present"
LATE = "is_late"


def row_schema() -> T.StructType:
    """The declared columns, and the position of the event that made the row."""
    position = [T.StructField(c, T.LongType()) for c in ("_source_ts_ms", "_source_offset")]
    return T.StructType([*ddl(SILVER_TRANSACTIONS).fields, *position])


def merged_schema() -> T.StructType:
    """Rows, whether the key was ever inserted, and what later merges need."""
    return T.StructType(
        [
            *row_schema().fields,
            T.StructField(PRESENT, T.BooleanType()),
            *transaction_state_schema().fields[1:],
        ]
    )


def apply_transactions(
    events: DataFrame, batch_id: int, layout: Layout, insert_ops: Sequence[str] = INSERT_OPS
) -> bool:
    """Adds cleaned events to the table as one batch of state rows, and to the insert log the
    transactions that were not in it. Each of the two is written unless it is there already.

    What was inserted before is looked up in the batches not merged yet, and in the filters of the
    merged buckets; keys are read back only from buckets with a key that a filter lets through.

    The state is folded once and written first; the log is made from what is stored, so nothing of
    the batch has to be kept in memory.
    """
    spark = events.sparkSession
    written = tables.write_batch(
        transactions.collapse(events, insert_ops=insert_ops), layout.transactions, batch_id
    )
    path = f"{layout.transactions}/batch_id={batch_id}"
    state = tables.read_folders(spark, transaction_state_schema(), [path])
    kept: list[DataFrame] = []
    try:
        new = _not_yet_inserted(state, batch_id, layout, kept)
        newest = _clock(spark, layout, batch_id)
        late = metrics.is_late("transaction_timestamp", F.lit(newest).cast("long"))
        tables.write_batch(new.withColumn(LATE, late), layout.inserts, batch_id, LATE)
        _set_clock(spark, layout, batch_id, newest)
        return written
    finally:
        for df in kept:
            df.unpersist()


def _clock(spark: SparkSession, layout: Layout, before: int):
    """The latest transaction time in the log before a batch, in microseconds; None if there is none."""
    done = [n for n in tables.committed_batches(spark, layout.insert_clock) if n < before]
    if not done:
        return None
    return spark.read.schema("newest long").parquet(
        f"{layout.insert_clock}/batch_id={done[-1]}"
    ).first()[0]


def _set_clock(spark: SparkSession, layout: Layout, batch_id: int, before) -> None:
    rows = log_rows(spark, layout, [batch_id])
    newest = F.greatest(F.unix_micros(F.max("transaction_timestamp")), F.lit(before).cast("long"))
    tables.write_batch(rows.agg(newest.alias("newest")), layout.insert_clock, batch_id)


def log_rows(
    spark: SparkSession, layout: Layout, numbers: list[int] | None = None
) -> DataFrame:
    """The insert log with ``is_late`` and ``batch_id``, of some batches or all."""
    if numbers is None:
        numbers = tables.committed_batches(spark, layout.inserts)
    flag = T.StructField(LATE, T.BooleanType())
    rows = _folders(spark, layout.inserts, insert_schema(), numbers, flag)
    if rows is None:
        schema = T.StructType([*insert_schema().fields, flag, T.StructField("batch_id", T.LongType())])
        return spark.createDataFrame([], schema)
    return rows


def late_inserts(spark: SparkSession, layout: Layout) -> DataFrame:
    """Transactions that no window counts any more: a filter on folder names."""
    return log_rows(spark, layout).where(F.col(LATE))


def _not_yet_inserted(
    state: DataFrame, batch_id: int, layout: Layout, kept: list[DataFrame]
) -> DataFrame:
    key, spark = transactions.KEY, state.sparkSession
    inserts = transactions.first_inserts(state)
    merged = buckets.versions(spark, layout.transaction_rows, before=batch_id)
    upto = merged[-1] if merged else -1
    waiting = [
        n for n in tables.committed_batches(spark, layout.inserts) if upto < n < batch_id
    ]
    ids = T.StructType([T.StructField(key, T.StringType())])
    flag = T.StructField(LATE, T.BooleanType())
    recent = _folders(spark, layout.inserts, ids, waiting, flag)
    if recent is not None:
        inserts = inserts.join(recent.select(key), key, "left_anti")
    known = _merged_keys_like(inserts, batch_id, layout, kept)
    return inserts if known is None else inserts.join(known, key, "left_anti")


def _merged_keys_like(
    inserts: DataFrame, batch_id: int, layout: Layout, kept: list[DataFrame]
) -> DataFrame | None:
    """The merged keys in all buckets where some of ``inserts`` may be; None if there are none."""
    key, spark, n = transactions.KEY, inserts.sparkSession, layout.buckets
    filters = buckets.folders(spark, layout.transaction_keys, n, before=batch_id)
    if not filters:
        return None
    keyed = inserts.select(key, buckets.bucket_of(key, n).alias(buckets.BUCKET))
    stored = buckets.read(spark, layout.transaction_keys, buckets.SUMMARY_SCHEMA, filters)
    maybe = buckets.maybe_known(keyed, key, stored).persist(StorageLevel.MEMORY_AND_DISK)
    kept.append(maybe)
    touched = {r[0] for r in maybe.select(buckets.BUCKET).distinct().collect()}  # numbers of buckets
    rows = buckets.folders(spark, layout.transaction_rows, n, before=batch_id)
    rows = {k: path for k, path in rows.items() if k in touched}
    if not rows:
        return None
    known = buckets.read(spark, layout.transaction_rows, merged_schema(), rows)
    return known.where(PRESENT).select(key).join(maybe.select(key), key, "left_semi")


def _merged_rows(state: DataFrame) -> DataFrame:
    """State rows (bucket, key, first, last) to the columns of :func:`merged_schema`.

    Keys that were changed but never inserted wait in the same files, with no typed columns.
    """
    present = F.col(transactions.FIRST).isNotNull()
    typed = [c for c in row_schema().fieldNames() if c != transactions.KEY]
    return transactions.row_of(state).select(
        buckets.BUCKET,
        transactions.KEY,
        *[F.when(present, F.col(c)).alias(c) for c in typed],
        present.alias(PRESENT),
        transactions.FIRST,
        transactions.LAST,
    )


def waiting_batches(spark: SparkSession, layout: Layout, before: int | None = None) -> list[int]:
    merged = buckets.versions(spark, layout.transaction_rows, before)
    upto = merged[-1] if merged else -1
    done = tables.committed_batches(spark, layout.transactions)
    return [n for n in done if n > upto and (before is None or n < before)]


def compact_transactions(
    spark: SparkSession, layout: Layout, at_least: int = 1, before: int | None = None
) -> int | None:
    """Merges the waiting batches, if there are ``at_least`` so many, into the buckets they touch.

    Returns the last batch merged, or None if there were too few. Call it between batches.
    """
    _complete_filters(spark, layout)
    waiting = waiting_batches(spark, layout, before)
    if len(waiting) < max(1, at_least):
        return None
    state = _waiting_state(spark, layout, waiting)
    touched = {r[0] for r in state.select(buckets.BUCKET).distinct().collect()}  # numbers of buckets
    stored = buckets.folders(spark, layout.transaction_rows, layout.buckets)
    stored = {k: path for k, path in stored.items() if k in touched}
    old = buckets.read(spark, layout.transaction_rows, merged_schema(), stored)
    both = state.unionByName(old.select(*state.columns))
    gathered = buckets.gather(both, transactions.KEY)
    merged = transactions.merge_states(gathered, also=(buckets.BUCKET, buckets.PIECE))
    buckets.write(_merged_rows(merged), layout.transaction_rows, waiting[-1], gathered=True)
    _complete_filters(spark, layout)
    return waiting[-1]


def _complete_filters(spark: SparkSession, layout: Layout) -> None:
    """Writes the filters of the newest version of the rows, unless they are there."""
    done = buckets.versions(spark, layout.transaction_rows)
    if not done or done[-1] in buckets.versions(spark, layout.transaction_keys):
        return
    inside = f"{layout.transaction_rows}/{buckets.VERSION}={done[-1]}"
    numbers = tables.numbered(spark, inside, buckets.BUCKET)
    rows = buckets.read(
        spark,
        layout.transaction_rows,
        merged_schema(),
        {k: f"{inside}/{buckets.BUCKET}={k}" for k in numbers},
    )
    keyed = rows.where(PRESENT).select(buckets.BUCKET, transactions.KEY)
    filters = buckets.summary(keyed, transactions.KEY)
    buckets.write(filters, layout.transaction_keys, done[-1])


def _waiting_state(spark: SparkSession, layout: Layout, waiting: list[int]) -> DataFrame:
    paths = [f"{layout.transactions}/batch_id={n}" for n in waiting]
    rows = tables.read_folders(spark, transaction_state_schema(), paths)
    bucket = buckets.bucket_of(transactions.KEY, layout.buckets)
    return rows.withColumn(buckets.BUCKET, bucket)


def read_transactions(
    spark: SparkSession, layout: Layout, before: int | None = None
) -> DataFrame:
    """The current rows, or the table's version before a batch.

    Merged rows are a plain scan of the typed columns asked for. Only keys that a waiting batch
    touches are folded with it. A batch holds one row per key, so one alone needs no fold.
    """
    key, n = transactions.KEY, layout.buckets
    columns = row_schema().fieldNames()
    folders = buckets.folders(spark, layout.transaction_rows, n, before)
    merged = buckets.read(spark, layout.transaction_rows, merged_schema(), folders)
    plain = merged.where(PRESENT).select(*columns)
    waiting = waiting_batches(spark, layout, before)
    if not waiting:
        return plain
    recent = _waiting_state(spark, layout, waiting).drop(buckets.BUCKET)
    if not folders:
        state = recent if len(waiting) == 1 else transactions.merge_states(recent)
        return transactions.current_rows(state).select(*columns)
    touched = recent.select(key).distinct()
    old = merged.join(touched, key, "left_semi").select(*recent.columns)
    changed = transactions.current_rows(transactions.merge_states(old, recent))
    return plain.join(touched, key, "left_anti").unionByName(changed.select(*columns))


def version_at(spark: SparkSession, layout: Layout, instant_ms: int) -> int:
    """The number of the first batch that came after an instant: what ``before`` takes."""
    return tables.batch_after(spark, layout.transactions, instant_ms)


def changes_between(
    spark: SparkSession, layout: Layout, low: int, high: int | None, columns: Sequence[str]
) -> DataFrame:
    """Live rows created, changed and gone between the versions before two batches.

    Only keys that the batches in between touch are looked at.
    """
    numbers = [
        n
        for n in tables.committed_batches(spark, layout.transactions)
        if n >= low and (high is None or n < high)
    ]
    key = transactions.KEY
    touched = _waiting_state(spark, layout, numbers).select(key).distinct()

    def live(before: int | None) -> DataFrame:
        rows = transactions.live(read_transactions(spark, layout, before))
        return rows.join(touched, key, "left_semi")

    return snapshot.snapshot_diff(live(low), live(high), key, columns)


# --- customers ---------------------------------------------------------------------------------


def _folders(
    spark: SparkSession, path: str, schema: T.StructType, numbers: list[int], *partitions
) -> DataFrame | None:
    """Rows of the numbered batches with their ``batch_id``; None if there are no batches."""
    if not numbers:
        return None
    whole = T.StructType([*schema.fields, *partitions, T.StructField("batch_id", T.LongType())])
    paths = [f"{path}/batch_id={n}" for n in numbers]
    return spark.read.schema(whole).option("basePath", path).parquet(*paths)


def _stored_events(
    spark: SparkSession, layout: Layout, is_last: bool, after: int = -1, before: int | None = None
) -> DataFrame | None:
    numbers = [
        n
        for n in tables.committed_batches(spark, layout.customers)
        if n > after and (before is None or n < before)
    ]
    flag = T.StructField("is_last", T.BooleanType())
    rows = _folders(spark, layout.customers, followed_event_schema(), numbers, flag)
    # A filter on folder names: the other half is not read.
    return None if rows is None else rows.where(F.col("is_last") == is_last)


def customer_last_events(
    spark: SparkSession, layout: Layout, before: int | None = None
) -> DataFrame:
    """The last event of each customer, deletes included."""
    key, columns = customers.KEY, customers.EVENT_COLUMNS
    upto, base = tables.newest_compaction(
        spark, layout.customers, customer_event_schema(), before
    )
    recent = _stored_events(spark, layout, True, upto, before)
    if recent is None:
        return base
    recent = recent.select(*columns)
    if upto < 0:
        return customers.latest_events(recent)
    touched = recent.select(key).distinct()
    return base.join(touched, key, "left_anti").unionByName(
        customers.latest_events(base.join(touched, key, "left_semi").unionByName(recent))
    )


def customer_closed_events(
    spark: SparkSession, layout: Layout, before: int | None = None
) -> DataFrame:
    """Closed events as they now count: a scan, unless some batch brought late events."""
    schema = followed_event_schema()
    closed = _stored_events(spark, layout, False, before=before)
    if closed is None:
        return spark.createDataFrame([], schema)
    done = tables.committed_batches(spark, layout.customers)
    limit = done[-1] + 1 if before is None else before
    numbers = [n for n in tables.numbered(spark, layout.customer_reopened) if n < limit]
    key_schema = T.StructType([T.StructField(customers.KEY, T.StringType())])
    reopened = _folders(spark, layout.customer_reopened, key_schema, numbers)
    if reopened is not None:
        since = reopened.groupBy(customers.KEY).agg(F.max("batch_id").alias("_since"))
        closed = closed.join(since, customers.KEY, "left").where(
            F.col("_since").isNull() | (F.col("batch_id") >= F.col("_since"))
        )
    return closed.select(*schema.fieldNames())


def _followed(timeline: DataFrame) -> DataFrame:
    followed = customers.with_next(timeline)
    return followed.withColumn("is_last", F.col("_next_ts_ms").isNull())


def apply_customers(events: DataFrame, batch_id: int, layout: Layout) -> bool:
    """Adds cleaned events to the history as one batch, in one write.

    Closed events are appended and not touched again. Only where an event comes after a later
    one of the same customer has been stored are the customer's closed events read back and
    replaced, so the history does not depend on how the feed was cut. A replay starts from the
    same rows as the first attempt.

    The batch and the customers' last events are used several times, and kept for as long. A batch
    that finds nothing stored, like a backfill, is used once and not kept.
    """
    spark = events.sparkSession
    if tables.is_committed(spark, layout.customers, batch_id):
        return False
    key, columns = customers.KEY, customers.EVENT_COLUMNS
    events = events.select(*columns)
    if not any(n < batch_id for n in tables.committed_batches(spark, layout.customers)):
        return tables.write_batch(_followed(events), layout.customers, batch_id, "is_last")
    events = events.persist(StorageLevel.MEMORY_AND_DISK)
    known = customer_last_events(spark, layout, before=batch_id)
    known = known.join(events.select(key).distinct(), key, "left_semi")
    known = known.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        timeline = known.unionByName(events)
        late = customers.late_keys(events, known)
        if not late.isEmpty():
            path = f"{layout.customer_reopened}/batch_id={batch_id}"
            late.write.mode("overwrite").parquet(path)
            closed = customer_closed_events(spark, layout, before=batch_id)
            late = spark.read.schema(late.schema).parquet(path)
            again = filter_by_keys(closed, late, key, "left_semi", customers.POSITION)
            timeline = timeline.unionByName(again.select(*columns))
        return tables.write_batch(_followed(timeline), layout.customers, batch_id, "is_last")
    finally:
        known.unpersist()
        events.unpersist()


def read_customers(
    spark: SparkSession, layout: Layout, before: int | None = None
) -> DataFrame:
    """The whole history: closed versions and the open ones; or its version before a batch."""
    no_next = F.lit(None).cast("bigint").alias("_next_ts_ms")
    last = customer_last_events(spark, layout, before).select("*", no_next)
    closed = customer_closed_events(spark, layout, before)
    return customers.as_versions(closed.unionByName(last))


def compact_customers(spark: SparkSession, layout: Layout, at_least: int = 1) -> int | None:
    """Puts the last events of all customers together, if ``at_least`` so many batches are new."""
    upto, _ = tables.newest_compaction(spark, layout.customers, customer_event_schema())
    new = [n for n in tables.committed_batches(spark, layout.customers) if n > upto]
    if len(new) < max(1, at_least):
        return None
    return tables.compact(spark, layout.customers, customer_last_events(spark, layout))
