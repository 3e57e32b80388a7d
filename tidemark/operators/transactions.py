"""Silver transactions: cleaning, and the keyed upsert.

The upsert keeps two events per key: the *first* valid insert and the *last* valid change.
Minimum and maximum do not care about grouping, order or repetition, so the state can be built
from any cut of the feed, in any order, with any batch replayed. Both also combine on the map
side, so a key with very many events sends one row per task through the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import clean_code, clean_text, event_time, money, now_or
from tidemark.spec import CHANGE_OPS, INSERT_OPS, VALID_TRANSACTION_TYPES

KEY = "transaction_id"
BUSINESS = (
    "account_id",
    "transaction_type",
    "amount",
    "currency",
    "merchant_name",
    "merchant_category",
    "transaction_timestamp",
    "country",
    "is_international",
    "status",
)
# States are folded in the order of their keys. Keys mostly begin alike, so that sorting them compares
# whole texts; by a number first, it hardly ever does.
_HASH = "_key_hash"
FIRST = "first_insert"
LAST = "last_change"


def normalize_transactions(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns(
        {
            "transaction_type": clean_code("transaction_type"),
            "amount": money("amount"),
            "currency": clean_code("currency"),
            "merchant_name": clean_text("merchant_name"),
            "merchant_category": clean_code("merchant_category"),
            "country": clean_code("country"),
            "status": clean_code("status"),
        }
    )


def is_valid_transaction() -> Column:
    """Tested on normalized columns. Zero is allowed here, unlike in the source table."""
    return (
        F.col(KEY).isNotNull()
        & F.col("amount").isNotNull()
        & (F.col("amount") >= 0)
        & F.col("transaction_type").isin(*VALID_TRANSACTION_TYPES)
    )


def clean_transactions(bronze: DataFrame) -> DataFrame:
    """Normalized, valid change events, one row per event."""
    return (
        normalize_transactions(bronze)
        .where(is_valid_transaction())
        .select(
            KEY,
            *BUSINESS,
            "cdc_operation",
            F.col("cdc_operation").eqNullSafe("d").alias("_is_deleted"),
            F.col("cdc_timestamp_ms").alias("_source_ts_ms"),
            F.col("_feed_offset").alias("_source_offset"),
        )
    )


def collapse(
    events: DataFrame,
    columns: Sequence[str] = BUSINESS,
    insert_ops: Sequence[str] = INSERT_OPS,
) -> DataFrame:
    """Events to one state row per key. ``columns`` limits what is carried, and so what is read.

    ``insert_ops=("c",)`` leaves rows that came with the initial snapshot out.
    """
    op = F.col("cdc_operation")
    grouped = events.where(op.isin(*insert_ops, *CHANGE_OPS)).groupBy(F.xxhash64(KEY).alias(_HASH), KEY)
    return grouped.agg(*_fold(columns, insert_ops)).drop(_HASH)


def _fold(columns: Sequence[str], insert_ops: Sequence[str], counts: Column | None = None):
    image = F.struct("_source_ts_ms", "_source_offset", *columns, "_is_deleted")
    op, counts = F.col("cdc_operation"), F.lit(True) if counts is None else counts
    return [
        F.min(F.when(op.isin(*insert_ops) & counts, image)).alias(FIRST),
        F.max(F.when(op.isin(*CHANGE_OPS) & counts, image)).alias(LAST),
    ]


def live_at_two_times(
    events: DataFrame,
    early: Column,
    columns: Sequence[str],
    insert_ops: Sequence[str] = INSERT_OPS,
) -> DataFrame:
    """Per key the live row's ``columns`` by the events for which ``early`` holds, ``before``, and by
    all events, ``after``; null where there is none. One scan, one aggregation, no join."""
    first, last = _fold(columns, insert_ops)
    early_first, early_last = _fold(columns, insert_ops, early)
    both = (
        events.where(F.col("cdc_operation").isin(*insert_ops, *CHANGE_OPS))
        .groupBy(KEY)
        .agg(
            F.struct(early_first, early_last).alias("_early"), F.struct(first, last).alias("_all")
        )
    )

    def row(state: str) -> Column:
        one, two = F.col(f"{state}.{FIRST}"), F.col(f"{state}.{LAST}")
        newer = F.struct(two["_source_ts_ms"], two["_source_offset"]) > F.struct(
            one["_source_ts_ms"], one["_source_offset"]
        )
        current = F.when(F.coalesce(newer, F.lit(False)), two).otherwise(one)
        live = one.isNotNull() & ~current["_is_deleted"]
        return F.when(live, F.struct(*[current[c].alias(c) for c in columns]))

    return both.select(KEY, row("_early").alias("before"), row("_all").alias("after"))


def merge_states(*states: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Several state relations to one, e.g. the stored table and a new batch. ``also`` names
    columns that depend on the key alone and are kept."""
    union = states[0]
    for other in states[1:]:
        union = union.unionByName(other)
    return union.groupBy(*also, KEY).agg(F.min(FIRST).alias(FIRST), F.max(LAST).alias(LAST))


def merge_into(base: DataFrame, recent: DataFrame) -> DataFrame:
    """As :func:`merge_states`, for a large ``base`` with one row per key and a smaller
    ``recent``: base rows that ``recent`` does not touch pass through without a shuffle as long
    as Spark finds the touched keys small enough to broadcast."""
    touched = recent.select(KEY).distinct()
    return base.join(touched, KEY, "left_anti").unionByName(
        merge_states(base.join(touched, KEY, "left_semi"), recent)
    )


def _changed() -> Column:
    newer = F.struct(f"{LAST}._source_ts_ms", f"{LAST}._source_offset") > F.struct(
        f"{FIRST}._source_ts_ms", f"{FIRST}._source_offset"
    )
    return F.coalesce(newer, F.lit(False))


def row_of(
    state: DataFrame, columns: Sequence[str] = BUSINESS, processed_at=None
) -> DataFrame:
    """State rows with the columns of the current-state table added: the first insert, overwritten
    by the last later change. For keys that were never inserted they mean nothing."""
    return state.withColumn("_row", F.when(_changed(), F.col(LAST)).otherwise(F.col(FIRST))).select(
        *state.columns,
        *[F.col(f"_row.{c}").alias(c) for c in columns],
        event_time(f"{FIRST}._source_ts_ms").alias("_created_at"),
        event_time("_row._source_ts_ms").alias("_updated_at"),
        F.col("_row._is_deleted").alias("_is_deleted"),
        now_or(processed_at).alias("_silver_processed_at"),
        F.col("_row._source_ts_ms").alias("_source_ts_ms"),
        F.col("_row._source_offset").alias("_source_offset"),
    )


def current_rows(
    state: DataFrame, columns: Sequence[str] = BUSINESS, processed_at=None
) -> DataFrame:
    """State to the current-state table. Deleted rows stay, flagged."""
    rows = row_of(state.where(F.col(FIRST).isNotNull()), columns, processed_at)
    return rows.drop(FIRST, LAST)


def inserted_keys(events: DataFrame, insert_ops: Sequence[str] = INSERT_OPS) -> DataFrame:
    """The keys of the current-state table, each once, without the work for its columns: a key has a
    row in it if it has a valid insert."""
    return events.where(F.col("cdc_operation").isin(*insert_ops)).select(KEY).distinct()


def orphan_changes(state: DataFrame) -> DataFrame:
    """Keys that were changed but never validly inserted."""
    return state.where(F.col(FIRST).isNull()).select(KEY, f"{LAST}.*")


def first_inserts(state: DataFrame) -> DataFrame:
    """The insert log: every key as it stood when it first came in."""
    return state.where(F.col(FIRST).isNotNull()).select(KEY, f"{FIRST}.*")


def live(rows: DataFrame) -> DataFrame:
    """Rows that are not deleted; an unknown flag counts as deleted."""
    return rows.where(~F.col("_is_deleted"))


def upsert(
    bronze: DataFrame,
    columns: Sequence[str] = BUSINESS,
    insert_ops: Sequence[str] = INSERT_OPS,
    processed_at=None,
) -> DataFrame:
    """Bronze to the current-state table in one batch."""
    state = collapse(clean_transactions(bronze), columns, insert_ops)
    return current_rows(state, columns, processed_at)
