"""Silver customers: cleaning, and the history with validity intervals.

Every valid change event is a version that holds until the next event of the same customer.
A delete closes the version before it and opens none. Times are source times, so intervals
of one customer meet exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import clean_code, clean_text, event_time, now_or
from tidemark.operators.latest import latest_per_key
from tidemark.operators.skew import with_neighbour
from tidemark.spec import SILVER_CUSTOMERS, ddl

KEY = "customer_id"
ATTRIBUTES = (
    "first_name",
    "last_name",
    "email",
    "phone",
    "date_of_birth",
    "nationality",
    "risk_score",
    "kyc_status",
    "onboarding_date",
    "customer_segment",
    "country_residence",
)
POSITION = ("_source_ts_ms", "_source_offset")
EVENT_COLUMNS = (KEY, *ATTRIBUTES, "cdc_operation", "_ingestion_timestamp", *POSITION)


def is_valid_customer() -> Column:
    return F.col(KEY).isNotNull() & F.col("email").isNotNull()


def clean_customers(bronze: DataFrame) -> DataFrame:
    """Normalized, valid change events. Names, mail and phone keep their case."""
    return (
        bronze.withColumns(
            {
                **{c: clean_text(c) for c in ("first_name", "last_name", "email", "phone")},
                **{
                    c: clean_code(c)
                    for c in ("nationality", "kyc_status", "customer_segment", "country_residence")
                },
                "risk_score": F.col("risk_score").try_cast("int"),
                "_source_ts_ms": F.col("cdc_timestamp_ms"),
                "_source_offset": F.col("_feed_offset"),
            }
        )
        .where(is_valid_customer())
        .select(*EVENT_COLUMNS)
    )


def order() -> list[Column]:
    return [F.col(c) for c in POSITION]


def with_next(events: DataFrame) -> DataFrame:
    """Adds ``_next_ts_ms``, the time of the customer's following event."""
    time = F.col("_source_ts_ms")
    return with_neighbour(events, [KEY], order(), "_next_ts_ms", time, 1, time)


def as_versions(followed: DataFrame, processed_at=None) -> DataFrame:
    """Events with ``_next_ts_ms`` to versions; a delete is none. Position columns stay."""
    return followed.where(~F.col("cdc_operation").eqNullSafe("d")).select(
        *EVENT_COLUMNS,
        event_time("_source_ts_ms").alias("effective_from"),
        event_time("_next_ts_ms").alias("effective_to"),
        F.col("_next_ts_ms").isNull().alias("is_current"),
        event_time("_source_ts_ms").alias("_created_at"),
        event_time(F.coalesce("_next_ts_ms", "_source_ts_ms")).alias("_updated_at"),
        now_or(processed_at).alias("_silver_processed_at"),
    )


def close_intervals(events: DataFrame, processed_at=None) -> DataFrame:
    """Events to versions with ``effective_from``, ``effective_to`` and ``is_current``."""
    return as_versions(with_next(events), processed_at)


def changes_only(events: DataFrame) -> DataFrame:
    """Drops events that repeat the attributes and liveness of the event before them."""
    image = F.struct(*ATTRIBUTES, F.col("cdc_operation").eqNullSafe("d").alias("_gone"))
    time = F.col("_source_ts_ms")
    paired = with_neighbour(events, [KEY], order(), "_before", image, -1, time)
    return paired.where(~image.eqNullSafe(F.col("_before"))).drop("_before")


def history(bronze: DataFrame, only_changes: bool = False, processed_at=None) -> DataFrame:
    """Bronze to the whole history table in one batch."""
    events = clean_customers(bronze)
    if only_changes:
        events = changes_only(events)
    return close_intervals(events, processed_at)


def as_table(versions: DataFrame) -> DataFrame:
    return versions.select(*ddl(SILVER_CUSTOMERS).fieldNames())


def valid_at(versions: DataFrame, instant: Column) -> DataFrame:
    """The same question asked of a stored history table: a filter on its intervals."""
    return versions.where(
        (F.col("effective_from") <= instant)
        & (F.col("effective_to").isNull() | (instant < F.col("effective_to")))
    )


def late_keys(events: DataFrame, last_events: DataFrame) -> DataFrame:
    """Customers with an event that precedes what is already their last one.

    ``last_events`` has one row per customer, and events are reduced to their first position per
    customer, so the join is between unique keys.
    """
    first = events.groupBy(KEY).agg(F.min(F.struct(*POSITION)).alias("_first"))
    last = last_events.select(KEY, F.struct(*POSITION).alias("_last"))
    return first.join(last, KEY).where(F.col("_first") < F.col("_last")).select(KEY)


def latest_events(events: DataFrame, columns: Sequence[str] = EVENT_COLUMNS) -> DataFrame:
    """The last event of each customer, deletes included. ``columns`` limits what is read."""
    return latest_per_key(events, KEY, POSITION, columns)


def as_of(
    events: DataFrame, instant_ms: int | None = None, columns: Sequence[str] = EVENT_COLUMNS
) -> DataFrame:
    """Customers as they stood at an instant (epoch milliseconds), or now.

    Needs no intervals: the last event up to the instant decides, which is one combined
    aggregation behind a filter that reaches the scan. ``columns`` limits what is read.
    """
    if instant_ms is not None:
        events = events.where(F.col("_source_ts_ms") <= F.lit(instant_ms))
    read = list(dict.fromkeys([*columns, "cdc_operation"]))
    alive = latest_events(events, read).where(~F.col("cdc_operation").eqNullSafe("d"))
    return alive.select(*columns)
