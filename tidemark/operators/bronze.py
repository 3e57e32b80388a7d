"""Raw change messages to typed, append-only rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import now_or
from tidemark.spec import (
    DATA_CLASSIFICATION,
    DATA_RESIDENCY,
    ENVELOPE,
    MARKER_NAMES,
    Entity,
    ddl,
    entity,
)


def normalize_temporal(df: DataFrame, spec: str | Entity) -> DataFrame:
    """Epoch micros to timestamps and epoch days to dates, as the entity declares."""
    spec = entity(spec)
    return df.withColumns(
        {
            **{name: F.timestamp_micros(name) for name in spec.micros},
            **{name: F.date_from_unix_date(name) for name in spec.days},
        }
    )


def parse_payload(feed: DataFrame, spec: Entity, *extra: str) -> DataFrame:
    """Flat payload columns of each message, next to the feed columns named in ``extra``.

    ``inline`` keeps the parser in one place: a filter on a parsed field would otherwise be
    pushed below the projection with a second parse of the same text.
    """
    body = F.from_json(F.col("value").cast("string"), spec.wire_schema)
    return feed.select(F.inline(F.array(body)), *extra)


def _tagged(
    parsed: DataFrame, spec: Entity, ingested_at, classification: str, residency: str
) -> DataFrame:
    """Payload, change markers and feed position to Bronze rows; rows without a key go."""
    stamp = now_or(ingested_at)
    return (
        normalize_temporal(parsed.where(F.col(spec.key).isNotNull()), spec)
        .withColumnsRenamed(
            {**MARKER_NAMES, "partition": "_feed_partition", "offset": "_feed_offset"}
        )
        .withColumns(
            {
                "_ingestion_timestamp": stamp,
                "_ingestion_date": F.to_date(stamp),
                "_entity_type": F.lit(spec.name),
                "_data_classification": F.lit(classification),
                "_data_residency": F.lit(residency),
            }
        )
        .select(*spec.bronze_schema.fieldNames())
    )


def parse_events(
    feed: DataFrame,
    spec: str | Entity,
    ingested_at=None,
    classification: str = DATA_CLASSIFICATION,
    residency: str = DATA_RESIDENCY,
) -> DataFrame:
    """Kafka-shaped messages to Bronze rows. Messages without a key are left out; they are
    what :func:`rejected_messages` returns."""
    spec = entity(spec)
    parsed = parse_payload(feed, spec, "partition", "offset")
    return _tagged(parsed, spec, ingested_at, classification, residency)


def parse_envelopes(
    feed: DataFrame,
    spec: str | Entity,
    ingested_at=None,
    classification: str = DATA_CLASSIFICATION,
    residency: str = DATA_RESIDENCY,
) -> DataFrame:
    """As :func:`parse_events`, for nested change envelopes: each is parsed once, and its image
    once. What yields no key is what :func:`rejected_envelopes` returns."""
    spec = entity(spec)
    row = _images(feed, ddl(spec.payload), "partition", "offset")
    parsed = row.select(
        *spec.columns,
        F.col("_op").alias("__op"),
        F.col("_source.ts_ms").alias("__source_ts_ms"),
        F.col("_source.db").alias("__source_db"),
        F.col("_source.table").alias("__source_table"),
        "partition",
        "offset",
    )
    return _tagged(parsed, spec, ingested_at, classification, residency)


def _put_aside(rows: DataFrame) -> DataFrame:
    text = F.col("value").cast("string")
    return rows.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.col("key").cast("string").alias("message_key"),
        text.alias("message"),
        F.when(F.col("value").isNull(), "TOMBSTONE")
        .when(F.try_parse_json(text).isNull(), "MALFORMED")
        .otherwise("NO_KEY")
        .alias("reason"),
    )


def rejected_messages(feed: DataFrame, spec: str | Entity) -> DataFrame:
    """Messages that yield no key, whole, with the reason. Only the key is parsed."""
    spec = entity(spec)
    only_key = T.StructType([T.StructField(spec.key, T.StringType())])
    key = F.from_json(F.col("value").cast("string"), only_key)[spec.key]
    return _put_aside(feed.where(F.col("value").isNull() | key.isNull()))


def rejected_envelopes(feed: DataFrame, spec: str | Entity) -> DataFrame:
    """Envelopes whose image yields no key, whole, with the reason."""
    spec = entity(spec)
    return _put_aside(
        _images(feed, None, *feed.columns)
        .withColumn("_id", F.get_json_object("_image", f"$.{spec.key}"))
        .where(F.col("_id").isNull())
    )


def _images(feed: DataFrame, schema: T.StructType | None, *extra: str) -> DataFrame:
    """Feed columns named in ``extra``, ``_op``, ``_source`` and the image of each envelope: its
    columns by ``schema``, or its text as ``_image``.

    Accepts ``before``/``after`` as objects or as JSON strings, with or without an outer
    ``payload`` field. Deletes carry the ``before`` image.
    """
    envelope = ddl(ENVELOPE)
    outer = T.StructType(envelope.fields + [T.StructField("payload", envelope)])
    body = feed.select(
        *extra, F.inline(F.array(F.from_json(F.col("value").cast("string"), outer)))
    ).select(
        *extra,
        *[
            F.coalesce(F.col(f"payload.{name}"), F.col(name)).alias(f"_{name}")
            for name in ("before", "after", "source", "op")
        ],
    )
    image = F.when(F.col("_op") == "d", F.col("_before")).otherwise(F.col("_after"))
    if schema is None:
        return body.select(*extra, "_op", "_source", image.alias("_image"))
    return body.select(*extra, "_op", "_source", F.inline(F.array(F.from_json(image, schema))))


def unwrap_envelope(feed: DataFrame, spec: str | Entity) -> DataFrame:
    """Nested change envelopes to the flat message form that :func:`parse_events` reads, for feeds
    that hold both kinds.

    Whatever is no envelope (tombstones, malformed text, messages that are flat already), and
    envelopes whose image yields no key, pass unchanged, so that what is rejected later is the
    message as it came.
    """
    spec = entity(spec)
    row = _images(feed, ddl(spec.payload), *feed.columns)
    flat = F.to_json(
        F.struct(
            *spec.columns,
            F.col("_op").alias("__op"),
            F.col("_source.ts_ms").alias("__source_ts_ms"),
            F.col("_source.db").alias("__source_db"),
            F.col("_source.table").alias("__source_table"),
            F.when(F.col("_op") == "d", "true").otherwise("false").alias("__deleted"),
        )
    )
    unread = F.col("_op").isNull() | F.col(spec.key).isNull()
    value = F.when(unread, F.col("value")).otherwise(flat.cast("binary"))
    return row.select(*[value.alias(c) if c == "value" else F.col(c) for c in feed.columns])
