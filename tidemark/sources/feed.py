"""Kafka-shaped message feeds, from Kafka or from files.

Every reader returns ``key, value, topic, partition, offset, timestamp``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.spec import KAFKA_RECORD, Entity, ddl, entity

# Admission and start position of the feed consumers.
MAX_OFFSETS_PER_TRIGGER = 1000
STARTING_OFFSETS = "earliest"


def kafka_options(
    topic: str,
    servers: str,
    starting: str = STARTING_OFFSETS,
    max_offsets: int | None = None,
    fail_on_data_loss: bool = False,
    min_partitions: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options of the Kafka source. A trigger takes all there is unless ``max_offsets`` is given;
    :data:`MAX_OFFSETS_PER_TRIGGER` suits small topics. ``min_partitions`` lets more tasks read a
    topic than it has partitions."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return {**options, **extra}


def stream_kafka(spark: SparkSession, spec: str | Entity, servers: str, **options) -> DataFrame:
    """Needs the Kafka connector package on the session."""
    settings = kafka_options(entity(spec).topic, servers, **options)
    return spark.readStream.format("kafka").options(**settings).load()


def read_kafka(spark: SparkSession, spec: str | Entity, servers: str, **options) -> DataFrame:
    """The topic's present content as a batch, e.g. for a backfill."""
    settings = kafka_options(entity(spec).topic, servers, max_offsets=None, **options)
    return spark.read.format("kafka").options(**settings).load()


def stream_files(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    tolerate_loss: bool = True,
) -> DataFrame:
    """A topic kept as Parquet files; files are taken in the order they were written."""
    reader = spark.readStream.schema(ddl(KAFKA_RECORD)).option(
        "ignoreMissingFiles", str(tolerate_loss).lower()
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ddl(KAFKA_RECORD)).parquet(path)


def feed_counts(feed: DataFrame) -> DataFrame:
    """Messages per topic, and the offsets spanned over all of its partitions."""
    per_partition = feed.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n"), (F.max("offset") - F.min("offset") + 1).alias("span")
    )
    return per_partition.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n_partitions"),
        F.sum("n").alias("n_messages"),
        F.sum("span").alias("offset_span"),
    )
