import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import session
from tidemark.sources import feed, tables
from tidemark.spec import CUSTOMERS, TRANSACTIONS

SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def content(df):
    return sorted(tuple(r) for r in df.collect())


def test_create_if_missing(spark, run_dir):
    path = f"{run_dir}/t"
    assert not tables.exists(spark, path)
    assert tables.create_if_missing(spark, path, SCHEMA)
    assert not tables.create_if_missing(spark, path, SCHEMA)
    assert spark.read.parquet(path).schema.fieldNames() == ["k", "v"]


def test_partitioned_creation(spark, run_dir):
    spec = CUSTOMERS.bronze_schema
    assert tables.create_if_missing(spark, f"{run_dir}/b", spec, "_ingestion_date")
    assert spark.read.schema(spec).parquet(f"{run_dir}/b").count() == 0


def test_a_batch_is_written_once(spark, run_dir):
    assert tables.write_batch(frame(spark, (1, "a")), run_dir, 0)
    assert not tables.write_batch(frame(spark, (2, "b")), run_dir, 0)
    base, recent = tables.read_parts(spark, run_dir, SCHEMA)
    assert base is None and content(recent) == [(1, "a")]


def test_leftovers_of_an_interrupted_batch_are_not_read_but_replaced(spark, run_dir):
    tables.write_batch(frame(spark, (1, "a")), run_dir, 0)
    frame(spark, (9, "z")).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{run_dir}/batch_id=1")
    assert tables.committed_batches(spark, run_dir) == [0]
    assert content(tables.read_parts(spark, run_dir, SCHEMA)[1]) == [(1, "a")]
    assert tables.write_batch(frame(spark, (2, "b")), run_dir, 1)
    assert content(tables.read_parts(spark, run_dir, SCHEMA)[1]) == [(1, "a"), (2, "b")]


def test_reading_as_before_a_batch(spark, run_dir):
    for n in range(3):
        tables.write_batch(frame(spark, (n, "x")), run_dir, n)
    assert content(tables.read_parts(spark, run_dir, SCHEMA, before=2)[1]) == [(0, "x"), (1, "x")]
    assert content(tables.read_parts(spark, run_dir, SCHEMA, before=0)[1]) == []


def test_compaction_takes_over_the_batches_it_holds(spark, run_dir):
    assert tables.compact(spark, run_dir, frame(spark)) is None
    for n in range(3):
        tables.write_batch(frame(spark, (n, "x")), run_dir, n)
    combined = tables.read_parts(spark, run_dir, SCHEMA)[1].withColumn("v", F.lit("sum"))
    assert tables.compact(spark, run_dir, combined) == 2
    tables.write_batch(frame(spark, (3, "x")), run_dir, 3)
    base, recent = tables.read_parts(spark, run_dir, SCHEMA)
    assert content(base) == [(0, "sum"), (1, "sum"), (2, "sum")]
    assert content(recent) == [(3, "x")]
    # A replay of batch 2 must not see what batch 2 itself contributed.
    base, recent = tables.read_parts(spark, run_dir, SCHEMA, before=2)
    assert base is None and content(recent) == [(0, "x"), (1, "x")]


def test_kafka_options():
    options = feed.kafka_options(
        TRANSACTIONS.topic, "host:9093", max_offsets=feed.MAX_OFFSETS_PER_TRIGGER
    )
    assert options == {
        "kafka.bootstrap.servers": "host:9093",
        "subscribe": "cdc.public.transactions",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "1000",
    }
    big = feed.kafka_options("t", "h", min_partitions=64)
    assert "maxOffsetsPerTrigger" not in big and big["minPartitions"] == "64"


def test_feed_counts(spark):
    rows = [("a", 0, 5), ("a", 0, 7), ("a", 1, 1), ("b", 0, 0)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint")
    out = {r.topic: tuple(r)[1:] for r in feed.feed_counts(df).collect()}
    assert out == {"a": (2, 3, 4), "b": (1, 1, 1)}


def test_shared_dir_is_the_one_the_session_names(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    first, second = session.new_run_dir(spark, "x"), session.new_run_dir(spark, "x")
    assert first != second and first.startswith(session.shared_dir(spark))


def test_a_cluster_must_name_its_shared_dir():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
