"""The test feeds as written."""

import glob

import pytest
from pyspark.sql import functions as F
from rows import same_rows

from tidemark.plans.workspace import Workspace
from tidemark.sources import derived, feed
from tidemark.spec import KAFKA_RECORD, ddl


@pytest.fixture(scope="module")
def messages(spark):
    n = F.col("id")
    return spark.range(3000).select(
        n.cast("string").cast("binary").alias("key"),
        F.repeat(n.cast("string"), 3).cast("binary").alias("value"),
        F.lit("t").alias("topic"),
        (n % 3).cast("int").alias("partition"),
        n.alias("offset"),
        F.timestamp_millis(F.floor(n / 2) * 1000).alias("timestamp"),
    )


@pytest.mark.parametrize("slices", [1, 3])
def test_files_hold_no_more_when_the_feed_grows(spark, messages, run_dir, slices):
    files = derived.write_slices(messages, run_dir, slices, 4, per_file=100)
    assert files == 3000 / (slices * 100)
    written = glob.glob(f"{run_dir}/*.parquet")
    assert len(written) == files * slices
    sizes = [spark.read.parquet(p).count() for p in written]
    assert max(sizes) < 150 and sum(sizes) == 3000
    same_rows(feed.read_files(spark, run_dir), messages.select(ddl(KAFKA_RECORD).fieldNames()))


def test_slices_follow_each_other_in_time(spark, messages, run_dir):
    files = derived.write_slices(messages, run_dir, 3, 4)
    assert files == 4
    rows = (
        spark.read.parquet(run_dir)
        .select(F.input_file_name().alias("file"), F.col("timestamp"))
        .withColumn("job", F.regexp_extract("file", r"part-\d+-([0-9a-f-]+)", 1))
    )
    spans = rows.groupBy("job").agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b"))
    spans = spans.orderBy("a").collect()
    assert len(spans) == 3
    assert all(x.b < y.a for x, y in zip(spans, spans[1:]))


def test_an_empty_feed_is_written(spark, messages, run_dir):
    assert derived.write_slices(messages.where("false"), run_dir, 3, 2) == 2
    assert feed.read_files(spark, run_dir).count() == 0


def test_messages_are_made_once_and_where_they_are_written(spark, run_dir):
    """A feed in three slices made the text of every message in every slice's shuffle."""
    made = spark.sparkContext.accumulator(0)
    rows = spark.range(3000).select(
        "id", F.timestamp_millis(F.floor(F.col("id") / 2) * 1000).alias("timestamp")
    )

    @F.udf("string")
    def text(n):
        made.add(1)
        return "x" * 1000

    plans = []

    def records(part):
        n = F.col("id")
        out = part.select(
            n.cast("string").cast("binary").alias("key"),
            text(n).cast("binary").alias("value"),
            F.lit("t").alias("topic"),
            (n % 3).cast("int").alias("partition"),
            n.alias("offset"),
            "timestamp",
        )
        plans.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out

    derived.write_slices(rows, run_dir, 3, 4, records=records)
    assert made.value == 3000
    assert all(p.index("text(") < p.index("Repartition") for p in plans) and len(plans) == 3
    assert feed.read_files(spark, run_dir).select("offset").distinct().count() == 3000


def test_rows_are_dealt_out_without_a_sort(spark, messages, run_dir):
    """Dealt out in turn, a slice's rows were sorted before they were sent."""
    plans = []

    def records(part):
        plans.append(part._jdf.queryExecution().executedPlan().toString())
        return part

    derived.write_slices(messages, run_dir, 3, 4, records=records)
    assert len(plans) == 3
    assert all("hashpartitioning" in p and "RoundRobin" not in p for p in plans)


def test_changes_of_customers_are_joined_once(spark):
    space = Workspace(spark, "/root/testdata/sf0.001")
    rows, _ = space._changes("customers")
    assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString()
    made = derived.customer_changes(space.table("customer"), space.table("orders"))
    same_rows(rows, made)


def test_rows_without_a_time_are_in_the_first_slice(spark, messages, run_dir):
    timeless = messages.limit(7).withColumn("timestamp", F.lit(None).cast("timestamp"))
    derived.write_slices(messages.unionByName(timeless), run_dir, 3, 2)
    same_rows(feed.read_files(spark, run_dir), messages.unionByName(timeless))
