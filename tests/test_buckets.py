import random

import pytest
from pyspark.sql import functions as F
from rows import messages, same_rows, transaction

from tidemark.operators import bronze, transactions
from tidemark.plans import silver
from tidemark.plans.layout import Layout
from tidemark.sources import buckets, tables
from tidemark.spec import TRANSACTIONS

CLOCK = "_silver_processed_at"


def events(spark, rows, start=0):
    parsed = bronze.parse_events(messages(spark, rows, start=start), TRANSACTIONS)
    return transactions.clean_transactions(parsed)


def drawn(seed, n, keys):
    r = random.Random(seed)
    return [
        transaction(r.randrange(keys), r.choice("ccruud"), r.randrange(40), amount=float(r.randrange(99)))
        for _ in range(n)
    ]


def current(spark, rows):
    return transactions.upsert(bronze.parse_events(messages(spark, rows), TRANSACTIONS))


def insert_log(spark, layout):
    rows = spark.read.parquet(layout.inserts).select("transaction_id", "batch_id").collect()
    return sorted(tuple(r) for r in rows)


@pytest.mark.parametrize("every", [1, 3])
def test_merged_or_not_the_table_is_the_upsert(spark, run_dir, every):
    layout = Layout(run_dir, buckets=5)
    rows, firsts = drawn(every, 60, 25), {}
    for n in range(6):
        part = rows[10 * n : 10 * n + 10]
        silver.compact_transactions(spark, layout, every, before=n)
        silver.apply_transactions(events(spark, part, 10 * n), n, layout)
        if n == 3:  # a replay, with a merge in between, changes nothing
            silver.compact_transactions(spark, layout, 1, before=n)
            silver.apply_transactions(events(spark, part, 10 * n), n, layout)
        for r in part:
            if r["__op"] in "cr":
                firsts.setdefault(r["transaction_id"], n)
        if n in (2, 5):
            want = current(spark, rows[: 10 * n + 10]).drop(CLOCK)
            same_rows(silver.read_transactions(spark, layout).drop(CLOCK), want)
    assert insert_log(spark, layout) == sorted(firsts.items())
    silver.compact_transactions(spark, layout)
    assert silver.waiting_batches(spark, layout) == []
    same_rows(silver.read_transactions(spark, layout).drop(CLOCK), current(spark, rows).drop(CLOCK))
    earlier = silver.read_transactions(spark, layout, before=3).drop(CLOCK)
    same_rows(earlier, current(spark, rows[:30]).drop(CLOCK))


def test_merged_rows_are_a_plain_scan_of_the_columns_asked_for(spark, run_dir):
    layout = Layout(run_dir, buckets=3)
    silver.apply_transactions(events(spark, drawn(7, 30, 12)), 0, layout)
    silver.compact_transactions(spark, layout)
    rows = silver.read_transactions(spark, layout)
    assert rows.columns == silver.row_schema().fieldNames()
    assert [f.dataType for f in rows.schema] == [f.dataType for f in silver.row_schema()]
    plan = rows.select("account_id", "amount")._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan and "Window" not in plan
    assert "ReadSchema: struct<account_id:string,amount:decimal(18,2),_is_present:boolean>" in plan


def test_only_touched_buckets_are_written_again(spark, run_dir):
    layout = Layout(run_dir, buckets=16)
    silver.apply_transactions(events(spark, [transaction(k) for k in range(200)]), 0, layout)
    silver.compact_transactions(spark, layout)
    first = tables.numbered(spark, f"{layout.transaction_rows}/upto=0", "bucket")
    assert first == list(range(16))
    silver.apply_transactions(events(spark, [transaction(3, "u", 10**15)], 500), 1, layout)
    silver.compact_transactions(spark, layout)
    again = tables.numbered(spark, f"{layout.transaction_rows}/upto=1", "bucket")
    assert len(again) == 1
    folders = buckets.folders(spark, layout.transaction_rows, 16)
    assert [p.split("/")[-2] for k, p in folders.items() if k in again] == ["upto=1"]
    assert silver.read_transactions(spark, layout).count() == 200


def test_an_interrupted_merge_is_done_again(spark, run_dir):
    layout = Layout(run_dir, buckets=2)
    for n in range(2):
        silver.apply_transactions(events(spark, [transaction(n)], n), n, layout)
    broken = f"{layout.transaction_rows}/upto=1"
    spark.createDataFrame([(9, 0)], "x int, bucket int").write.partitionBy("bucket").parquet(broken)
    path, fs = tables._path(spark, f"{broken}/{tables.COMMIT_MARKER}")
    fs.delete(path, False)
    assert silver.read_transactions(spark, layout).count() == 2
    assert silver.compact_transactions(spark, layout) == 1
    assert silver.read_transactions(spark, layout).count() == 2
    # Rows without their filters, as after a stop between the two writes.
    silver.apply_transactions(events(spark, [transaction(5)], 5), 2, layout)
    assert silver.compact_transactions(spark, layout, at_least=5) is None
    assert buckets.versions(spark, layout.transaction_keys) == [1]


def test_what_a_batch_reads_stays_flat_over_fifty_batches(spark, run_dir, monkeypatch):
    """All batches touch all buckets; some bring transactions again, some soon and some late."""
    layout, every = Layout(run_dir, buckets=4), 10
    read = {"log": [], "rows": []}
    of_log, of_rows = silver._folders, buckets.read

    def folders(spark_, path, schema, numbers, *more):
        if path == layout.inserts:
            read["log"].append(len(numbers))
        return of_log(spark_, path, schema, numbers, *more)

    def rows_read(spark_, path, schema, chosen):
        if path == layout.transaction_rows and during_batch:
            read["rows"].append(len(chosen))
        return of_rows(spark_, path, schema, chosen)

    monkeypatch.setattr(silver, "_folders", folders)
    monkeypatch.setattr(buckets, "read", rows_read)
    want = {}
    for n in range(50):
        during_batch = False
        silver.compact_transactions(spark, layout, every, before=n)
        ids = list(range(12 * n, 12 * n + 12))
        if n in (15, 33):
            ids += [1, 12 * n - 130]  # merged long ago
        if n in (16, 40):
            ids += [12 * n - 5]  # still waiting
        for k in ids:
            want.setdefault(f"T{k}", n)
        during_batch = True
        state = spark.createDataFrame(
            [(f"T{k}", n, k) for k in ids], "transaction_id string, _source_ts_ms long, _source_offset long"
        )
        types = silver.transaction_state_schema()["first_insert"].dataType
        blank = {f.name: F.lit(None).cast(f.dataType) for f in types if f.name not in state.columns}
        rows = state.withColumns({**blank, "_is_deleted": F.lit(False), "cdc_operation": F.lit("c")})
        silver.apply_transactions(rows, n, layout)
    assert insert_log(spark, layout) == sorted(want.items())
    assert max(read["log"]) <= every
    # Merged keys are only met by the transactions that came again, in their own buckets.
    assert len(read["rows"]) <= 6 and max(read["rows"]) <= 2


def test_filters_let_every_key_through_and_few_others(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("T"), "id").alias("key"))
    keyed = keys.withColumn("bucket", buckets.bucket_of("key", 3))
    filters = buckets.summary(keyed, "key")
    assert {r.n for r in filters.groupBy("bucket").agg(F.max("n_slots").alias("n")).collect()} == {4}
    assert buckets.maybe_known(keyed, "key", filters).count() == 20_000
    others = spark.range(20_000).select(F.concat(F.lit("U"), "id").alias("key"))
    others = others.withColumn("bucket", buckets.bucket_of("key", 3))
    assert buckets.maybe_known(others, "key", filters).count() < 60


def test_a_merge_shuffles_its_rows_once(spark, run_dir):
    """Rows come together by bucket and piece; folded there, they are in the order of buckets."""
    state = spark.range(100).select(
        F.col("id").cast("string").alias("transaction_id"),
        buckets.bucket_of(F.col("id").cast("string"), 4).alias(buckets.BUCKET),
        F.struct(F.col("id").cast("string").alias("v")).alias(transactions.FIRST),
        F.struct(F.col("id").cast("string").alias("v")).alias(transactions.LAST),
    )
    gathered = buckets.gather(state, "transaction_id")
    merged = transactions.merge_states(gathered, also=(buckets.BUCKET, buckets.PIECE))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    buckets.write(merged.drop(buckets.PIECE), run_dir, 0, gathered=True)
    back = spark.read.parquet(f"{run_dir}/upto=0")
    assert back.count() == 100 and back.select(buckets.BUCKET).distinct().count() == 4
