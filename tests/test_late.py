import random

import pytest
from pyspark.sql import functions as F
from rows import MINUTE_US, T0_US, customer, messages, transaction
from test_streaming import Topic, at, beat, catch_up, gold

from tidemark.operators import bronze, metrics, quality, transactions
from tidemark.plans import silver
from tidemark.plans.layout import Layout
from tidemark.sources import tables
from tidemark.spec import CUSTOMERS, TRANSACTIONS
from tidemark.streaming import jobs, run


def events(spark, rows, start=0):
    parsed = bronze.parse_events(messages(spark, rows, start=start), TRANSACTIONS)
    return transactions.clean_transactions(parsed)


@pytest.mark.parametrize("gold_after", ["each", "all"])
def test_every_insert_is_counted_or_late(spark, run_dir, gold_after):
    """Whatever portions the metrics query reads the log in."""
    r, layout, sent = random.Random(5), Layout(run_dir, buckets=2), 0
    rows = []
    for n in range(6):
        centre = 70 * n
        part = [at(100 * n + k, max(0, centre + r.randint(-150, 30)), account_id=f"A{k % 2}") for k in range(8)]
        part += [at(100 * (n - 1) + 1, centre)] if n else []  # comes again with another time
        silver.apply_transactions(events(spark, part, sent), n, layout)
        sent += len(part)
        rows += part
        if gold_after == "each":
            run.await_all([jobs.start_metrics(spark, layout, jobs.CATCH_UP)])
    silver.apply_transactions(events(spark, [beat(5000)], sent), 6, layout)
    for _ in range(2):
        run.await_all([jobs.start_metrics(spark, layout, jobs.CATCH_UP)])
    counted = spark.read.parquet(layout.metrics).where("account_id <> 'BEAT'")
    n_counted = counted.agg(F.sum("transaction_count")).first()[0]
    late = [x.transaction_id for x in silver.late_inserts(spark, layout).collect()]
    assert len(late) == len(set(late)) > 0
    assert n_counted + len(late) == len({x["transaction_id"] for x in rows})
    # By the definition: the window ended ten minutes before the latest time of earlier batches.
    first, newest, want = {}, None, set()
    for x in silver.log_rows(spark, layout).orderBy("batch_id").collect():
        first.setdefault(x.batch_id, []).append(x)
    for n in sorted(first):
        for x in first[n]:
            minute = (x.transaction_timestamp.timestamp() * 1e6 - T0_US) / MINUTE_US
            if newest is not None and (minute // 60 + 1) * 60 <= newest - 10:
                want.add(x.transaction_id)
        newest = max([newest or 0, *((x.transaction_timestamp.timestamp() * 1e6 - T0_US) / MINUTE_US for x in first[n])])
    assert set(late) == want


def test_rows_without_a_time_are_not_late(spark, run_dir):
    layout = Layout(run_dir)
    silver.apply_transactions(events(spark, [at(1, 900)]), 0, layout)
    rows = [at(2, 0), transaction(3, transaction_timestamp=None)]
    silver.apply_transactions(events(spark, rows, 5), 1, layout)
    assert [x.transaction_id for x in silver.late_inserts(spark, layout).collect()] == ["T2"]
    logged = {x.transaction_id: x.is_late for x in silver.log_rows(spark, layout).collect()}
    assert logged == {"T1": False, "T2": True, "T3": False}
    assert silver.log_rows(spark, Layout(run_dir + "/none")).count() == 0


def test_windows_end_where_sparks_windows_end(spark):
    edges = [-1, 0, 1, 60 * MINUTE_US - 1, 60 * MINUTE_US, T0_US, T0_US + 1, T0_US - 1]
    rows = spark.createDataFrame([(x,) for x in edges], "us long").withColumn("t", F.timestamp_micros("us"))
    end = F.unix_micros(F.window("t", metrics.WINDOW)["end"])
    for wait in (0, 1):
        # Late exactly from ten minutes after the window's end on.
        newest = F.col("end") + 10 * MINUTE_US - wait
        late = rows.withColumn("end", end).select(metrics.is_late("t", newest).alias("late"))
        assert {r.late for r in late.collect()} == {wait == 0}


def test_late_rows_leave_the_windows_alone(spark, run_dir, layout):
    topic = Topic(spark, f"{run_dir}/topic")
    topic.send(at(1, 0), beat(200))
    catch_up(spark, topic, layout)
    topic.send(at(2, 1))
    catch_up(spark, topic, layout)
    topic.send(beat(900))
    catch_up(spark, topic, layout)
    assert gold(spark, layout)[("A1", 0)] == 1
    assert [x.transaction_id for x in silver.late_inserts(spark, layout).collect()] == ["T2"]


def test_versions_by_time_and_the_changes_between_them(spark, run_dir):
    layout = Layout(run_dir, buckets=3)
    parts = [
        [transaction(1), transaction(2), transaction(3)],
        [transaction(1, "u", 10**14, amount=99.0), transaction(4)],
        [transaction(2, "d", 10**14), transaction(3, "u", 10**14)],
    ]
    stamps = []
    for n, part in enumerate(parts):
        silver.apply_transactions(events(spark, part, 10 * n), n, layout)
        marker, fs = tables._path(spark, f"{layout.transactions}/batch_id={n}/_SUCCESS")
        stamps.append(fs.getFileStatus(marker).getModificationTime())
        if n == 1:
            silver.compact_transactions(spark, layout)
    assert silver.version_at(spark, layout, stamps[0] - 1) == 0
    assert silver.version_at(spark, layout, stamps[2]) == 3
    for n, stamp in enumerate(stamps[:2]):
        if stamp < stamps[n + 1]:
            assert silver.version_at(spark, layout, stamp) == n + 1

    def between(low, high):
        rows = silver.changes_between(spark, layout, low, high, ("amount",)).collect()
        return sorted((x.transaction_id, x.op) for x in rows)

    assert between(0, 1) == [("T1", "c"), ("T2", "c"), ("T3", "c")]
    assert between(1, 2) == [("T1", "u"), ("T4", "c")]
    assert between(1, None) == [("T1", "u"), ("T2", "d"), ("T4", "c")]
    assert between(2, 2) == []
    assert silver.version_at(spark, Layout(run_dir + "/none"), 0) == 0


def test_row_violations_name_every_broken_rule(spark):
    rows = [
        customer(1, kyc_status=None, risk_score=0, email=None, last_name=None),
        customer(2, customer_segment="vip", kyc_status="nope"),
        customer(3),
    ]
    parsed = bronze.parse_events(messages(spark, rows, CUSTOMERS.topic), CUSTOMERS)
    out = {x.key_value: x for x in quality.row_violations(parsed, "customers").collect()}
    assert set(out) == {"C1", "C2"}
    assert out["C1"].broken == ["range:risk_score", "not_null:last_name", "not_null:email"]
    assert out["C2"].broken == ["domain:kyc_status", "domain:customer_segment"]
    names = list(quality.rules("customers"))
    for x in out.values():
        assert x.mask == sum(1 << names.index(n) for n in x.broken)
    plan = quality.row_violations(parsed, "customers")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_violations_are_a_stream_of_their_own(spark, run_dir, layout):
    topic = Topic(spark, f"{run_dir}/topic")
    for k, status in enumerate(["completed", "odd", "pending"]):
        topic.send(transaction(k, status=status, amount=-1.0 if k == 2 else 5.0))
        run.catch_up_bronze(lambda _: topic.stream(), layout, ["transactions"])
        run.await_all([jobs.start_violations(spark, "transactions", layout, jobs.CATCH_UP)])
    out = spark.read.parquet(layout.violations("transactions")).collect()
    assert sorted((x.key_value, x.broken) for x in out) == [
        ("T1", ["domain:status"]), ("T2", ["range:amount"])]


def test_batches_are_kept_as_rows(spark, run_dir, layout):
    topic = Topic(spark, f"{run_dir}/topic")
    topic.send(at(1, 0), at(2, 0), None)
    table = run.batch_table(spark, layout)
    try:
        for _ in range(2):
            run.catch_up_bronze(lambda _: topic.stream(), layout, ["transactions"])
            topic.send(at(3, 0))
        spark._jsc.sc().listenerBus().waitUntilEmpty()
        assert table.flush(spark) == 4 and table.flush(spark) == 0
    finally:
        spark.streams.removeListener(table)
    rows = run.read_batch_log(spark, layout).orderBy("query", "batch_id").collect()
    assert [(r.query, r.batch_id, r.input_rows, r.observed) for r in rows] == [
        ("bronze-transactions", 0, 3, {"bronze_transactions.rows": 2}),
        ("bronze-transactions", 1, 1, {"bronze_transactions.rows": 1}),
        ("rejected-transactions", 0, 3, {}),
        ("rejected-transactions", 1, 1, {}),
    ]
    assert all(r.duration_ms > 0 for r in rows)
    assert run.read_batch_log(spark, Layout(run_dir + "/none")).count() == 0
