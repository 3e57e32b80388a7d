import random

import pytest
from pyspark.sql import functions as F
from rows import customer, parsed_customers, same_rows

from tidemark.operators import customers
from tidemark.plans import silver
from tidemark.sources import tables
from tidemark.spec import SILVER_CUSTOMERS, ddl


def intervals(versions):
    rows = versions.select(
        "customer_id",
        "risk_score",
        F.unix_millis("effective_from").alias("since"),
        F.unix_millis("effective_to").alias("until"),
        "is_current",
    ).collect()
    return sorted(
        (r.customer_id, r.since, r.until if r.until is not None else -1, r.risk_score, r.is_current)
        for r in rows
    )


def test_cleaning(spark):
    row = customers.clean_customers(
        parsed_customers(spark, [customer(1, email=" A@b.org ", nationality=" ae")])
    ).first()
    assert (row.first_name, row.email, row.nationality) == ("Ann", "A@b.org", "AE")
    assert (row.kyc_status, row.customer_segment) == ("VERIFIED", "RETAIL")


def test_rows_without_key_or_mail_are_dropped(spark):
    rows = [customer(1, email=None), customer(2, customer_id=None), customer(3)]
    out = customers.clean_customers(parsed_customers(spark, rows)).collect()
    assert [r.customer_id for r in out] == ["C3"]


def test_versions_meet_and_the_last_is_current(spark):
    rows = [customer(1, "r", 10), customer(1, "u", 30, risk_score=3), customer(1, "u", 20, risk_score=2)]
    got = intervals(customers.history(parsed_customers(spark, rows)))
    assert got == [
        ("C1", 10, 20, 1, False),
        ("C1", 20, 30, 2, False),
        ("C1", 30, -1, 3, True),
    ]


def test_delete_closes_and_a_later_event_reopens(spark):
    rows = [customer(1, "c", 10), customer(1, "d", 20), customer(1, "c", 40, risk_score=9)]
    got = intervals(customers.history(parsed_customers(spark, rows)))
    assert got == [("C1", 10, 20, 1, False), ("C1", 40, -1, 9, True)]


def test_ties_give_empty_intervals_that_as_of_skips(spark):
    rows = [customer(1, "c", 10), customer(1, "u", 10, risk_score=2)]
    bronze = parsed_customers(spark, rows)
    history = customers.history(bronze)
    assert intervals(history) == [("C1", 10, -1, 2, True), ("C1", 10, 10, 1, False)]
    at = F.timestamp_millis(F.lit(10))
    assert [r.risk_score for r in customers.valid_at(history, at).collect()] == [2]
    assert [r.risk_score for r in customers.as_of(customers.clean_customers(bronze), 10).collect()] == [2]


@pytest.mark.parametrize("instant", [5, 10, 15, 20, 25, 40, 100])
def test_as_of_agrees_with_the_intervals(spark, instant):
    rows = [
        customer(1, "c", 10),
        customer(1, "d", 20),
        customer(1, "c", 40, risk_score=9),
        customer(2, "r", 15, risk_score=4),
        customer(2, "u", 25, risk_score=5),
    ]
    bronze = parsed_customers(spark, rows)
    events = customers.clean_customers(bronze)
    at = F.timestamp_millis(F.lit(instant))
    by_interval = customers.valid_at(customers.history(bronze), at)
    columns = ["customer_id", "risk_score"]
    same_rows(customers.as_of(events, instant).select(columns), by_interval.select(columns))


def test_unchanged_rows_can_be_left_out(spark):
    rows = [
        customer(1, "c", 1),
        customer(1, "u", 2),
        customer(1, "u", 3, risk_score=2),
        customer(1, "d", 4, risk_score=2),
        customer(1, "c", 5, risk_score=2),
    ]
    bronze = parsed_customers(spark, rows)
    assert len(intervals(customers.history(bronze))) == 4
    assert intervals(customers.history(bronze, only_changes=True)) == [
        ("C1", 1, 3, 1, False),
        ("C1", 3, 4, 2, False),
        ("C1", 5, -1, 2, True),
    ]


def test_declared_table(spark):
    table = customers.as_table(customers.history(parsed_customers(spark, [customer(1)])))
    assert [(f.name, f.dataType) for f in table.schema] == [
        (f.name, f.dataType) for f in ddl(SILVER_CUSTOMERS)
    ]


# --- as stored, batch by batch ------------------------------------------------------------------


def random_events(seed, keys=6, n=50):
    rng = random.Random(seed)
    return [
        customer(rng.randrange(keys), rng.choice("ccruuud"), rng.randrange(25), risk_score=i)
        for i, _ in enumerate(range(n))
    ]


def cleaned(spark, rows):
    return customers.clean_customers(parsed_customers(spark, rows))


def batches(spark, rows, n, ordered):
    events = cleaned(spark, rows)
    collected = events.collect()
    if ordered:
        collected.sort(key=lambda r: (r._source_ts_ms, r._source_offset))
    else:
        random.Random(n).shuffle(collected)
    size = -(-len(collected) // n)
    return [
        spark.createDataFrame(collected[i : i + size], events.schema)
        for i in range(0, len(collected), size)
    ]


@pytest.mark.parametrize("ordered", [True, False])
@pytest.mark.parametrize("n", [1, 3, 7])
def test_history_does_not_depend_on_the_cut(spark, layout, n, ordered):
    rows = random_events(n)
    for batch_id, events in enumerate(batches(spark, rows, n, ordered)):
        assert silver.apply_customers(events, batch_id, layout)
        assert not silver.apply_customers(events, batch_id, layout)
    stored = silver.read_customers(spark, layout)
    assert intervals(stored) == intervals(customers.history(parsed_customers(spark, rows)))
    # Replacing closed events is for late ones only.
    assert bool(tables.numbered(spark, layout.customer_reopened)) == (not ordered and n > 1)


def test_interrupted_batch_does_not_count_and_is_replaced(spark, layout):
    rows = random_events(1)
    first, second = batches(spark, rows, 2, ordered=True)
    silver.apply_customers(first, 0, layout)
    before = intervals(silver.read_customers(spark, layout))
    # Some files of batch 1 arrive, then the job dies.
    spark.read.parquet(f"{layout.customers}/batch_id=0").write.partitionBy("is_last").option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{layout.customers}/batch_id=1")
    assert intervals(silver.read_customers(spark, layout)) == before
    silver.apply_customers(second, 1, layout)
    want = intervals(customers.history(parsed_customers(spark, rows)))
    assert intervals(silver.read_customers(spark, layout)) == want


def test_compaction_changes_no_result(spark, layout):
    rows = random_events(2)
    want = intervals(customers.history(parsed_customers(spark, rows)))
    parts = batches(spark, rows, 4, ordered=False)
    for batch_id, events in enumerate(parts):
        silver.apply_customers(events, batch_id, layout)
        if batch_id == 2:
            assert silver.compact_customers(spark, layout) == 2
            assert silver.compact_customers(spark, layout) is None
    assert intervals(silver.read_customers(spark, layout)) == want


def test_customers_with_a_long_history_are_cut_to_the_same_history(spark, layout):
    rows = random_events(3, keys=2, n=80)
    for k, row in enumerate(rows):
        row["__source_ts_ms"] = row["__source_ts_ms"] * 600_000  # over many stretches of time
    want = intervals(customers.history(parsed_customers(spark, rows)))
    for batch_id, events in enumerate(batches(spark, rows, 3, ordered=False)):
        silver.apply_customers(events, batch_id, layout)
    assert intervals(silver.read_customers(spark, layout)) == want
