import pytest
from rows import parsed, parsed_customers, customer, same_rows, transaction

from tidemark.operators import accounts, quality, snapshot
from tidemark.plans import checks
from tidemark.spec import ACCOUNTS


def report(rows, entity, rules):
    out = quality.violations(rows, entity, rules).collect()
    return {r.column_name: (r.n_violations, r.n_rows) for r in out}


def test_domains_pass_on_null(spark):
    rows = parsed_customers(
        spark,
        [
            customer(1, kyc_status="VERIFIED", customer_segment="RETAIL"),
            customer(2, kyc_status="MAYBE", customer_segment=None),
        ],
    )
    assert report(rows, "customers", quality.domain_rules("customers")) == {
        "kyc_status": (1, 2),
        "customer_segment": (0, 2),
    }


@pytest.mark.parametrize("score, broken", [(0, 1), (1, 0), (100, 0), (101, 1), (None, 0)])
def test_score_range(spark, score, broken):
    rows = parsed_customers(spark, [customer(1, risk_score=score)])
    assert report(rows, "customers", quality.range_rules("customers"))["risk_score"][0] == broken


@pytest.mark.parametrize("amount, broken", [(0.0, 1), (0.01, 0), (-1.0, 1), (None, 0)])
def test_amount_range(spark, amount, broken):
    rows = parsed(spark, [transaction(1, amount=amount)])
    got = report(rows, "transactions", quality.range_rules("transactions"))
    assert got["amount"][0] == broken


def test_not_null(spark):
    rows = parsed(spark, [transaction(1, amount=None), transaction(2, account_id=None)])
    assert report(rows, "transactions", quality.not_null_rules("transactions")) == {
        "account_id": (1, 2),
        "amount": (1, 2),
    }


def test_empty_input_reports_zero(spark):
    rows = parsed(spark, [])
    assert report(rows, "transactions", quality.not_null_rules("transactions"))["amount"] == (0, 0)


def test_duplicates(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert [tuple(r) for r in quality.duplicates(rows, "k").collect()] == [("a", 2)]


def test_orphans(spark):
    child = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3), (None, 4)], "fk string, id int")
    parent = spark.createDataFrame([("y",)], "pk string")
    assert [tuple(r) for r in quality.orphan_keys(child, "fk", parent, "pk").collect()] == [("x", 2)]


def test_cascade(spark):
    gone = spark.createDataFrame([("C1",)], "customer_id string")
    acc = spark.createDataFrame(
        [("A1", "C1"), ("A2", "C1"), ("A3", "C2")], "account_id string, customer_id string"
    )
    txs = spark.createDataFrame(
        [(f"T{i}", f"A{i % 4}") for i in range(40)], "transaction_id string, account_id string"
    )
    lost = quality.cascade_accounts(gone, acc)
    assert sorted(r.account_id for r in lost.collect()) == ["A1", "A2"]
    assert quality.cascade_transactions(lost, txs).count() == 20
    both = quality.cascade(gone, acc, txs)
    want = [("accounts", r.account_id) for r in lost.collect()]
    want += [("transactions", r.transaction_id) for r in quality.cascade_transactions(lost, txs).collect()]
    assert sorted(tuple(r) for r in both.collect()) == sorted(want)


def test_defaults(spark):
    rows = parsed(spark, [{"account_id": "A1", "__source_ts_ms": 5}], ACCOUNTS)
    row = quality.fill_defaults(rows, "accounts", "2024-01-01 00:00:00").first()
    assert (row.balance, row.status, row.opened_date.year) == (0.0, "ACTIVE", 2024)
    assert row.last_activity_date is None
    kept = quality.fill_defaults(
        parsed(spark, [transaction(1, is_international=True)]), "transactions"
    ).first()
    assert (kept.is_international, kept.status) == (True, "completed ")


def test_current_accounts(spark):
    rows = [
        {"account_id": "A1", "customer_id": "C1", "__op": "r", "__source_ts_ms": 1},
        {"account_id": "A1", "customer_id": "C2", "__op": "u", "__source_ts_ms": 2},
        {"account_id": "A2", "customer_id": "C1", "__op": "c", "__source_ts_ms": 1},
        {"account_id": "A2", "customer_id": "C1", "__op": "d", "__source_ts_ms": 3},
    ]
    out = accounts.current_accounts(parsed(spark, rows, ACCOUNTS))
    assert [tuple(r) for r in out.collect()] == [("A1", "C2")]


def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3), (5, None, None)], "k int, x string, y int")
    new = spark.createDataFrame([(1, "a", 1), (2, "b", 9), (4, "d", 4), (5, None, None)], "k int, x string, y int")
    out = {r.k: r for r in snapshot.snapshot_diff(old, new, "k").collect()}
    assert {k: r.op for k, r in out.items()} == {2: "u", 3: "d", 4: "c"}
    assert (out[2].before.y, out[2].after.y) == (None, 9)
    assert out[3].after is None and out[4].before is None
    only_x = snapshot.snapshot_diff(old, new, "k", ["x"])
    assert {r.k: r.op for r in only_x.collect()} == {3: "d", 4: "c"}


def test_initial_snapshot_is_all_reads(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "k int, x string")
    out = snapshot.initial_snapshot(rows, "k")
    assert {(r.k, r.op, r.before, r.after.x) for r in out.collect()} == {
        (1, "r", None, "a"),
        (2, "r", None, None),
    }


def test_min_records(spark):
    tables = {
        "silver_customers": spark.range(0).toDF("a"),
        "gold_aml_alerts": spark.range(0).toDF("a"),
        "bronze_transactions": spark.range(3).toDF("a"),
    }
    out = {r.table_name: (r.n_rows, r.healthy) for r in checks.min_records(tables).collect()}
    assert out == {
        "silver_customers": (0, False),
        "gold_aml_alerts": (0, True),
        "bronze_transactions": (3, True),
    }
