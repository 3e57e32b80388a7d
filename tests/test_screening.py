import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import MINUTE_US, T0_US, parsed, same_rows, transaction

from tidemark.operators import screening, transactions


def current(spark, rows):
    return transactions.upsert(parsed(spark, rows))


def test_merchant_flags(spark):
    rows = [
        transaction(1, merchant_category="crypto ", amount=5.0),
        transaction(2, merchant_category="Gambling", amount=7.0),
        transaction(3),
        transaction(4, account_id="A2"),
    ]
    out = screening.merchant_flags(current(spark, rows)).collect()
    assert [(r.account_id, r.n_flagged, r.flagged_amount) for r in out] == [("A1", 2, 12.0)]


def test_country_spread(spark):
    rows = [transaction(i, country=c) for i, c in enumerate(["AE", "us", "US ", "GB"])]
    rows += [transaction(9, country="AE", account_id="A2")]
    out = screening.country_spread(current(spark, rows)).collect()
    assert [(r.account_id, r.n_countries, r.n_transactions) for r in out] == [("A1", 3, 4)]
    assert screening.country_spread(current(spark, rows), more_than=3).count() == 0


def test_cross_border(spark):
    rows = [transaction(i, is_international=i == 0) for i in range(4)]
    rows += [transaction(9, account_id="A2")]
    out = screening.cross_border(current(spark, rows)).collect()
    assert [(r.account_id, r.n_international, r.international_share) for r in out] == [
        ("A1", 1, 0.25)
    ]


@pytest.mark.parametrize("minutes, expected", [(10, {"T2", "T3"}), (4, {"T3"})])
def test_repeated_payments(spark, minutes, expected):
    at = [0, 0, 5, 8, 19]
    rows = [transaction(i, transaction_timestamp=T0_US + m * MINUTE_US) for i, m in enumerate(at)]
    rows[0]["merchant_name"] = "Other"
    events = transactions.clean_transactions(parsed(spark, rows))
    out = screening.repeated_payments(events, minutes)
    assert {r.transaction_id for r in out.collect()} == expected


@pytest.mark.parametrize("column", ["account_id", "merchant_name"])
def test_payments_without_account_or_merchant_repeat_nothing(spark, column):
    rows = [transaction(i, **{column: None}) for i in range(3)]
    events = transactions.clean_transactions(parsed(spark, rows))
    assert events.count() == 3 and screening.repeated_payments(events).count() == 0


def brute_unusual(rows, deviations=3.0, min_earlier=5):
    found = set()
    by_account = {}
    for r in sorted(rows, key=lambda r: (r["transaction_timestamp"], r["transaction_id"])):
        earlier = by_account.setdefault(r["account_id"], [])
        if len(earlier) >= min_earlier:
            mean = sum(earlier) / len(earlier)
            var = sum((x - mean) ** 2 for x in earlier) / len(earlier)
            if r["amount"] > mean + deviations * math.sqrt(var) + 1e-9:
                found.add(r["transaction_id"])
        earlier.append(r["amount"])
    return found


def test_unusual_spend(spark):
    rng = random.Random(3)
    rows = [
        transaction(
            i,
            account_id=f"A{rng.choice([1, 1, 1, 2, 3])}",
            amount=round(rng.uniform(1, 50) * (20 if rng.random() < 0.05 else 1), 2),
            transaction_timestamp=T0_US + rng.randrange(10**6),
        )
        for i in range(300)
    ]
    frame = current(spark, rows)
    plain = screening.unusual_spend(frame)
    assert {r.transaction_id for r in plain.collect()} == brute_unusual(rows)


def test_unusual_spend_does_not_round(spark):
    """201 equal payments, then one that is ten cents higher: the earlier spread is 0."""
    rows = [
        transaction(i, amount=98765432.02, transaction_timestamp=T0_US + i * MINUTE_US)
        for i in range(201)
    ]
    rows.append(transaction(900, amount=98765432.12, transaction_timestamp=T0_US + 300 * MINUTE_US))
    out = screening.unusual_spend(current(spark, rows)).collect()
    assert [(r.transaction_id, r.n_earlier) for r in out] == [("T900", 201)]


def test_customer_activity_and_risk(spark):
    rows = [transaction(i, amount=60000.0) for i in range(12)]
    rows += [transaction(20, account_id="A2", amount=1.0), transaction(21, account_id="A9")]
    frame = current(spark, rows)
    accounts = spark.createDataFrame(
        [("A1", "C1"), ("A2", "C1"), ("A3", "C2"), ("A9", "nobody")],
        "account_id string, customer_id string",
    )
    customers = spark.createDataFrame(
        [("C1", "RETAIL", "VERIFIED"), ("C2", "RETAIL", "PENDING")],
        "customer_id string, customer_segment string, kyc_status string",
    )
    out = screening.customer_activity(frame, accounts, customers).collect()
    assert [(r.customer_id, r.n_accounts, r.n_transactions, r.total_amount) for r in out] == [
        ("C1", 2, 13, 720001.0)
    ]
    risk = {r.customer_id: r for r in screening.recalculated_risk(frame, accounts).collect()}
    assert (risk["C1"].max_score, risk["C1"].mean_score, risk["C1"].n_windows) == (95, 47.5, 2)


def test_change_audit(spark):
    rows = [
        transaction(1, "c", 1),
        transaction(1, "u", 3, amount=None),
        transaction(1, "u", 2, amount=11.0, status="reversed"),
        transaction(2, "c", 1),
    ]
    bronze = parsed(spark, rows)
    out = screening.change_audit(bronze, "transaction_id", ["amount", "status"])
    got = [(r.cdc_timestamp_ms, r.changed_columns) for r in out.orderBy("cdc_timestamp_ms").collect()]
    assert got == [(2, ["amount", "status"]), (3, ["amount", "status"])]
    first = out.orderBy("cdc_timestamp_ms").first()
    assert (first.before.amount, first.after.amount) == (10.0, 11.0)


def test_amounts_stay_exact(spark):
    rows = [transaction(i, amount=0.1) for i in range(30)]
    total = current(spark, rows).agg(F.sum("amount")).first()[0]
    assert total == Decimal("3.00")
