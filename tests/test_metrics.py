import itertools

import pytest
from pyspark.sql import functions as F
from rows import T0_US, parsed, transaction

from tidemark.functions.risk import RiskRules
from tidemark.operators import metrics, transactions
from tidemark.spec import GOLD_ALERTS, GOLD_METRICS, ddl

HOUR_US = 3_600_000_000


def windows_of(spark, rows):
    return metrics.account_windows(transactions.upsert(parsed(spark, rows)))


def classified(spark, count, total, highest, rules=RiskRules()):
    rows = spark.createDataFrame(
        [("A1", count, float(total), 1.0, float(highest))],
        "account_id string, transaction_count int, total_amount double, avg_amount double,"
        " max_amount double",
    ).withColumns(
        {
            "window_start": F.timestamp_micros(F.lit(T0_US)),
            "window_end": F.timestamp_micros(F.lit(T0_US + HOUR_US)),
        }
    )
    return rows, metrics.classify(metrics.score(rows, rules), rules).first()


def test_windows_count_sum_mean_and_maximum(spark):
    rows = [
        transaction(1, amount=10.0, transaction_timestamp=T0_US),
        transaction(2, amount=20.5, transaction_timestamp=T0_US + HOUR_US - 1),
        transaction(3, amount=7.0, transaction_timestamp=T0_US + HOUR_US),
        transaction(4, amount=1.0, account_id="A2"),
    ]
    got = {(r.account_id, r.window_start.hour): r for r in windows_of(spark, rows).collect()}
    assert len(got) == 3
    row = got[("A1", 0)]
    assert (row.transaction_count, row.total_amount, row.avg_amount, row.max_amount) == (
        2,
        30.5,
        15.25,
        20.5,
    )
    assert (row.window_end - row.window_start).total_seconds() == 3600


@pytest.mark.parametrize(
    "fields",
    [
        {"status": "pending"},
        {"status": None},
        {"account_id": None},
        {"transaction_timestamp": None},
        {"op": "d"},
    ],
)
def test_what_does_not_count(spark, fields):
    rows = [transaction(1), transaction(2, "c", 1)]
    op = fields.pop("op", None)
    rows.append(transaction(2, op, 2) if op else transaction(2, "u", 2, **fields))
    assert [r.transaction_count for r in windows_of(spark, rows).collect()] == [1]


def test_unknown_delete_flag_does_not_count(spark):
    rows = transactions.upsert(parsed(spark, [transaction(1)]))
    unknown = rows.withColumn("_is_deleted", F.lit(None).cast("boolean"))
    assert metrics.account_windows(unknown).count() == 0


@pytest.mark.parametrize(
    "count, total, highest, score",
    [
        (10, 100000, 50000, 0),
        (10, 100000, 50000.01, 40),
        (11, 100000, 50000, 30),
        (10, 100000.01, 50000, 25),
        (11, 100000.01, 50000, 55),
        (10, 100000.01, 50000.01, 65),
        (11, 100000, 50000.01, 70),
        (11, 100000.01, 50000.01, 95),
    ],
)
def test_score_at_the_thresholds(spark, count, total, highest, score):
    assert classified(spark, count, total, highest)[1].risk_score == score


def test_first_rule_names_the_alert_and_all_rules_are_listed(spark):
    names = ("HIGH_VALUE_TRANSACTION", "VELOCITY_ATTACK", "CUMULATIVE_THRESHOLD_EXCEEDED")
    factors = ("HIGH_VALUE", "HIGH_VELOCITY", "HIGH_CUMULATIVE")
    for hits in itertools.product([True, False], repeat=3):
        row = classified(
            spark, 11 if hits[1] else 1, 100001 if hits[2] else 1, 50001 if hits[0] else 1
        )[1]
        want = [n for n, hit in zip(names, hits) if hit]
        assert row.alert_type == (want[0] if want else "SUSPICIOUS_PATTERN")
        assert row.risk_factors == [f for f, hit in zip(factors, hits) if hit]


@pytest.mark.parametrize(
    "points, severity",
    [(90, "CRITICAL"), (89, "HIGH"), (80, "HIGH"), (79, "MEDIUM"), (70, "MEDIUM"), (69, "LOW")],
)
def test_severity_at_its_limits(spark, points, severity):
    rules = RiskRules(high_value_points=points)
    assert classified(spark, 1, 1, 60000, rules)[1].severity == severity


def test_score_is_capped(spark):
    assert classified(spark, 11, 100001, 60000, RiskRules(velocity_points=90))[1].risk_score == 100


def test_alert_needs_more_than_the_threshold(spark):
    rows, _ = classified(spark, 11, 100000, 50001)
    assert metrics.alerts(rows).count() == 0
    assert metrics.alerts(rows, RiskRules(alert_above=69)).count() == 1


def test_alert_record(spark):
    rows, _ = classified(spark, 11, 100001, 60000)
    out = metrics.alerts(rows, raised_at="2024-01-02 00:00:00")
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [
        (f.name, f.dataType.simpleString()) for f in ddl(GOLD_ALERTS)
    ]
    row = out.first()
    assert row.alert_id == f"AML-A1-{T0_US // 1_000_000}"
    assert (row.severity, row.alert_timestamp.day) == ("CRITICAL", 2)


def test_metrics_table(spark):
    out = metrics.metrics_table(windows_of(spark, [transaction(1)]))
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [
        (f.name, f.dataType.simpleString()) for f in ddl(GOLD_METRICS)
    ]


def test_window_length_is_an_argument(spark):
    rows = [transaction(i, transaction_timestamp=T0_US + i * HOUR_US) for i in range(4)]
    current = transactions.upsert(parsed(spark, rows))
    assert metrics.account_windows(current, "2 hours").count() == 2
