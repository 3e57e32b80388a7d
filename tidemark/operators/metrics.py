"""Gold: account windows, their risk classification, and alerts.

The functions take batch and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import risk
from tidemark.functions.columns import now_or
from tidemark.functions.risk import RULES, RiskRules
from tidemark.spec import GOLD_ALERTS, GOLD_METRICS, ddl

# All that the metrics read of a transaction; the rest is never scanned.
INPUTS = ("account_id", "amount", "transaction_timestamp", "status")

# Window and lateness of the screening.
WINDOW = "1 hour"
LATENESS = "10 minutes"


def countable(rows: DataFrame, status: str = "COMPLETED") -> DataFrame:
    return rows.where(
        ~F.col("_is_deleted") & (F.col("status") == status) & F.col("account_id").isNotNull()
    )


def _micros(interval: str) -> Column:
    return F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {interval}"))


def is_late(
    time: str, newest_us: Column, length: str = WINDOW, lateness: str = LATENESS
) -> Column:
    """Whether a row belongs to a window that ended ``lateness`` or more before ``newest_us``, the
    latest time seen before the row came, in microseconds. Rows without a time, and rows before any, are
    not late. (Spark's own ``window`` would drop rows without a time.)"""
    us = F.unix_micros(time)
    end = us - F.pmod(us, _micros(length)) + _micros(length)
    return F.coalesce(end <= newest_us - _micros(lateness), F.lit(False))


def account_windows(rows: DataFrame, length: str = WINDOW) -> DataFrame:
    """Per account and tumbling window: count, total, mean and maximum.

    Combines on the map side, so a busy account sends one row per window and task.
    """
    total = F.sum("amount").cast("double")
    count = F.count(F.lit(1))
    return (
        countable(rows)
        .groupBy("account_id", F.window("transaction_timestamp", length).alias("_window"))
        .agg(
            count.cast("int").alias("transaction_count"),
            total.alias("total_amount"),
            (total / count).alias("avg_amount"),
            F.max("amount").cast("double").alias("max_amount"),
        )
        .select(
            "account_id",
            F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"),
            "transaction_count",
            "total_amount",
            "avg_amount",
            "max_amount",
        )
    )


def metrics_table(windows: DataFrame, processed_at=None) -> DataFrame:
    return windows.withColumn("_gold_processed_at", now_or(processed_at)).select(
        *ddl(GOLD_METRICS).fieldNames()
    )


def score(windows: DataFrame, rules: RiskRules = RULES) -> DataFrame:
    return windows.withColumn("risk_score", risk.risk_score(rules))


def classify(scored: DataFrame, rules: RiskRules = RULES) -> DataFrame:
    return scored.withColumns(
        {
            "alert_type": risk.alert_type(rules),
            "severity": risk.severity(F.col("risk_score"), rules),
            "risk_factors": risk.risk_factors(rules),
        }
    )


def alerts(windows: DataFrame, rules: RiskRules = RULES, raised_at=None) -> DataFrame:
    """Windows whose score lies above the alert threshold, as alert records."""
    return (
        classify(score(windows, rules), rules)
        .where(F.col("risk_score") > rules.alert_above)
        .withColumns(
            {
                "alert_id": risk.alert_id(),
                "alert_timestamp": now_or(raised_at),
                "_gold_processed_at": now_or(raised_at),
            }
        )
        .select(*ddl(GOLD_ALERTS).fieldNames())
    )
