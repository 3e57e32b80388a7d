"""Further screening and customer views over Silver rows.

Counts, sums and running totals are kept in integers and decimals, so results do not depend
on how the rows were partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.metrics import WINDOW, account_windows, score
from tidemark.operators.skew import with_neighbour, with_running_before

# Merchant categories under suspicion.
SUSPICIOUS_CATEGORIES = ("CRYPTO", "GAMBLING")


def _per_window(rows: DataFrame, length: str, *measures) -> DataFrame:
    grouped = rows.where(F.col("account_id").isNotNull()).groupBy(
        "account_id", F.window("transaction_timestamp", length).alias("_window")
    )
    out = grouped.agg(*measures)
    return out.select(
        "account_id",
        F.col("_window.start").alias("window_start"),
        *[c for c in out.columns if c not in ("account_id", "_window")],
    )


def merchant_flags(
    rows: DataFrame, categories: Sequence[str] = SUSPICIOUS_CATEGORIES, length: str = WINDOW
) -> DataFrame:
    """Account windows with transactions in suspicious merchant categories."""
    flagged = rows.where(F.col("merchant_category").isin(*categories))
    return _per_window(
        flagged,
        length,
        F.count(F.lit(1)).alias("n_flagged"),
        F.sum("amount").cast("double").alias("flagged_amount"),
    )


def country_spread(rows: DataFrame, more_than: int = 2, length: str = WINDOW) -> DataFrame:
    """Account windows that touch more than ``more_than`` countries."""
    return _per_window(
        rows,
        length,
        F.count_distinct("country").alias("n_countries"),
        F.count(F.lit(1)).alias("n_transactions"),
    ).where(F.col("n_countries") > more_than)


def cross_border(rows: DataFrame, length: str = WINDOW) -> DataFrame:
    """International share of each account window that has any."""
    n = F.count(F.lit(1))
    international = F.count_if("is_international")
    return _per_window(
        rows,
        length,
        n.alias("n_transactions"),
        international.alias("n_international"),
        (international / n).alias("international_share"),
    ).where(F.col("n_international") > 0)


def repeated_payments(inserts: DataFrame, minutes: int = 10) -> DataFrame:
    """Insert events that repeat account, amount and merchant of an event shortly before.

    Takes events, not current rows, so a delivery of the same transaction twice shows too.
    Events that lack one of the three, or the time, repeat nothing.
    """
    keys = ["account_id", "amount", "merchant_name"]
    paired = with_neighbour(
        inserts.dropna("any", subset=[*keys, "transaction_timestamp"]),
        keys,
        [F.col("transaction_timestamp"), F.col("_source_offset")],
        "_earlier",
        F.struct("transaction_id", "transaction_timestamp"),
        -1,
        F.unix_millis("transaction_timestamp"),
    )
    apart = F.unix_micros("transaction_timestamp") - F.unix_micros(
        F.col("_earlier.transaction_timestamp")
    )
    return paired.where(apart <= minutes * 60_000_000).select(
        "transaction_id",
        "account_id",
        "amount",
        "merchant_name",
        "_source_offset",
        F.col("_earlier.transaction_id").alias("earlier_transaction_id"),
        apart.alias("micros_apart"),
    )


def unusual_spend(
    rows: DataFrame, deviations: float = 3.0, min_earlier: int = 5
) -> DataFrame:
    """Transactions above mean + ``deviations`` standard deviations of the account's earlier ones.

    With n, s, q the count, sum and square sum of the earlier amounts in hundredths, the test
    ``x > s/n + d * sqrt(q/n - (s/n)^2)`` is ``n*x - s > d * sqrt(n*q - s*s)``. Both sides are
    whole numbers of up to 38 digits, and only rounded at the end. Rows for which that is too
    few are compared in floating point.
    """
    cents = (F.col("amount") * 100).cast("decimal(18,0)")
    running = with_running_before(
        rows.where(F.col("account_id").isNotNull() & F.col("transaction_timestamp").isNotNull()),
        ["account_id"],
        [F.col("transaction_timestamp"), F.col("transaction_id")],
        {
            "n_earlier": F.lit(1).cast("bigint"),
            "_s": cents,
            "_q": (cents * cents).cast("decimal(38,0)"),
        },
        F.unix_millis("transaction_timestamp"),
    )
    n, s, q, x = (c.cast("decimal(38,0)") for c in (F.col("n_earlier"), F.col("_s"), F.col("_q"), cents))
    dn, ds, dq, dx = (c.cast("double") for c in (n, s, q, x))
    square = F.coalesce(
        F.try_subtract(F.try_multiply(n, q), F.try_multiply(s, s)).cast("double"),
        F.greatest(dn * dq - ds * ds, F.lit(0.0)),
    )
    above = F.coalesce(F.try_subtract(F.try_multiply(n, x), s).cast("double"), dn * dx - ds)
    return running.where(
        (F.col("n_earlier") >= min_earlier)
        & (above > F.lit(float(deviations)) * F.sqrt(square))
    ).select("transaction_id", "account_id", "amount", "n_earlier", (ds / dn / 100).alias("mean_earlier"))


def customer_activity(rows: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Transaction history per customer.

    Rows are summed per account before anything is joined, so both joins are between unique
    keys, and a busy account or customer is a single row in them.
    """
    per_account = (
        rows.where(F.col("account_id").isNotNull())
        .groupBy("account_id")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum("amount").alias("_total"),
            F.min("transaction_timestamp").alias("_first"),
            F.max("transaction_timestamp").alias("_last"),
        )
    )
    per_customer = (
        per_account.join(accounts.select("account_id", "customer_id"), "account_id")
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("n_accounts"),
            F.sum("_n").alias("n_transactions"),
            F.sum("_total").cast("double").alias("total_amount"),
            F.min("_first").alias("first_transaction"),
            F.max("_last").alias("last_transaction"),
        )
    )
    return customers.select("customer_id", "customer_segment", "kyc_status").join(
        per_customer, "customer_id"
    )


def recalculated_risk(rows: DataFrame, accounts: DataFrame) -> DataFrame:
    """Highest and mean window score per customer."""
    per_account = (
        score(account_windows(rows))
        .groupBy("account_id")
        .agg(
            F.max("risk_score").alias("_max"),
            F.sum("risk_score").alias("_sum"),
            F.count(F.lit(1)).alias("_n"),
        )
    )
    return (
        per_account.join(accounts.select("account_id", "customer_id"), "account_id")
        .groupBy("customer_id")
        .agg(
            F.max("_max").alias("max_score"),
            (F.sum("_sum") / F.sum("_n")).alias("mean_score"),
            F.sum("_n").alias("n_windows"),
        )
    )


def change_audit(bronze: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Each change event with the row before it and the names of the columns that differ."""
    image = F.struct(*columns)
    paired = with_neighbour(
        bronze,
        [key],
        [F.col("cdc_timestamp_ms"), F.col("_feed_offset")],
        "before",
        image,
        -1,
        F.col("cdc_timestamp_ms"),
    )
    differing = F.array_compact(
        F.array(
            *[F.when(~F.col(c).eqNullSafe(F.col(f"before.{c}")), F.lit(c)) for c in columns]
        )
    )
    return paired.where(F.col("before").isNotNull()).select(
        key,
        "cdc_operation",
        "cdc_timestamp_ms",
        "_feed_offset",
        "before",
        image.alias("after"),
        differing.alias("changed_columns"),
    )

