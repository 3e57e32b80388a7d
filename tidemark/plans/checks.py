"""Checks over a running installation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The least number of records each table must hold.
MIN_RECORDS = {
    "bronze_transactions": 1,
    "silver_transactions": 1,
    "silver_customers": 1,
    "gold_aml_alerts": 0,
}


def min_records(tables: dict[str, DataFrame], least: dict[str, int] = MIN_RECORDS) -> DataFrame:
    """Rows per table against the least number expected."""
    reports = [
        rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            "n_rows",
            F.lit(least[name]).cast("bigint").alias("min_records"),
            (F.col("n_rows") >= least[name]).alias("healthy"),
        )
        for name, rows in tables.items()
    ]
    return reduce(DataFrame.unionByName, reports)
