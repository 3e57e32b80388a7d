"""Accounts have no Silver table; checks and joins read their last state off Bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import clean_code
from tidemark.operators.latest import latest_per_key
from tidemark.spec import ACCOUNTS

POSITION = ("cdc_timestamp_ms", "_feed_offset")


def normalize_accounts(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns({c: clean_code(c) for c in ("account_type", "currency", "status")})


def current_accounts(bronze: DataFrame, columns: tuple[str, ...] = ("customer_id",)) -> DataFrame:
    """One row per account that is not deleted; only ``columns`` are read."""
    wanted = (ACCOUNTS.key, *columns, "cdc_operation")
    return (
        latest_per_key(bronze, ACCOUNTS.key, POSITION, wanted)
        .where(~F.col("cdc_operation").eqNullSafe("d"))
        .drop("cdc_operation")
    )
