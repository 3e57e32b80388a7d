"""Two snapshots of a keyed relation to a change feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def initial_snapshot(rows: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Every row as a snapshot read (``r``)."""
    columns = list(columns or [c for c in rows.columns if c != key])
    image = F.struct(*columns)
    nothing = F.lit(None).cast(rows.select(image).schema[0].dataType)
    return rows.select(
        key, F.lit("r").alias("op"), nothing.alias("before"), image.alias("after")
    )


def snapshot_diff(
    old: DataFrame, new: DataFrame, key: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Created, updated and deleted keys with their images before and after.

    ``key`` is unique on both sides, so the one join has no hot key. Rows are compared whole
    and null-safe.
    """
    columns = list(columns or [c for c in new.columns if c != key])
    before = old.select(key, F.struct(*columns).alias("before"))
    after = new.select(key, F.struct(*columns).alias("after"))
    return compare(before.join(after, key, "full_outer"), key)


def compare(rows: DataFrame, key: str) -> DataFrame:
    """Rows (key, before, after) that differ, with what happened to them."""
    op = (
        F.when(F.col("before").isNull() & F.col("after").isNotNull(), "c")
        .when(F.col("before").isNotNull() & F.col("after").isNull(), "d")
        .when(~F.col("before").eqNullSafe(F.col("after")), "u")
    )
    return rows.select(key, op.alias("op"), "before", "after").where(F.col("op").isNotNull())
