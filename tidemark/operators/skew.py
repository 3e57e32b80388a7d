"""Ordered and keyed work that stays spread out when one key owns much of the data.

A window over a key puts the whole key in one task. Here every key is cut by a fixed stretch of
time, ``STRETCH_MS`` of the order column. The window runs per (key, stretch), so a task holds what
one key does in that time, however long its history. One row per (key, stretch) carries what the
next stretch needs: for neighbours the row at its edge, in a second window over the edges of a key;
for sums a summary, combined per key and joined back on (key, stretch).
All data takes this one path. Keys must not be null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STRETCH_MS = 3_600_000
SALTS = 16

_STRETCH, _PART, _EDGE, _SALT = "_stretch", "_stretch_part", "_edge", "_salt"
# Where the order column is null; sorts first, as nulls do.
_BEFORE_ALL = -(1 << 62)


def _cut(df: DataFrame, millis: Column) -> DataFrame:
    stretch = F.floor(millis / F.lit(STRETCH_MS)).cast("bigint")
    return df.withColumn(_STRETCH, F.coalesce(stretch, F.lit(_BEFORE_ALL)))


def with_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str,
    value: Column,
    step: int,
    millis: Column,
) -> DataFrame:
    """Adds ``value`` of the following (``step=1``) or preceding (``step=-1``) row of the key.

    ``millis`` is the first order column in milliseconds.
    """
    shift, nearest = (F.lead, F.first_value) if step > 0 else (F.lag, F.last_value)
    # Wrapped in a struct, "no neighbour in this stretch" and "neighbour is null" stay apart.
    boxed = F.struct(value.alias("v"))
    stretch = Window.partitionBy(*keys, _STRETCH).orderBy(*order)
    whole = stretch.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    inside = _cut(df, millis).withColumns(
        {"_inner": shift(boxed).over(stretch), _EDGE: nearest(boxed).over(whole)}
    )
    at_edge = F.col("_inner").isNull()
    # One row per stretch is at its edge and shows the others what they find there; a key's edges
    # meet, and all other rows stay where their stretch is.
    rows = inside.withColumns(
        {_EDGE: F.when(at_edge, F.col(_EDGE)), _PART: F.when(~at_edge, F.col(_STRETCH))}
    )
    beyond = shift(_EDGE).over(Window.partitionBy(*keys, _PART).orderBy(_STRETCH))
    return (
        rows.withColumn("_beyond", beyond)
        .withColumn(name, F.coalesce("_inner", F.when(at_edge, F.col("_beyond")))["v"])
        .drop("_inner", "_beyond", _EDGE, _STRETCH, _PART)
    )


def with_running_before(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    sums: dict[str, Column],
    millis: Column,
) -> DataFrame:
    """Adds, per name, the sum of a column over the key's earlier rows (0 where none).

    ``order`` must be total within a key, and ``millis`` its first column in milliseconds. Use
    integer or decimal columns: their sums do not depend on how the rows were cut.
    """

    def before(window):
        return window.rowsBetween(Window.unboundedPreceding, -1)

    rows = _cut(df, millis)
    earlier = before(Window.partitionBy(*keys).orderBy(_STRETCH))
    edges = (
        rows.groupBy(*keys, _STRETCH)
        .agg(*[F.sum(c).alias(n) for n, c in sums.items()])
        .select(
            *keys, _STRETCH, F.struct(*[F.sum(n).over(earlier).alias(n) for n in sums]).alias(_EDGE)
        )
    )
    within = before(Window.partitionBy(*keys, _STRETCH).orderBy(*order))
    return (
        rows.withColumns({f"_in_{n}": F.sum(c).over(within) for n, c in sums.items()})
        .join(edges, [*keys, _STRETCH])
        .withColumns(
            {
                n: F.coalesce(F.col(f"_in_{n}"), F.lit(0))
                + F.coalesce(F.col(f"{_EDGE}.{n}"), F.lit(0))
                for n in sums
            }
        )
        .drop(_EDGE, _STRETCH, *[f"_in_{n}" for n in sums])
    )


def filter_by_keys(
    facts: DataFrame, lookup: DataFrame, on: str, how: str, row: Sequence[str]
) -> DataFrame:
    """Semi or anti join on a key that many rows may share.

    Rows spread over ``SALTS`` parts by their own id, the columns ``row``; every lookup key stands
    once in each part, so a key's rows meet it in that many tasks.
    """
    if how not in ("left_semi", "left_anti"):
        raise ValueError(f"unsupported join kind: {how!r}")
    salted = facts.withColumn(_SALT, F.pmod(F.xxhash64(*row), F.lit(SALTS)).cast("int"))
    parts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(_SALT)
    return salted.join(lookup.select(on, parts), [on, _SALT], how).drop(_SALT)
