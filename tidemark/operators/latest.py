"""Last event per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    events: DataFrame, key: str, position: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """``columns`` of the last event of each key by ``position``.

    A maximum over (position, payload) combines on the map side: a key with very many events
    sends one row per task through the shuffle, which ``row_number`` would not.
    """
    payload = [c for c in columns if c not in (key, *position)]
    return (
        events.groupBy(key)
        .agg(F.max(F.struct(*position, *payload)).alias("_last"))
        .select(key, *[F.col(f"_last.{c}").alias(c) for c in columns if c != key])
    )
