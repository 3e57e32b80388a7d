"""Repeated payments as a stream: what ``screening.repeated_payments`` gives for a whole table.

Payments are dealt to a fixed number of groups by a hash of account, amount and merchant, and handled
a group at a time in pandas. A group's state holds the payments that the watermark has not passed, as
an earlier one may still come, and the last passed one of each key until ``minutes`` after it,
as only so long something can repeat it. A timer wakes the group for both. Payments that
the watermark has passed when they come are dropped by Spark.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.metrics import LATENESS

KEYS = ["account_id", "amount", "merchant_name"]
ORDER = [*KEYS, "time_us", "offset"]
COLUMNS = [*ORDER, "transaction_id", "passed"]
GROUPS = 256

STATE_SCHEMA = (
    "account_id array<string>, amount array<decimal(18,2)>, merchant_name array<string>, "
    "time_us array<long>, offset array<long>, transaction_id array<string>, passed array<boolean>"
)
RESULT_SCHEMA = (
    "transaction_id string, account_id string, amount decimal(18,2), merchant_name string, "
    "_source_offset long, earlier_transaction_id string, micros_apart long"
)


def step(rows: pd.DataFrame, watermark_us: int, reach_us: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Repeats among the rows that the watermark now passes, and the rows to keep.

    ``rows`` are those kept before and new ones, with :data:`COLUMNS`.
    """
    rows = rows.sort_values(ORDER, kind="stable", ignore_index=True)
    closed = rows["time_us"] <= watermark_us
    done = rows[closed]
    same = np.ones(max(0, len(done) - 1), bool)
    for key in KEYS:
        column = done[key].to_numpy()
        same &= column[1:] == column[:-1]
    apart = np.diff(done["time_us"].to_numpy())
    hit = np.append([False] if len(done) else [], same & (apart <= reach_us)).astype(bool)
    hit &= ~done["passed"].to_numpy(bool)
    at = np.flatnonzero(hit)
    found = done.iloc[at]
    repeats = pd.DataFrame(
        {
            "transaction_id": found["transaction_id"],
            "account_id": found["account_id"],
            "amount": found["amount"],
            "merchant_name": found["merchant_name"],
            "_source_offset": found["offset"],
            "earlier_transaction_id": done["transaction_id"].to_numpy()[at - 1],
            "micros_apart": apart[at - 1],
        }
    )
    last = np.append(~same, [True] if len(done) else []).astype(bool)
    recent = done["time_us"].to_numpy() >= watermark_us - reach_us
    kept = pd.concat([done[last & recent].assign(passed=True), rows[~closed]], ignore_index=True)
    return repeats, kept[COLUMNS]


def _follow(reach_us: int):
    def work(
        key: tuple, batches: Iterable[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        parts = []
        if state.exists:
            parts.append(pd.DataFrame(dict(zip(COLUMNS, state.get, strict=True))))
        parts += [b[COLUMNS] for b in batches]
        rows = pd.concat(parts, ignore_index=True)
        watermark = state.getCurrentWatermarkMs()
        repeats, kept = step(rows, 1000 * watermark, reach_us)
        if len(kept):
            state.update(tuple(kept[c].tolist() for c in COLUMNS))
            passed = kept["passed"].to_numpy(bool)
            due = kept["time_us"].to_numpy() + np.where(passed, reach_us, 0)
            state.setTimeoutTimestamp(max(int(due.min()) // 1000, watermark) + 1)
        elif state.exists:
            state.remove()
        if len(repeats):
            yield repeats

    return work


def repeated_payments(
    inserts: DataFrame, minutes: int = 10, lateness: str = LATENESS, groups: int = GROUPS
) -> DataFrame:
    """A stream of cleaned insert events to those that repeat one shortly before.

    All events move the watermark on, those without a key too: the filter stays behind it, as it
    is one expression that holds the time.
    """
    whole = reduce(Column.__and__, (F.col(key).isNotNull() for key in KEYS))
    rows = (
        inserts.withWatermark("transaction_timestamp", lateness)
        .where(F.when(F.col("transaction_timestamp").isNotNull(), whole).otherwise(F.lit(False)))
        .select(
            F.pmod(F.xxhash64(*KEYS), F.lit(groups)).alias("part"),
            *KEYS,
            F.unix_micros("transaction_timestamp").alias("time_us"),
            F.col("_source_offset").alias("offset"),
            "transaction_id",
            F.lit(False).alias("passed"),
            "transaction_timestamp",
        )
    )
    return rows.groupBy("part").applyInPandasWithState(
        _follow(minutes * 60_000_000),
        RESULT_SCHEMA,
        STATE_SCHEMA,
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
