import itertools
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import parsed, same_rows, transaction

from tidemark.operators import transactions as tx
from tidemark.spec import entity


def cleaned(spark, rows):
    return tx.clean_transactions(parsed(spark, rows))


def current(spark, rows, **kw):
    return {r.transaction_id: r for r in tx.upsert(parsed(spark, rows), **kw).collect()}


def test_cleaning(spark):
    row = cleaned(spark, [transaction(1, merchant_category=" fuel")]).first()
    assert (row.transaction_type, row.currency, row.country) == ("DEBIT", "AED", "AE")
    assert (row.merchant_name, row.merchant_category, row.status) == ("Shop", "FUEL", "COMPLETED")
    assert row.amount == Decimal("10.00")


@pytest.mark.parametrize(
    "fields, kept",
    [
        ({"amount": 0.0}, True),
        ({"amount": -0.01}, False),
        ({"amount": None}, False),
        ({"amount": 1e30}, False),
        ({"amount": 1.005}, True),
        ({"transaction_type": "FEE"}, False),
        ({"transaction_type": None}, False),
        ({"transaction_type": " Credit"}, True),
        ({"transaction_id": None}, False),
        ({"account_id": None}, True),
    ],
)
def test_validity(spark, fields, kept):
    assert (cleaned(spark, [transaction(1, **fields)]).count() == 1) == kept


def test_unknown_operation_is_not_deleted(spark):
    row = cleaned(spark, [transaction(1, op=None)]).first()
    assert row._is_deleted is False


def test_update_overwrites_but_keeps_creation_time(spark):
    got = current(spark, [transaction(1, "c", 1000), transaction(1, "u", 5000, amount=20.0)])
    row = got["T1"]
    assert row.amount == Decimal("20.00")
    assert (row._created_at.timestamp(), row._updated_at.timestamp()) == (1, 5)


def test_repeated_insert_changes_nothing(spark):
    got = current(spark, [transaction(1, "c", 1), transaction(1, "c", 2, amount=99.0)])
    assert got["T1"].amount == Decimal("10.00")


def test_delete_flags_the_row(spark):
    rows = [transaction(1, "c", 1), transaction(1, "d", 2), transaction(2)]
    frame = tx.upsert(parsed(spark, rows))
    assert {r.transaction_id: r._is_deleted for r in frame.collect()} == {"T1": True, "T2": False}
    assert [r.transaction_id for r in tx.live(frame).collect()] == ["T2"]


def test_change_before_the_insert_is_ignored(spark):
    got = current(spark, [transaction(1, "u", 1, amount=99.0), transaction(1, "c", 2)])
    assert got["T1"].amount == Decimal("10.00")


def test_offset_breaks_ties(spark):
    rows = [transaction(1, "c", 1), transaction(1, "u", 1, amount=5.0)]
    assert current(spark, rows)["T1"].amount == Decimal("5.00")
    assert current(spark, rows[::-1])["T1"].amount == Decimal("10.00")


def test_orphan_change_is_set_aside(spark):
    events = cleaned(spark, [transaction(1, "u"), transaction(2)])
    state = tx.collapse(events)
    assert [r.transaction_id for r in tx.orphan_changes(state).collect()] == ["T1"]
    assert [r.transaction_id for r in tx.current_rows(state).collect()] == ["T2"]


def test_invalid_insert_leaves_the_change_an_orphan(spark):
    rows = [transaction(1, "c", 1, amount=-1.0), transaction(1, "u", 2, amount=0.0)]
    assert current(spark, rows) == {}


def test_snapshot_rows_can_be_left_out(spark):
    rows = [transaction(1, "r", 1), transaction(1, "u", 2, amount=3.0), transaction(2)]
    assert set(current(spark, rows)) == {"T1", "T2"}
    assert set(current(spark, rows, insert_ops=("c",))) == {"T2"}


def test_fewer_columns_read_fewer_columns(spark, run_dir):
    parsed(spark, [transaction(1)]).write.parquet(run_dir)
    rows = tx.upsert(spark.read.parquet(run_dir), columns=("account_id", "amount"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("ReadSchema") :]
    assert "merchant_name" not in scan and "country" not in scan
    assert "account_id" in scan


def random_events(seed, keys=5, n=60):
    rng = random.Random(seed)
    return [
        transaction(
            rng.randrange(keys),
            rng.choice("ccruud"),
            rng.randrange(30),
            amount=float(rng.randrange(-1, 50)),
        )
        for _ in range(n)
    ]


def brute_force(rows):
    """One event after the other, the way a merge would be told to."""
    state = {}
    valid = [(r["__source_ts_ms"], i, r) for i, r in enumerate(rows) if r["amount"] >= 0]
    for _, i, row in sorted(valid, key=lambda e: e[:2]):
        key = row["transaction_id"]
        if key in state:
            if row["__op"] in "ud":
                state[key] = (row["amount"], row["__op"] == "d", i)
        elif row["__op"] in "cr":
            state[key] = (row["amount"], False, i)
    return state


@pytest.mark.parametrize("seed", range(3))
def test_against_event_by_event_merging(spark, seed):
    rows = random_events(seed)
    got = {
        k: (float(r.amount), r._is_deleted, r._source_offset)
        for k, r in current(spark, rows).items()
    }
    assert got == brute_force(rows)


@pytest.mark.parametrize("pieces", [1, 2, 7])
def test_any_cut_any_order_any_repetition_gives_one_state(spark, pieces):
    events = cleaned(spark, random_events(9)).collect()
    schema = cleaned(spark, []).schema
    whole = tx.collapse(spark.createDataFrame(events, schema))
    random.Random(pieces).shuffle(events)
    cuts = [events[i::pieces] for i in range(pieces)]
    states = [tx.collapse(spark.createDataFrame(cut, schema)) for cut in cuts]
    same_rows(tx.merge_states(*states, states[0]), whole)


def test_merging_into_a_base(spark):
    rows = random_events(4, keys=8)
    schema = cleaned(spark, []).schema
    events = cleaned(spark, rows).collect()
    first, second = (spark.createDataFrame(part, schema) for part in (events[:30], events[30:]))
    merged = tx.merge_into(tx.collapse(first), tx.collapse(second))
    same_rows(merged, tx.collapse(spark.createDataFrame(events, schema)))


def test_insert_log_does_not_depend_on_later_events(spark):
    base = [transaction(1, "c", 1), transaction(2, "c", 2)]
    later = [transaction(1, "u", 3, amount=7.0), transaction(1, "d", 4), transaction(2, "c", 9)]
    logs = [
        tx.first_inserts(tx.collapse(cleaned(spark, rows)))
        for rows in (base, base + later)
    ]
    same_rows(*logs)


def test_combines_before_the_shuffle(spark):
    plan = (
        tx.collapse(cleaned(spark, [transaction(1)]))
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "partial_min" in plan and "partial_max" in plan


def test_all_orders_of_three_events(spark):
    events = [
        transaction(1, "c", 1, amount=1.0),
        transaction(1, "u", 2, amount=2.0),
        transaction(1, "u", 3, amount=3.0),
    ]
    results = {
        current(spark, list(order))["T1"].amount for order in itertools.permutations(events)
    }
    assert results == {Decimal("3.00")}


def test_live_at_two_times_equals_two_upserts(spark):
    from tidemark.operators import snapshot

    r = random.Random(17)
    rows = [transaction(r.randrange(20), r.choice("ccruud"), r.randrange(60), amount=float(r.randrange(5))) for _ in range(150)]
    events = cleaned(spark, rows)
    early = F.col("_source_ts_ms") <= 30
    columns = ("amount", "status")
    got = snapshot.compare(tx.live_at_two_times(events, early, columns), tx.KEY)
    old, new = (
        tx.live(tx.current_rows(tx.collapse(e, columns), columns)) for e in (events.where(early), events)
    )
    want = snapshot.snapshot_diff(old, new, tx.KEY, columns)
    assert {x.op for x in want.collect()} == {"c", "u", "d"}
    same_rows(got, want)


def test_states_are_sorted_by_a_number_before_the_key(spark):
    """Keys begin alike, so a sort by key alone compared whole texts."""
    bronze = spark.createDataFrame([], entity("transactions").bronze_schema)
    state = tx.collapse(tx.clean_transactions(bronze))
    assert state.columns == [tx.KEY, tx.FIRST, tx.LAST]
    plan = state._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert sorts and not any(f"Sort [{tx.KEY}#" in line for line in sorts)


def test_inserted_keys_are_those_of_the_current_rows(spark):
    rows = [
        transaction(1),
        transaction(1, ts_ms=9),
        transaction(1, "d"),
        transaction(2, "r"),
        transaction(3, "u"),
        transaction(4, amount=-1.0),
        transaction(4, "u"),
        transaction(5, amount=None),
        transaction(5, "c", ts_ms=9),
    ]
    keys = tx.inserted_keys(cleaned(spark, rows))
    same_rows(keys, tx.upsert(parsed(spark, rows)).select("transaction_id"))
    assert sorted(r[0] for r in keys.collect()) == ["T1", "T2", "T5"]
    assert "SortAggregate" not in keys._jdf.queryExecution().executedPlan().toString()
    keys = tx.inserted_keys(cleaned(spark, rows), ("c",))
    assert sorted(r[0] for r in keys.collect()) == ["T1", "T5"]


def test_the_check_of_counts_folds_once(spark):
    """It folded the table twice, once only to count it."""
    import __spark_entry__ as entry

    check = entry.queries()["check_min_records"](spark, "/root/testdata/sf0.001")
    plan = check._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("AS first_insert") == 1
