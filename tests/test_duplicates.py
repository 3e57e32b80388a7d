import random

import pytest
from rows import MINUTE_US, T0_US, same_rows, transaction
from test_streaming import Topic

from tidemark.operators import bronze, screening, transactions
from tidemark.spec import TRANSACTIONS
from tidemark.streaming import duplicates, jobs, run


def payment(n, minutes, **fields):
    return transaction(n, transaction_timestamp=T0_US + int(minutes * MINUTE_US), **fields)


def expected(spark, topic):
    events = transactions.clean_transactions(bronze.parse_events(topic.batch(), TRANSACTIONS))
    return screening.repeated_payments(events.where("cdc_operation IN ('c', 'r')"))


@pytest.mark.parametrize("portions", [1, 4])
def test_the_stream_equals_the_batch_form_however_cut(spark, run_dir, layout, portions):
    r = random.Random(8)
    rows = []
    for k in range(120):
        # Out of order, but by less than the lateness allowed.
        rows.append(payment(k, k + r.uniform(-4, 4), amount=r.choice([5.0, 6.0]), merchant_name=r.choice(["a", " a", "b", None])))
    rows += [payment(500, 20, op="u"), payment(501, 30, amount=None), payment(502, 41), payment(502, 41)]
    rows.sort(key=lambda x: x["transaction_timestamp"] // (8 * MINUTE_US))
    topic = Topic(spark, f"{run_dir}/topic")
    size = -(-len(rows) // portions)
    for k in range(0, len(rows), size):
        topic.send(*rows[k : k + size])
        run.catch_up_bronze(lambda _: topic.stream(), layout, ["transactions"])
        run.await_all([jobs.start_repeated_payments(spark, layout, jobs.CATCH_UP)])
    topic.send(payment(900, 600, merchant_name=None))  # moves the watermark, repeats nothing
    run.catch_up_bronze(lambda _: topic.stream(), layout, ["transactions"])
    query = jobs.start_repeated_payments(spark, layout, jobs.CATCH_UP)
    query.awaitTermination()
    stored = spark.read.parquet(layout.repeated_payments)
    want = expected(spark, topic)
    assert want.count() > 20
    same_rows(stored, want)
    # All but the last payment's group have been forgotten.
    totals = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert totals[-1] <= 1


def frame(*rows):
    import pandas as pd

    return pd.DataFrame(rows, columns=duplicates.COLUMNS)


def test_a_step_keeps_what_may_still_matter():
    rows = frame(
        ("A", 1, "m", 10, 0, "t0", True), ("A", 1, "m", 100, 1, "t1", False), ("A", 1, "m", 104, 2, "t2", False),
        ("A", 2, "m", 90, 3, "t3", False), ("A", 2, "n", 101, 4, "t4", False), ("B", 1, "m", 130, 5, "t5", False),
    )
    repeats, kept = duplicates.step(rows, 120, 20)
    assert repeats["transaction_id"].tolist() == ["t2"] and repeats["micros_apart"].tolist() == [4]
    assert sorted(zip(kept["transaction_id"], kept["passed"], strict=True)) == [("t2", True), ("t4", True), ("t5", False)]
    repeats, kept = duplicates.step(frame(*kept.itertuples(index=False)), 500, 20)
    assert len(repeats) == 0 and len(kept) == 0
    repeats, kept = duplicates.step(frame(), 500, 20)
    assert len(repeats) == 0 and len(kept) == 0
