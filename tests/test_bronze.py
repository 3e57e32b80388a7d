import datetime
import json

import pytest
from rows import T0_US, messages, parsed, parsed_customers, transaction

from tidemark.operators import bronze
from tidemark.spec import ACCOUNTS, CUSTOMERS, TRANSACTIONS, entity


def test_rows_have_the_declared_schema(spark):
    for spec in (TRANSACTIONS, CUSTOMERS, ACCOUNTS):
        out = bronze.parse_events(messages(spark, [], spec.topic), spec)
        assert [(f.name, f.dataType) for f in out.schema] == [
            (f.name, f.dataType) for f in spec.bronze_schema
        ]


def test_payload_markers_and_tags(spark):
    row = parsed(spark, [transaction(1, "u", 5)], start=40).first()
    assert row.transaction_id == "T1"
    assert row.transaction_timestamp == datetime.datetime(2024, 1, 1)
    assert (row.cdc_operation, row.cdc_timestamp_ms) == ("u", 5)
    assert (row.source_table, row.source_database) == ("transactions", "banking_core")
    assert row._entity_type == "transactions"
    assert (row._data_classification, row._data_residency) == ("CONFIDENTIAL", "UAE")
    assert row._ingestion_date == row._ingestion_timestamp.date()
    assert (row._feed_partition, row._feed_offset) == (0, 40)


def test_dates_come_as_days(spark):
    row = parsed_customers(spark, [{"customer_id": "C1", "date_of_birth": 31}]).first()
    assert row.date_of_birth == datetime.date(1970, 2, 1)
    assert row.onboarding_date is None


def test_bad_input_leaves_only_rows_with_a_key(spark):
    rows = [
        transaction(1),
        None,
        "{bad",
        {"account_id": "A"},
        {"transaction_id": 77, "amount": "x", "unknown": [1]},
        "[]",
        "",
    ]
    out = {r.transaction_id: r for r in parsed(spark, rows).collect()}
    assert set(out) == {"T1", "77"}
    assert out["77"].amount is None


def test_quarantine_keeps_what_parsing_leaves_out(spark):
    feed = messages(spark, [transaction(1), None, "{bad", {"account_id": "A"}, ""])
    out = bronze.rejected_messages(feed, "transactions").collect()
    assert {(r.offset, r.reason, r.message) for r in out} == {
        (1, "TOMBSTONE", None),
        (2, "MALFORMED", "{bad"),
        (3, "NO_KEY", '{"account_id": "A"}'),
        (4, "MALFORMED", ""),
    }
    kept = bronze.parse_events(feed, "transactions").count()
    assert kept + len(out) == feed.count()


def test_ingestion_time_can_be_given(spark):
    feed = messages(spark, [transaction(1)])
    row = bronze.parse_events(feed, "transactions", ingested_at="2024-02-03 04:05:06").first()
    assert row._ingestion_date == datetime.date(2024, 2, 3)


def test_unknown_entity_is_refused(spark):
    with pytest.raises(ValueError, match="Unknown entity"):
        entity("loans")
    with pytest.raises(ValueError):
        bronze.parse_events(messages(spark, []), "loans")


def envelope(op, row, text=False, wrapped=False):
    image = {k: v for k, v in row.items() if not k.startswith("__")}
    image = json.dumps(image) if text else image
    body = {
        "before": image if op == "d" else None,
        "after": None if op == "d" else image,
        "source": {"db": "banking_core", "table": "transactions", "ts_ms": 9},
        "op": op,
        "ts_ms": 10,
    }
    return {"payload": body} if wrapped else body


@pytest.mark.parametrize("text", [False, True])
@pytest.mark.parametrize("wrapped", [False, True])
@pytest.mark.parametrize("op", ["c", "r", "u", "d"])
def test_envelopes_unwrap_to_the_flat_form(spark, op, text, wrapped):
    row = transaction(1, op, 9, merchant_name=' "Q" \\ é ')
    feed = messages(spark, [envelope(op, row, text, wrapped)])
    flat = messages(spark, [row])
    got = bronze.parse_events(bronze.unwrap_envelope(feed, TRANSACTIONS), TRANSACTIONS)
    want = bronze.parse_events(flat, TRANSACTIONS)
    columns = [c for c in want.columns if not c.startswith("_ingestion")]
    assert got.select(columns).collect() == want.select(columns).collect()
    unwrapped = json.loads(bronze.unwrap_envelope(feed, TRANSACTIONS).first().value)
    assert unwrapped["__deleted"] == ("true" if op == "d" else "false")


def test_what_is_no_envelope_passes_unwrapping_unchanged(spark):
    feed = messages(spark, [None, "{bad", transaction(3)])
    before = [r.value for r in feed.collect()]
    after = bronze.unwrap_envelope(feed, TRANSACTIONS)
    assert after.columns == feed.columns
    assert [r.value for r in after.collect()] == before


def test_text_is_parsed_once(spark, run_dir):
    """A filter on the key must not bring a second parse of the message."""
    messages(spark, [transaction(1)]).write.parquet(run_dir)
    rows = bronze.parse_events(spark.read.parquet(run_dir), "transactions")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert T0_US == 1704067200000000


@pytest.mark.parametrize("text", ['{"op":"c","after":"{bad","source":{"ts_ms":1}}', '{"op":"t","source":{"ts_ms":1}}'])
def test_envelopes_without_a_key_are_rejected_as_they_came(spark, text):
    feed = messages(spark, [text], TRANSACTIONS.topic)
    flat = bronze.unwrap_envelope(feed, TRANSACTIONS)
    assert bronze.parse_events(flat, TRANSACTIONS).count() == 0
    (row,) = bronze.rejected_messages(flat, TRANSACTIONS).collect()
    assert (row.message, row.reason) == (text, "NO_KEY")
