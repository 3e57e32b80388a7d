"""Small literal inputs shared by the tests."""

import json

from pyspark.sql import functions as F

from tidemark.spec import CUSTOMERS, KAFKA_RECORD, TRANSACTIONS, ddl

T0_US = 1704067200000000
MINUTE_US = 60_000_000


def transaction(n, op="c", ts_ms=None, **fields):
    ts_ms = ts_ms if ts_ms is not None else 1704067200000 + n
    row = {
        "transaction_id": f"T{n}",
        "account_id": "A1",
        "transaction_type": " debit ",
        "amount": 10.0,
        "currency": "aed",
        "merchant_name": " Shop ",
        "merchant_category": "fuel",
        "transaction_timestamp": T0_US,
        "country": "ae",
        "is_international": False,
        "status": "completed ",
        "created_at": T0_US,
        "__op": op,
        "__source_ts_ms": ts_ms,
        "__source_db": "banking_core",
        "__source_table": "transactions",
        "__deleted": "true" if op == "d" else "false",
    }
    row.update(fields)
    return row


def customer(n, op="c", ts_ms=0, **fields):
    row = {
        "customer_id": f"C{n}",
        "first_name": " Ann ",
        "last_name": "Lee",
        "email": f"c{n}@example.org",
        "phone": "1",
        "date_of_birth": 10,
        "nationality": "ae",
        "risk_score": 1,
        "kyc_status": "verified",
        "onboarding_date": T0_US,
        "customer_segment": "retail",
        "country_residence": "ae",
        "created_at": T0_US,
        "updated_at": T0_US,
        "__op": op,
        "__source_ts_ms": ts_ms,
        "__source_db": "banking_core",
        "__source_table": "customers",
        "__deleted": "false",
    }
    row.update(fields)
    return row


def messages(spark, rows, topic=TRANSACTIONS.topic, start=0):
    """Rows (dicts, raw strings or None) as Kafka-shaped messages with rising offsets."""
    data = []
    for i, row in enumerate(rows):
        value = json.dumps(row) if isinstance(row, dict) else row
        data.append((f"k{i}", value, topic, 0, start + i))
    df = spark.createDataFrame(
        data, "key string, value string, topic string, partition int, offset bigint"
    )
    return df.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        "topic",
        "partition",
        "offset",
        F.current_timestamp().alias("timestamp"),
    ).select(*ddl(KAFKA_RECORD).fieldNames())


def parsed(spark, rows, spec=TRANSACTIONS, start=0):
    from tidemark.operators.bronze import parse_events

    return parse_events(messages(spark, rows, spec.topic, start), spec)


def parsed_customers(spark, rows, start=0):
    return parsed(spark, rows, CUSTOMERS, start)


def same_rows(left, right):
    """Both frames hold the same rows, whatever their order."""
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    a = sorted(map(str, left.select(*columns).collect()))
    b = sorted(map(str, right.select(*columns).collect()))
    assert a == b
