"""Change feeds derived by Spark from the star-schema and event tables.

The tables hold no banking records, so tests, checks and the bench turn them into the messages
a capture of customers, accounts and transactions would send: creates, updates, deletes,
re-deliveries, tombstones and broken text. Only integer arithmetic decides what happens to a
row, so a SQL engine can restate it exactly. All rows of the source tables are used.

The messages are written as files, slice by slice in time order, the way a topic would hold
them. A feed built and parsed in one lazy plan would have the optimizer reason through both.

A feed is made in two steps. ``*_changes`` says which messages there are: short rows of source
columns with the message's time. ``*_records`` turns these into messages. Cutting and dealing out a
feed needs only the first, so text is made once for each message, where it is written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.spec import ACCOUNTS, CUSTOMERS, KAFKA_RECORD, TRANSACTIONS, Entity, ddl

# Fixed values of the derivation.
T0 = 1704067200000000
SQUEEZE = 144
ONBOARDED = 788832000000000
CLOSED_MS = 1009843200000
HEARTBEAT_ACCOUNT = "ACC_SENTINEL"
HEARTBEAT_ID = "TXN_SENTINEL"
TOPIC_PARTITIONS = 3
FILES_PER_SLICE = 4
MESSAGES_PER_FILE = 100_000


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _pad(prefix: str, number: str, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(number).cast("string"), width, "0"))


def _message(spec: Entity, key: Column, body: Column, number: Column, offset, ts_ms) -> list[Column]:
    return [
        key.cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.lit(spec.topic).alias("topic"),
        F.pmod(number, F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        offset.alias("offset"),
        F.timestamp_millis(ts_ms).alias("timestamp"),
    ]


def _markers(table: str, op: Column, ts_ms: Column) -> list[Column]:
    return [
        op.alias("__op"),
        ts_ms.alias("__source_ts_ms"),
        F.lit("banking_core").alias("__source_db"),
        F.lit(table).alias("__source_table"),
        F.when(op == "d", "true").otherwise("false").alias("__deleted"),
    ]


def transaction_changes(events: DataFrame) -> DataFrame:
    """One row per message to send: the source columns, ``n`` (which message of its event it is),
    ``ts_ms`` and ``timestamp``."""
    e, n = F.col("event_id"), F.col("n")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    sent = [
        F.lit(0),
        F.when(e % 25 == 11, 1),
        F.when(e % 10 == 3, 2),
        F.when(e % 40 == 7, 3),
        F.when(e % 40 == 7, 4),
        F.when(e % 500 == 499, 5),
    ]
    delay_ms = F.when(n == 2, 60_000).when(n.isin(3, 4), 120_000).otherwise(0)
    rows = events.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "props",
        (F.lit(T0) + F.floor((micros - F.lit(T0)) / SQUEEZE)).cast("bigint").alias(
            "transaction_timestamp"
        ),
        F.explode(F.array_compact(F.array(*sent))).alias("n"),
    )
    ts_ms = F.floor(F.col("transaction_timestamp") / 1000).cast("bigint") + delay_ms
    return rows.withColumn("ts_ms", ts_ms).withColumn("timestamp", F.timestamp_millis("ts_ms"))


def transaction_events(changes: DataFrame) -> DataFrame:
    """The payload columns and ``op`` of :func:`transaction_changes`, and ``event_id``, ``n``, ``ts_ms``."""
    e, n = F.col("event_id"), F.col("n")
    amount = F.when(e % 101 == 0, F.lit(None)).when(e % 103 == 0, F.lit(-1.0)).otherwise(
        (F.round(F.col("value") * 100).cast("bigint") * 200 + e % 100).cast("double")
        / F.lit(100.0)
    )
    status = F.when(F.col("event_type") == "error", "failed").otherwise("completed ")
    return changes.select(
        e,
        _pad("TXN", "event_id", 12).alias("transaction_id"),
        _pad("ACC", "user_id", 10).alias("account_id"),
        F.when(e % 97 == 0, "FEE")
        .when(e % 2 == 0, " debit ")
        .otherwise("CREDIT")
        .alias("transaction_type"),
        F.when(n == 2, amount + 1).otherwise(amount).alias("amount"),
        _pick(["aed", "USD ", "EUR", "GBP"], e % 4).alias("currency"),
        F.concat(F.lit(" Merchant "), F.get_json_object("props", "$.k"), F.lit(" ")).alias(
            "merchant_name"
        ),
        F.when(F.col("event_type") == "click", "crypto")
        .when(F.col("event_type") == "view", "GROCERIES")
        .when(F.col("event_type") == "purchase", "Shopping")
        .when(F.col("event_type") == "signup", "TRAVEL")
        .otherwise("GAMBLING")
        .alias("merchant_category"),
        "transaction_timestamp",
        _pick(["ae", "US", "GB", "SA", "IN"], e % 5).alias("country"),
        (e % 3 == 0).alias("is_international"),
        F.when((n == 2) & (e % 20 == 3), "reversed").otherwise(status).alias("status"),
        F.col("transaction_timestamp").alias("created_at"),
        n,
        F.when(n <= 1, F.when(e % 50 == 1, "r").otherwise("c"))
        .when(n == 2, "u")
        .when(n == 3, "d")
        .alias("op"),
        "ts_ms",
    )


def transaction_records(changes: DataFrame) -> DataFrame:
    rows = transaction_events(changes)
    body = F.to_json(
        F.struct(*TRANSACTIONS.columns, *_markers("transactions", F.col("op"), F.col("ts_ms")))
    )
    return _transaction_records(rows, body)


def envelope_records(changes: DataFrame) -> DataFrame:
    """The same changes before unwrapping: images as objects or as text, bare or in ``payload``."""
    rows = transaction_events(changes)
    image = F.to_json(F.struct(*TRANSACTIONS.columns))
    is_delete = F.col("op") == "d"
    source = F.to_json(
        F.struct(
            F.lit("banking_core").alias("db"),
            F.lit("transactions").alias("table"),
            F.col("ts_ms"),
        )
    )
    quoted = F.to_json(F.struct(image.alias("v")))
    as_text = F.substring(quoted, F.lit(6), F.length(quoted) - 6)
    shown = F.when(F.col("event_id") % 3 == 1, as_text).otherwise(image)
    envelope = F.format_string(
        '{"before":%s,"after":%s,"source":%s,"op":"%s","ts_ms":%d}',
        F.when(is_delete, shown).otherwise("null"),
        F.when(is_delete, "null").otherwise(shown),
        source,
        F.col("op"),
        F.col("ts_ms"),
    )
    wrapped = F.when(
        F.col("event_id") % 3 == 2, F.concat(F.lit('{"payload":'), envelope, F.lit("}"))
    ).otherwise(envelope)
    return _transaction_records(rows, wrapped)


def _transaction_records(rows: DataFrame, body: Column) -> DataFrame:
    value = F.when(F.col("n") <= 3, body).when(F.col("n") == 5, "{bad")
    return rows.select(
        *_message(
            TRANSACTIONS,
            F.col("transaction_id"),
            value,
            F.col("event_id"),
            F.col("event_id") * 10 + F.col("n"),
            F.col("ts_ms"),
        )
    )


def heartbeat(spark: SparkSession, after_micros: Column | int, offset: int) -> DataFrame:
    """A last transaction two hours on, so that append mode closes every window before it."""
    at = after_micros + 7_200_000_000
    body = F.to_json(
        F.struct(
            F.lit(HEARTBEAT_ID).alias("transaction_id"),
            F.lit(HEARTBEAT_ACCOUNT).alias("account_id"),
            F.lit("DEBIT").alias("transaction_type"),
            F.lit(1.0).alias("amount"),
            F.lit(at).alias("transaction_timestamp"),
            F.lit("COMPLETED").alias("status"),
            *_markers("transactions", F.lit("c"), F.lit(at // 1000)),
        )
    )
    return spark.range(1).select(
        *_message(
            TRANSACTIONS,
            F.lit(HEARTBEAT_ID),
            body,
            F.lit(0),
            F.lit(offset).cast("bigint"),
            F.lit(at // 1000),
        )
    )


def customer_changes(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per message to send: ``c_custkey``, what changes, ``offset``, ``ts_ms`` and
    ``timestamp``. All else that a message says follows from the key."""
    k = F.col("c_custkey")

    def event(op: str, ts_ms: Column, offset: Column, risk: Column, kyc: Column) -> list[Column]:
        return [
            k,
            F.lit(op).alias("op"),
            ts_ms.alias("ts_ms"),
            offset.alias("offset"),
            risk.cast("int").alias("risk_score"),
            kyc.alias("kyc_status"),
        ]

    own_risk = F.when(k % 59 == 0, F.lit(0)).otherwise(1 + k % 100)
    snapshot = customer.select(
        *event("r", F.lit(ONBOARDED // 1000), k, own_risk, F.lit("verified"))
    )
    updates = customer.select(k).join(orders, k == F.col("o_custkey")).select(
        *event(
            "u",
            F.unix_millis(F.col("o_orderdate").cast("timestamp")),
            10_000_000 + F.col("o_orderkey"),
            1 + F.col("o_orderkey") % 100,
            F.when(F.col("o_orderstatus") == "F", "VERIFIED")
            .when(F.col("o_orderstatus") == "O", "PENDING")
            .otherwise("REJECTED"),
        ),
    )
    deletes = customer.where(k % 61 == 5).select(
        *event("d", F.lit(CLOSED_MS), 100_000_000 + k, own_risk, F.lit("verified"))
    )
    rows = snapshot.unionByName(updates).unionByName(deletes)
    return rows.withColumn("timestamp", F.timestamp_millis("ts_ms"))


def customer_records(changes: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    rows = changes.select(
        "*",
        _pad("CUST", "c_custkey", 10).alias("customer_id"),
        F.concat(F.lit(" First"), k.cast("string"), F.lit(" ")).alias("first_name"),
        F.concat(F.lit("Last"), k.cast("string")).alias("last_name"),
        F.when(k % 37 == 0, F.lit(None))
        .when(k % 41 == 0, "dup@example.org")
        .otherwise(F.concat(F.lit("c"), k.cast("string"), F.lit("@example.org ")))
        .alias("email"),
        _pad(" +971", "c_custkey", 9).alias("phone"),
        (k % 20000).cast("int").alias("date_of_birth"),
        _pick([" ae", "IN", "PK", "US"], k % 4).alias("nationality"),
        F.lit(ONBOARDED).alias("onboarding_date"),
        F.when(k % 67 == 0, "VIP")
        .otherwise(_pick(["retail", "corporate", "private_banking"], k % 3))
        .alias("customer_segment"),
        F.lit("ae").alias("country_residence"),
        F.lit(ONBOARDED).alias("created_at"),
        F.lit(ONBOARDED).alias("updated_at"),
    )
    body = F.to_json(
        F.struct(*CUSTOMERS.columns, *_markers("customers", F.col("op"), F.col("ts_ms")))
    )
    return rows.select(
        *_message(
            CUSTOMERS, F.col("customer_id"), body, k, F.col("offset"), F.col("ts_ms")
        )
    )


def account_changes(customer: DataFrame) -> DataFrame:
    """One row per message to send: the source columns, ``n``, ``ts_ms`` and ``timestamp``."""
    k = F.col("c_custkey")
    sent = F.array_compact(F.array(F.lit(0), F.when(k % 5 == 2, 1)))
    rows = customer.select("c_custkey", "c_acctbal", F.explode(sent).alias("n"))
    ts_ms = (F.lit(ONBOARDED // 1000) + F.col("n") * 60_000).cast("bigint")
    return rows.withColumn("ts_ms", ts_ms).withColumn("timestamp", F.timestamp_millis("ts_ms"))


def account_records(changes: DataFrame) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("n")
    balance = F.when(k % 23 != 6, F.col("c_acctbal"))
    rows = changes.select(
        k,
        _pad("ACC", "c_custkey", 10).alias("account_id"),
        F.when(k % 53 == 0, "CUST9999999999")
        .otherwise(_pad("CUST", "c_custkey", 10))
        .alias("customer_id"),
        _pick(["SAVINGS", "checking ", "CREDIT_CARD", "LOAN"], k % 4).alias("account_type"),
        _pick(["AED", "USD", "EUR", "GBP"], k % 4).alias("currency"),
        F.when(n == 1, balance + 100).otherwise(balance).alias("balance"),
        F.when(k % 19 == 4, F.lit(None))
        .when(k % 71 == 9, "dormant")
        .otherwise("active")
        .alias("status"),
        F.lit(ONBOARDED).alias("opened_date"),
        F.lit(ONBOARDED).alias("last_activity_date"),
        F.lit(ONBOARDED).alias("created_at"),
        F.lit(ONBOARDED).alias("updated_at"),
        n,
        F.when(n == 1, "u").otherwise("r").alias("op"),
        "ts_ms",
    )
    body = F.to_json(
        F.struct(*ACCOUNTS.columns, *_markers("accounts", F.col("op"), F.col("ts_ms")))
    )
    return rows.select(
        *_message(
            ACCOUNTS, F.col("account_id"), body, k, k * 10 + F.col("n"), F.col("ts_ms")
        )
    )


def write_slices(
    messages: DataFrame,
    path: str,
    slices: int,
    files: int,
    per_file: int = MESSAGES_PER_FILE,
    records: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> int:
    """Writes a feed as ``slices`` consecutive stretches of time, each of the same number of files.

    That number is ``files``, or more, so that a file holds about ``per_file`` messages at most: the
    number of tasks grows with the feed, and what one of them reads does not. A file stream that
    takes so many files per trigger then reads one slice per micro-batch.

    ``messages`` holds a row per message with its ``timestamp``; ``records`` makes the messages of
    such rows. It comes last, after a slice's rows are dealt out to files: the cuts need only the
    times, and no text is moved or made twice.

    Returns the number of files in a slice.
    """
    t = F.unix_millis("timestamp")
    bounds: list[int] = []
    if slices > 1:
        shares = [i / slices for i in range(1, slices)]
        n, first, cuts = messages.agg(
            F.count(F.lit(1)), F.min(t), F.percentile_approx(t, shares, 1000)
        ).first()
        bounds = sorted({b for b in cuts or [] if b > first})
    else:
        n = messages.count()
    files = max(files, -(-n // (slices * per_file)))
    edges = [None, *bounds, None]
    for low, high in zip(edges, edges[1:]):
        part = messages
        if low is not None:
            part = part.where(t >= low)
        if high is not None:
            part = part.where((t < high) if low is not None else (t < high) | t.isNull())
        # By the rows' hash: dealt out in turn they would have to be sorted first.
        part = records(part.repartition(files, *part.columns))
        part.select(*ddl(KAFKA_RECORD).fieldNames()).write.mode("append").parquet(path)
    return files
