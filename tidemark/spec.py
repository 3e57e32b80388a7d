"""Entities of the change feed and the declared schemas of every table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- Fixed values: names, types and tags every reader of these tables relies on -------------

TRANSACTION_PAYLOAD = """
    transaction_id string, account_id string, transaction_type string, amount double,
    currency string, merchant_name string, merchant_category string,
    transaction_timestamp bigint, country string, is_international boolean, status string,
    created_at bigint
"""

CUSTOMER_PAYLOAD = """
    customer_id string, first_name string, last_name string, email string, phone string,
    date_of_birth int, nationality string, risk_score int, kyc_status string,
    onboarding_date bigint, customer_segment string, country_residence string,
    created_at bigint, updated_at bigint
"""

ACCOUNT_PAYLOAD = """
    account_id string, customer_id string, account_type string, currency string,
    balance double, status string, opened_date bigint, last_activity_date bigint,
    created_at bigint, updated_at bigint
"""

CHANGE_MARKERS = """
    __op string, __source_ts_ms bigint, __source_db string, __source_table string,
    __deleted string
"""

MARKER_NAMES = {
    "__op": "cdc_operation",
    "__source_ts_ms": "cdc_timestamp_ms",
    "__source_table": "source_table",
    "__source_db": "source_database",
}

BRONZE_AUDIT = """
    _ingestion_timestamp timestamp, _ingestion_date date, _entity_type string,
    _data_classification string, _data_residency string
"""

DATA_CLASSIFICATION = "CONFIDENTIAL"
DATA_RESIDENCY = "UAE"

ENVELOPE = """
    before string, after string,
    source struct<version: string, connector: string, name: string, ts_ms: bigint, db: string,
                  schema: string, table: string, txId: bigint, lsn: bigint>,
    op string, ts_ms bigint,
    transaction struct<id: string, total_order: bigint, data_collection_order: bigint>
"""

SILVER_TRANSACTIONS = """
    transaction_id string, account_id string, transaction_type string, amount decimal(18,2),
    currency string, merchant_name string, merchant_category string,
    transaction_timestamp timestamp, country string, is_international boolean, status string,
    _created_at timestamp, _updated_at timestamp, _is_deleted boolean,
    _silver_processed_at timestamp
"""

SILVER_CUSTOMERS = """
    customer_id string, first_name string, last_name string, email string, phone string,
    date_of_birth date, nationality string, risk_score int, kyc_status string,
    onboarding_date timestamp, customer_segment string, country_residence string,
    effective_from timestamp, effective_to timestamp, is_current boolean,
    _created_at timestamp, _updated_at timestamp, _silver_processed_at timestamp,
    cdc_operation string, _ingestion_timestamp timestamp
"""

GOLD_METRICS = """
    account_id string, window_start timestamp, window_end timestamp, transaction_count int,
    total_amount double, avg_amount double, max_amount double, _gold_processed_at timestamp
"""

GOLD_ALERTS = """
    alert_id string, account_id string, alert_type string, severity string, risk_score int,
    window_start timestamp, window_end timestamp, transaction_count int, total_amount double,
    avg_amount double, max_amount double, risk_factors array<string>,
    alert_timestamp timestamp, _gold_processed_at timestamp
"""

KAFKA_RECORD = """
    key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp
"""

INSERT_OPS = ("c", "r")
CHANGE_OPS = ("u", "d")
VALID_TRANSACTION_TYPES = ("DEBIT", "CREDIT")

# --- Derived from the above ------------------------------------------------------------------

# Place of an event in its feed. Kept beside the payload so that events of one key can be put
# in order long after they left the topic.
FEED_POSITION = "_feed_partition int, _feed_offset bigint"


def ddl(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


@dataclass(frozen=True)
class Entity:
    """One captured table: its key, payload, and which payload numbers are really times."""

    name: str
    key: str
    payload: str
    micros: tuple[str, ...] = ()
    days: tuple[str, ...] = ()
    topic: str = field(default="")

    @property
    def wire_schema(self) -> T.StructType:
        return T.StructType(ddl(self.payload).fields + ddl(CHANGE_MARKERS).fields)

    @property
    def columns(self) -> list[str]:
        return ddl(self.payload).fieldNames()

    @property
    def bronze_schema(self) -> T.StructType:
        typed = [
            T.StructField(
                f.name,
                T.TimestampType()
                if f.name in self.micros
                else T.DateType()
                if f.name in self.days
                else f.dataType,
                f.name != self.key,
            )
            for f in ddl(self.payload).fields
        ]
        markers = [
            T.StructField(MARKER_NAMES[f.name], f.dataType)
            for name in MARKER_NAMES
            for f in ddl(CHANGE_MARKERS).fields
            if f.name == name
        ]
        return T.StructType(typed + markers + ddl(BRONZE_AUDIT).fields + ddl(FEED_POSITION).fields)


TRANSACTIONS = Entity(
    "transactions",
    "transaction_id",
    TRANSACTION_PAYLOAD,
    micros=("transaction_timestamp", "created_at"),
    topic="cdc.public.transactions",
)
CUSTOMERS = Entity(
    "customers",
    "customer_id",
    CUSTOMER_PAYLOAD,
    micros=("onboarding_date", "created_at", "updated_at"),
    days=("date_of_birth",),
    topic="cdc.public.customers",
)
ACCOUNTS = Entity(
    "accounts",
    "account_id",
    ACCOUNT_PAYLOAD,
    micros=("opened_date", "last_activity_date", "created_at", "updated_at"),
    topic="cdc.public.accounts",
)

ENTITIES = {e.name: e for e in (TRANSACTIONS, CUSTOMERS, ACCOUNTS)}


def entity(name: str | Entity) -> Entity:
    if isinstance(name, Entity):
        return name
    if name not in ENTITIES:
        raise ValueError(f"Unknown entity: {name!r}; known: {sorted(ENTITIES)}")
    return ENTITIES[name]
