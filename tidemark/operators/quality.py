"""Source constraints as Spark checks.

A check passes on null, as it does in SQL; only the not-null rules look for nulls.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import now_or
from tidemark.operators import accounts, transactions
from tidemark.operators.skew import filter_by_keys
from tidemark.spec import ENTITIES

# --- Fixed values: domains, ranges, keys and defaults of the source tables --------------------

DOMAINS = {
    "customers": {
        "kyc_status": ("VERIFIED", "PENDING", "REJECTED"),
        "customer_segment": ("RETAIL", "CORPORATE", "PRIVATE_BANKING"),
    },
    "accounts": {
        "account_type": ("SAVINGS", "CHECKING", "CREDIT_CARD", "LOAN"),
        "currency": ("AED", "USD", "EUR", "GBP", "SAR"),
        "status": ("ACTIVE", "INACTIVE", "FROZEN", "CLOSED"),
    },
    "transactions": {
        "transaction_type": ("DEBIT", "CREDIT"),
        "status": ("COMPLETED", "PENDING", "FAILED", "REVERSED"),
    },
}

REQUIRED = {
    "customers": ("first_name", "last_name", "email"),
    "accounts": ("customer_id",),
    "transactions": ("account_id", "amount"),
}

UNIQUE = {
    "customers": ("customer_id", "email"),
    "accounts": ("account_id",),
    "transactions": ("transaction_id",),
}

FOREIGN_KEYS = {
    "accounts": ("customer_id", "customers"),
    "transactions": ("account_id", "accounts"),
}

DEFAULT_VALUES = {
    "customers": {},
    "accounts": {"balance": 0.0, "status": "ACTIVE"},
    "transactions": {"is_international": False, "status": "COMPLETED"},
}

# Columns whose default is the time of the write.
DEFAULT_TIMES = {
    "customers": ("onboarding_date", "created_at", "updated_at"),
    "accounts": ("opened_date", "created_at", "updated_at"),
    "transactions": ("transaction_timestamp", "created_at"),
}


def domain_rules(entity: str) -> dict[str, Column]:
    return {c: ~F.col(c).isin(*values) for c, values in DOMAINS[entity].items()}


def range_rules(entity: str) -> dict[str, Column]:
    if entity == "customers":
        return {"risk_score": ~F.col("risk_score").between(1, 100)}
    if entity == "transactions":
        return {"amount": ~(F.col("amount") > 0)}
    return {}


def not_null_rules(entity: str) -> dict[str, Column]:
    return {c: F.col(c).isNull() for c in REQUIRED[entity]}


def rules(entity: str) -> dict[str, Column]:
    """All row rules as ``kind:column``, in a fixed order: the bits of a mask."""
    kinds = {"domain": domain_rules, "range": range_rules, "not_null": not_null_rules}
    return {
        f"{kind}:{column}": broken
        for kind, of in kinds.items()
        for column, broken in of(entity).items()
    }


def checked_rows(bronze: DataFrame, entity: str) -> DataFrame:
    """Event rows with codes normalized and nothing filtered."""
    if entity == "transactions":
        return transactions.normalize_transactions(bronze)
    if entity == "accounts":
        return accounts.normalize_accounts(bronze)
    return bronze.withColumns({c: F.upper(F.trim(c)) for c in ("kyc_status", "customer_segment")})


def broken_mask(entity: str) -> Column:
    """One bit per rule of :func:`rules` that a checked row breaks."""
    bits = [
        F.when(broken, F.lit(1 << k)).otherwise(F.lit(0))
        for k, broken in enumerate(rules(entity).values())
    ]
    return reduce(Column.bitwiseOR, bits)


def row_violations(bronze: DataFrame, entity: str) -> DataFrame:
    """Rows that break a rule: entity, key, event, position, mask and names. One pass, no shuffle."""
    names = list(rules(entity))
    broken = F.filter(
        F.array(*[F.when(F.col("mask").bitwiseAND(1 << k) != 0, F.lit(n)) for k, n in enumerate(names)]),
        lambda n: n.isNotNull(),
    )
    return (
        checked_rows(bronze, entity)
        .select(
            F.lit(entity).alias("entity"),
            F.col(ENTITIES[entity].key).alias("key_value"),
            "cdc_operation",
            "cdc_timestamp_ms",
            "_feed_partition",
            "_feed_offset",
            broken_mask(entity).alias("mask"),
        )
        .where("mask <> 0")
        .withColumn("broken", broken)
    )


def violations(rows: DataFrame, entity: str, rules: dict[str, Column]) -> DataFrame:
    """Rows and violations per rule. One pass for all rules; each task sends one row."""
    counts = rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.array(
            *[
                F.struct(F.lit(name).alias("column_name"), F.count_if(broken).alias("n_violations"))
                for name, broken in rules.items()
            ]
        ).alias("per_rule"),
    )
    return counts.select(F.lit(entity).alias("entity"), "n_rows", F.inline("per_rule"))


def duplicates(rows: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once. Counting combines on the map side."""
    return (
        rows.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key_value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def orphan_keys(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign key values without a parent, and the rows that carry them.

    The child side is counted per value before the join, so a value that many rows share is
    one row in it.
    """
    used = (
        child.where(F.col(fk).isNotNull())
        .groupBy(F.col(fk).alias("key_value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return used.join(parent.select(F.col(pk).alias("key_value")), "key_value", "left_anti")


def cascade_accounts(deleted_customers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Accounts that go when their customers go. ``deleted_customers`` has unique ids."""
    gone = deleted_customers.select("customer_id")
    return filter_by_keys(accounts, gone, "customer_id", "left_semi", ["account_id"])


def cascade_transactions(deleted_accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Transactions that go when their accounts go. ``deleted_accounts`` has unique ids."""
    gone = deleted_accounts.select("account_id")
    return filter_by_keys(transactions, gone, "account_id", "left_semi", ["transaction_id"])


def cascade(deleted_customers: DataFrame, accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Rows (entity, key_value) of all accounts and transactions that go with their customers.

    Both are rows that hang on an account, its own row and the rows that name it, so the accounts that
    go are found once and filter the two together.
    """
    lost = cascade_accounts(deleted_customers, accounts)
    hanging = accounts.select(
        "account_id", F.lit("accounts").alias("entity"), F.col("account_id").alias("key_value")
    ).unionByName(
        transactions.select(
            "account_id", F.lit("transactions").alias("entity"), F.col("transaction_id").alias("key_value")
        )
    )
    gone = filter_by_keys(
        hanging, lost.select("account_id"), "account_id", "left_semi", ["entity", "key_value"]
    )
    return gone.select("entity", "key_value")


def fill_defaults(rows: DataFrame, entity: str, written_at=None) -> DataFrame:
    return rows.withColumns(
        {
            **{
                c: F.coalesce(F.col(c), F.lit(value))
                for c, value in DEFAULT_VALUES[entity].items()
            },
            **{c: F.coalesce(F.col(c), now_or(written_at)) for c in DEFAULT_TIMES[entity]},
        }
    )
