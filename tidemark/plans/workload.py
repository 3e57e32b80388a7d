"""The registered queries: one function per operator, over one folder of source tables.

Times leave as epoch numbers and decimals as doubles, so that any engine's result can be
compared value by value; run-dependent columns (arrival and processing times) are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import (
    accounts,
    bronze,
    customers,
    metrics,
    quality,
    screening,
    snapshot,
    transactions,
)
from tidemark.plans import checks, silver
from tidemark.plans.workspace import Workspace
from tidemark.sources import derived, feed
from tidemark.spec import ENTITIES, TRANSACTIONS, entity

# Instants asked for by the as-of and snapshot queries, epoch milliseconds.
AS_OF_MS = 883612800000
SNAPSHOT_MS = 1704076200000

MARKERS = ["cdc_operation", "cdc_timestamp_ms", "source_table", "source_database"]
TAGS = ["_entity_type", "_data_classification", "_data_residency"]
POSITION = ["_feed_partition", "_feed_offset"]


def _micros(name: str) -> Column:
    return F.unix_micros(name).alias(f"{name}_us")


def _millis(name: str) -> Column:
    return F.unix_millis(name).alias(f"{name}_ms")


def _double(name: str) -> Column:
    return F.col(name).cast("double").alias(name)


def _joined(name: str) -> Column:
    return F.array_join(name, ",").alias(name)


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- Bronze ------------------------------------------------------------------------------------


def _bronze_rows(rows: DataFrame, name: str) -> DataFrame:
    spec = entity(name)
    payload = [
        _micros(c)
        if c in spec.micros
        else F.unix_date(c).alias(f"{c}_days")
        if c in spec.days
        else F.col(c)
        for c in spec.columns
    ]
    return rows.select(*payload, *MARKERS, *TAGS, *POSITION)


def bronze_table(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = bronze.parse_events(Workspace.of(spark, sf_dir).feed(name), name)
        return _bronze_rows(rows, name)

    return query


def _rejected(rows: DataFrame) -> DataFrame:
    return rows.select(
        "topic",
        F.col("partition").alias("feed_partition"),
        F.col("offset").alias("feed_offset"),
        "message_key",
        "message",
        "reason",
    )


def bronze_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace.of(spark, sf_dir)
    return _union(_rejected(bronze.rejected_messages(space.feed(e), e)) for e in ENTITIES)


def bronze_op_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace.of(spark, sf_dir)
    return _union(
        space.bronze(name)
        .groupBy(F.col("_entity_type").alias("entity"), "cdc_operation")
        .agg(F.count(F.lit(1)).alias("n_events"))
        for name in ENTITIES
    )


def envelope_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = Workspace.of(spark, sf_dir).feed("envelopes")
    return _bronze_rows(bronze.parse_envelopes(messages, TRANSACTIONS), "transactions")


def envelope_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by way of flat messages, as for feeds that hold both kinds."""
    messages = Workspace.of(spark, sf_dir).feed("envelopes")
    flat = bronze.unwrap_envelope(messages, TRANSACTIONS)
    return _bronze_rows(bronze.parse_events(flat, TRANSACTIONS), "transactions")


def envelope_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = Workspace.of(spark, sf_dir).feed("envelopes")
    return _rejected(bronze.rejected_envelopes(messages, TRANSACTIONS))


# --- Silver transactions -----------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions.clean_transactions(Workspace.of(spark, sf_dir).bronze("transactions"))


def _current(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Current transactions, reading only the columns named."""
    rows = Workspace.of(spark, sf_dir).bronze("transactions")
    return transactions.upsert(rows, columns or transactions.BUSINESS)


def _current_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "transaction_id",
        "account_id",
        "transaction_type",
        _double("amount"),
        "currency",
        "merchant_name",
        "merchant_category",
        _micros("transaction_timestamp"),
        "country",
        "is_international",
        "status",
        _millis("_created_at"),
        _millis("_updated_at"),
        "_is_deleted",
        "_source_ts_ms",
        "_source_offset",
    )


def silver_transactions_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir)
    return rows.select(
        *[
            _double(c) if c == "amount" else _micros(c) if c == "transaction_timestamp" else c
            for c in rows.columns
        ]
    )


def silver_transactions_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _current_rows(_current(spark, sf_dir))


def silver_transactions_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _current_rows(transactions.live(_current(spark, sf_dir)))


def silver_transactions_inserts_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert with snapshot rows left out, so only ``c`` inserts."""
    rows = Workspace.of(spark, sf_dir).bronze("transactions")
    return _current_rows(transactions.upsert(rows, insert_ops=("c",)))


def silver_orphan_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = transactions.collapse(_events(spark, sf_dir), ("account_id", "amount"))
    return transactions.orphan_changes(state).select(
        "transaction_id",
        "account_id",
        _double("amount"),
        "_is_deleted",
        "_source_ts_ms",
        "_source_offset",
    )


def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live transactions as they stood in mid-feed against those at its end."""
    early = F.col("_source_ts_ms") <= SNAPSHOT_MS
    rows = transactions.live_at_two_times(_events(spark, sf_dir), early, ("amount", "status"))
    return _diff_rows(snapshot.compare(rows, "transaction_id"))


def _diff_rows(diff: DataFrame) -> DataFrame:
    return diff.select(
        "transaction_id",
        "op",
        F.col("before.amount").cast("double").alias("amount_before"),
        F.col("before.status").alias("status_before"),
        F.col("after.amount").cast("double").alias("amount_after"),
        F.col("after.status").alias("status_after"),
    )


def initial_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live transactions as the reads a capture starts with."""
    rows = Workspace.of(spark, sf_dir).bronze("transactions")
    columns = ("amount", "status")
    live = transactions.live(transactions.upsert(rows, columns))
    return snapshot.initial_snapshot(live, "transaction_id", columns).select(
        "transaction_id",
        "op",
        F.col("before").isNull().alias("nothing_before"),
        F.col("after.amount").cast("double").alias("amount_after"),
        F.col("after.status").alias("status_after"),
    )


# --- Silver customers --------------------------------------------------------------------------


def _customer_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers.clean_customers(Workspace.of(spark, sf_dir).bronze("customers"))


def _customer_columns(*more) -> list:
    return [
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "phone",
        F.unix_date("date_of_birth").alias("date_of_birth_days"),
        "nationality",
        "risk_score",
        "kyc_status",
        _micros("onboarding_date"),
        "customer_segment",
        "country_residence",
        "cdc_operation",
        *more,
    ]


def _version_rows(versions: DataFrame) -> DataFrame:
    return versions.select(
        *_customer_columns(
            _millis("effective_from"),
            _millis("effective_to"),
            "is_current",
            "_source_offset",
        )
    )


def silver_customers_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_events(spark, sf_dir).select(
        *_customer_columns("_source_ts_ms", "_source_offset")
    )


def silver_customers_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _version_rows(customers.close_intervals(_customer_events(spark, sf_dir)))


def silver_customers_scd2_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History without versions that repeat the one before."""
    events = customers.changes_only(_customer_events(spark, sf_dir))
    return _version_rows(customers.close_intervals(events))


def silver_customers_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = customers.as_of(_customer_events(spark, sf_dir))
    return rows.select(*_customer_columns("_source_ts_ms", "_source_offset"))


def silver_customers_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = customers.as_of(_customer_events(spark, sf_dir), AS_OF_MS)
    return rows.select(*_customer_columns("_source_ts_ms", "_source_offset"))


# --- Gold --------------------------------------------------------------------------------------


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.account_windows(_current(spark, sf_dir, *metrics.INPUTS))


def _window_rows(rows: DataFrame) -> DataFrame:
    hidden = ("_gold_processed_at", "alert_timestamp")
    return rows.select(
        *[
            _micros(c)
            if c in ("window_start", "window_end")
            else _joined(c)
            if c == "risk_factors"
            else c
            for c in rows.columns
            if c not in hidden
        ]
    )


def gold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_rows(metrics.metrics_table(_windows(spark, sf_dir)))


def gold_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_rows(metrics.score(_windows(spark, sf_dir)))


def gold_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_rows(metrics.classify(metrics.score(_windows(spark, sf_dir))))


def gold_risk_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many windows each single risk factor marks."""
    rows = metrics.classify(metrics.score(_windows(spark, sf_dir)))
    return (
        rows.select(F.explode("risk_factors").alias("risk_factor"), "total_amount")
        .groupBy("risk_factor")
        .agg(F.count(F.lit(1)).alias("n_windows"), F.max("total_amount").alias("max_total"))
    )


def gold_aml_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_rows(metrics.alerts(_windows(spark, sf_dir)))


# --- Quality -----------------------------------------------------------------------------------


def _checked_rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Event rows with codes normalized and nothing filtered."""
    return quality.checked_rows(Workspace.of(spark, sf_dir).bronze(name), name)


def _rule_report(rules):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _union(
            quality.violations(_checked_rows(spark, sf_dir, name), name, rules(name))
            for name in ENTITIES
            if rules(name)
        )

    return query


dq_domain = _rule_report(quality.domain_rules)
dq_range = _rule_report(quality.range_rules)
dq_not_null = _rule_report(quality.not_null_rules)


def _violation_rows(rows: DataFrame) -> DataFrame:
    return rows.withColumn("broken", _joined("broken"))


def dq_violation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event that breaks a rule, with the rules it breaks."""
    space = Workspace.of(spark, sf_dir)
    return _union(
        _violation_rows(quality.row_violations(space.bronze(name), name)) for name in ENTITIES
    )


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys inserted more than once, and mail addresses shared by current customers."""
    space = Workspace.of(spark, sf_dir)

    def rows(name: str, column: str) -> DataFrame:
        if column == "email":
            rows = customers.clean_customers(space.bronze(name))
            return customers.as_of(rows, columns=(customers.KEY, column))
        return space.bronze(name).where(F.col("cdc_operation").isin("c", "r"))

    return _union(
        quality.duplicates(rows(name, column), column).select(
            F.lit(name).alias("entity"), F.lit(column).alias("column_name"), "key_value", "n_rows"
        )
        for name, columns in quality.UNIQUE.items()
        for column in columns
    )


def _current_keys(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "customers":
        return customers.as_of(_customer_events(spark, sf_dir), columns=(customers.KEY,))
    if name == "accounts":
        return accounts.current_accounts(Workspace.of(spark, sf_dir).bronze("accounts"))
    return _current(spark, sf_dir, "account_id")


def dq_fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _union(
        quality.orphan_keys(
            _current_keys(spark, sf_dir, child),
            fk,
            _current_keys(spark, sf_dir, parent),
            ENTITIES[parent].key,
        ).select(
            F.lit(child).alias("entity"), F.lit(fk).alias("column_name"), "key_value", "n_rows"
        )
        for child, (fk, parent) in quality.FOREIGN_KEYS.items()
    )


def dq_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts and transactions that go with the deleted customers."""
    last = customers.latest_events(
        _customer_events(spark, sf_dir), (customers.KEY, "cdc_operation")
    )
    gone = last.where(F.col("cdc_operation") == "d")
    return quality.cascade(
        gone, _current_keys(spark, sf_dir, "accounts"), _current_keys(spark, sf_dir, "transactions")
    )


def dq_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Workspace.of(spark, sf_dir).bronze("accounts")
    filled = quality.fill_defaults(rows, "accounts", F.timestamp_millis("cdc_timestamp_ms"))
    return filled.select(
        "account_id",
        "cdc_operation",
        "balance",
        "status",
        _micros("opened_date"),
        _micros("created_at"),
        _micros("updated_at"),
    )


def dq_defaults_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Workspace.of(spark, sf_dir).bronze("customers")
    filled = quality.fill_defaults(rows, "customers", F.timestamp_millis("cdc_timestamp_ms"))
    times = ("onboarding_date", "created_at", "updated_at")
    return filled.select("customer_id", "cdc_operation", "_feed_offset", *[_micros(c) for c in times])


def dq_defaults_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Workspace.of(spark, sf_dir).bronze("transactions")
    filled = quality.fill_defaults(rows, "transactions", F.timestamp_millis("cdc_timestamp_ms"))
    return filled.select(
        "transaction_id",
        "cdc_operation",
        "_feed_offset",
        "is_international",
        "status",
        _micros("transaction_timestamp"),
        _micros("created_at"),
    )


# --- Pipeline checks ---------------------------------------------------------------------------


def check_min_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.min_records(
        {
            "bronze_transactions": Workspace.of(spark, sf_dir).bronze("transactions"),
            "silver_transactions": transactions.inserted_keys(_events(spark, sf_dir)),
            "silver_customers": customers.close_intervals(_customer_events(spark, sf_dir)),
            "gold_aml_alerts": metrics.alerts(_windows(spark, sf_dir)),
        }
    )


def check_stored_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of the tables as the streams have stored them."""
    space = Workspace.of(spark, sf_dir)
    space.catch_up_silver("transactions", "customers")
    return checks.min_records(
        {
            "bronze_transactions": _without_heartbeat(space.stream_bronze("transactions")),
            "silver_transactions": _without_heartbeat(space.stream_transactions()),
            "silver_customers": space.stream_customers(),
            "gold_aml_alerts": space.stream_alerts(),
        }
    )


def batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the batches of each Bronze query have read in all, and the rows they observed. (In the
    Silver jobs Spark counts the rows of a batch as often as the batch is evaluated.)"""
    log = Workspace.of(spark, sf_dir).batch_log().where(~F.startswith("query", F.lit("silver-")))
    observed = F.aggregate(F.map_values("observed"), F.lit(0).cast("long"), lambda a, n: a + n)
    return log.groupBy("query").agg(
        F.sum("input_rows").alias("input_rows"), F.sum(observed).alias("observed_rows")
    )


def feed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace.of(spark, sf_dir)
    return _union(feed.feed_counts(space.feed(name)) for name in ENTITIES)


# --- Streams -----------------------------------------------------------------------------------


def _without_heartbeat(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("account_id").eqNullSafe(derived.HEARTBEAT_ACCOUNT))


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Workspace.of(spark, sf_dir).stream_bronze("transactions")
    return _bronze_rows(_without_heartbeat(rows), "transactions")


def stream_bronze_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Workspace.of(spark, sf_dir).stream_bronze("accounts")
    return _bronze_rows(rows, "accounts")


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace.of(spark, sf_dir)
    return _union(_rejected(space.stream_quarantine(e)) for e in ENTITIES)


def stream_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Workspace.of(spark, sf_dir).stream_envelopes()
    return _bronze_rows(_without_heartbeat(rows), "transactions")


def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Workspace.of(spark, sf_dir).stream_transactions()
    return _current_rows(_without_heartbeat(rows))


def stream_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _version_rows(Workspace.of(spark, sf_dir).stream_customers())


def stream_customers_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored history asked for an instant: a filter on its intervals."""
    versions = Workspace.of(spark, sf_dir).stream_customers()
    rows = customers.valid_at(versions, F.timestamp_millis(F.lit(AS_OF_MS)))
    return rows.select(*_customer_columns("_source_ts_ms", "_source_offset"))


def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_rows(Workspace.of(spark, sf_dir).stream_metrics())


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_rows(Workspace.of(spark, sf_dir).stream_alerts())


def stream_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace.of(spark, sf_dir)
    space.catch_up_violations(*ENTITIES)
    return _union(
        _violation_rows(
            space.stream_violations(name).where(
                ~F.col("key_value").eqNullSafe(derived.HEARTBEAT_ID)
            )
        )
        for name in ENTITIES
    )


def stream_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Workspace.of(spark, sf_dir).stream_duplicates()
    return _without_heartbeat(rows).withColumn("amount", F.col("amount").cast("double"))


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions that came after their window was closed, in a feed with delayed messages."""
    rows = Workspace.of(spark, sf_dir).late_inserts(SNAPSHOT_MS)
    return rows.select(
        "transaction_id", "account_id", _double("amount"), _micros("transaction_timestamp")
    )


def silver_as_of_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table as it stood after its first batch, a later one having been merged since."""
    space = Workspace.of(spark, sf_dir)
    return _current_rows(silver.read_transactions(spark, space.versions(SNAPSHOT_MS), before=1))


def silver_version_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the batches since then have changed, from the keys they touched."""
    space = Workspace.of(spark, sf_dir)
    diff = silver.changes_between(
        spark, space.versions(SNAPSHOT_MS), 1, None, ("amount", "status")
    )
    return _diff_rows(diff)


# --- Further screening -------------------------------------------------------------------------


def _live(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return metrics.countable(_current(spark, sf_dir, "account_id", "status", *columns))


def ext_merchant_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transactions.live(
        _current(
            spark, sf_dir, "account_id", "amount", "merchant_category", "transaction_timestamp"
        )
    )
    return screening.merchant_flags(rows).select(
        "account_id", _micros("window_start"), "n_flagged", "flagged_amount"
    )


def ext_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _live(spark, sf_dir, "country", "transaction_timestamp")
    return screening.country_spread(rows).select(
        "account_id", _micros("window_start"), "n_countries", "n_transactions"
    )


def ext_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    inserts = _events(spark, sf_dir).where(F.col("cdc_operation").isin("c", "r"))
    rows = screening.repeated_payments(inserts)
    return rows.withColumn("amount", F.col("amount").cast("double"))


def ext_unusual_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _live(spark, sf_dir, "amount", "transaction_timestamp")
    return screening.unusual_spend(rows).withColumn("amount", F.col("amount").cast("double"))


def ext_cross_border(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _live(spark, sf_dir, "is_international", "transaction_timestamp")
    return screening.cross_border(rows).select(
        "account_id",
        _micros("window_start"),
        "n_transactions",
        "n_international",
        "international_share",
    )


def ext_customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _live(spark, sf_dir, "amount", "transaction_timestamp")
    out = screening.customer_activity(
        rows,
        _current_keys(spark, sf_dir, "accounts"),
        customers.as_of(
            _customer_events(spark, sf_dir),
            columns=(customers.KEY, "customer_segment", "kyc_status"),
        ),
    )
    return out.select(
        "customer_id",
        "customer_segment",
        "kyc_status",
        "n_accounts",
        "n_transactions",
        "total_amount",
        _micros("first_transaction"),
        _micros("last_transaction"),
    )


def ext_risk_recalc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return screening.recalculated_risk(
        _current(spark, sf_dir, *metrics.INPUTS), _current_keys(spark, sf_dir, "accounts")
    )


AUDITED = ("amount", "currency", "status")


def ext_audit_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Workspace.of(spark, sf_dir).bronze("transactions")
    return screening.change_audit(rows, TRANSACTIONS.key, AUDITED).select(
        "transaction_id",
        "cdc_operation",
        "cdc_timestamp_ms",
        "_feed_offset",
        F.col("before.amount").alias("amount_before"),
        F.col("after.amount").alias("amount_after"),
        F.col("before.status").alias("status_before"),
        F.col("after.status").alias("status_after"),
        _joined("changed_columns"),
    )
