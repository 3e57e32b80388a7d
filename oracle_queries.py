"""The registered queries restated in SQL over the source tables.

Nothing here knows of messages or JSON: the SQL goes from the source tables straight to the
expected result, so it checks parsing, merging and aggregation independently.
"""

from __future__ import annotations

T0 = 1704067200000000
ONBOARDED = 788832000000000
CLOSED_MS = 1009843200000
AS_OF_MS = 883612800000
SNAPSHOT_MS = 1704076200000
HOUR_US = 3600000000

# --- events a capture of the three tables would send ------------------------------------------

TX = f"""
tx_base AS (
  SELECT event_id,
    'TXN' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS transaction_id,
    'ACC' || lpad(CAST(user_id AS VARCHAR), 10, '0') AS account_id,
    CASE WHEN event_id % 97 = 0 THEN 'FEE' WHEN event_id % 2 = 0 THEN ' debit '
         ELSE 'CREDIT' END AS transaction_type,
    CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 103 = 0 THEN CAST(-1.0 AS DOUBLE)
         ELSE CAST(CAST(round(value * 100) AS BIGINT) * 200 + event_id % 100 AS DOUBLE)
              / CAST(100 AS DOUBLE) END AS amount0,
    CASE event_id % 4 WHEN 0 THEN 'aed' WHEN 1 THEN 'USD ' WHEN 2 THEN 'EUR'
         ELSE 'GBP' END AS currency,
    ' Merchant ' || regexp_extract(props, '"k": *([0-9]+)', 1) || ' ' AS merchant_name,
    CASE event_type WHEN 'click' THEN 'crypto' WHEN 'view' THEN 'GROCERIES'
         WHEN 'purchase' THEN 'Shopping' WHEN 'signup' THEN 'TRAVEL'
         ELSE 'GAMBLING' END AS merchant_category,
    {T0} + (epoch_us(ts) - {T0}) // 144 AS tx_us,
    CASE event_id % 5 WHEN 0 THEN 'ae' WHEN 1 THEN 'US' WHEN 2 THEN 'GB' WHEN 3 THEN 'SA'
         ELSE 'IN' END AS country,
    event_id % 3 = 0 AS is_international,
    CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed ' END AS status0
  FROM events
),
tx_sent AS (
  SELECT b.*, m.n,
    CASE WHEN m.n <= 1 THEN CASE WHEN event_id % 50 = 1 THEN 'r' ELSE 'c' END
         WHEN m.n = 2 THEN 'u' WHEN m.n = 3 THEN 'd' END AS op,
    CASE WHEN m.n = 2 THEN amount0 + 1 ELSE amount0 END AS amount,
    CASE WHEN m.n = 2 AND event_id % 20 = 3 THEN 'reversed' ELSE status0 END AS status,
    tx_us // 1000
      + CASE WHEN m.n <= 1 THEN 0 WHEN m.n = 2 THEN 60000 ELSE 120000 END AS ts_ms,
    event_id * 10 + m.n AS pos
  FROM tx_base b JOIN (VALUES (0), (1), (2), (3), (4), (5)) m(n)
    ON m.n = 0 OR (m.n = 1 AND event_id % 25 = 11) OR (m.n = 2 AND event_id % 10 = 3)
    OR (m.n IN (3, 4) AND event_id % 40 = 7) OR (m.n = 5 AND event_id % 500 = 499)
),
tx AS (SELECT * FROM tx_sent WHERE n <= 3)"""

TX_BRONZE = """
SELECT transaction_id, account_id, transaction_type, amount, currency, merchant_name,
  merchant_category, tx_us AS transaction_timestamp_us, country, is_international, status,
  tx_us AS created_at_us, op AS cdc_operation, ts_ms AS cdc_timestamp_ms,
  'transactions' AS source_table, 'banking_core' AS source_database,
  'transactions' AS _entity_type, 'CONFIDENTIAL' AS _data_classification,
  'UAE' AS _data_residency, CAST(event_id % 3 AS INTEGER) AS _feed_partition,
  pos AS _feed_offset
FROM tx"""

REJECTED = """
SELECT 'cdc.public.transactions' AS topic, CAST(event_id % 3 AS INTEGER) AS feed_partition,
  pos AS feed_offset, transaction_id AS message_key,
  CASE WHEN n = 5 THEN '{bad' END AS message,
  CASE WHEN n = 5 THEN 'MALFORMED' ELSE 'TOMBSTONE' END AS reason
FROM tx_sent WHERE n >= 4"""

TX_CLEAN = f"""{TX},
tx_clean AS (
  SELECT transaction_id, account_id, upper(trim(transaction_type)) AS transaction_type,
    CAST(amount AS DECIMAL(18, 2)) AS amount, upper(trim(currency)) AS currency,
    trim(merchant_name) AS merchant_name, upper(trim(merchant_category)) AS merchant_category,
    tx_us, upper(trim(country)) AS country, is_international, upper(trim(status)) AS status,
    op, ts_ms, pos
  FROM tx
  WHERE amount IS NOT NULL AND amount >= 0
    AND upper(trim(transaction_type)) IN ('DEBIT', 'CREDIT')
)"""


def tx_state(name: str, source: str = "tx_clean", inserts: str = "'c', 'r'") -> str:
    """Last of {first insert, changes after it} per key."""
    return f"""
{name}_first AS (
  SELECT * FROM {source} WHERE op IN ({inserts})
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY ts_ms, pos) = 1
),
{name} AS (
  SELECT e.*, f.ts_ms AS first_ms, e.op = 'd' AS is_deleted
  FROM {source} e JOIN {name}_first f USING (transaction_id)
  WHERE (e.ts_ms = f.ts_ms AND e.pos = f.pos)
     OR (e.op IN ('u', 'd') AND (e.ts_ms, e.pos) > (f.ts_ms, f.pos))
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY e.ts_ms DESC, e.pos DESC) = 1
)"""


TX_CURRENT = f"{TX_CLEAN},{tx_state('cur')}"

CURRENT_ROWS = """
SELECT transaction_id, account_id, transaction_type, CAST(amount AS DOUBLE) AS amount, currency,
  merchant_name, merchant_category, tx_us AS transaction_timestamp_us, country,
  is_international, status, first_ms AS _created_at_ms, ts_ms AS _updated_at_ms,
  is_deleted AS _is_deleted, ts_ms AS _source_ts_ms, pos AS _source_offset
FROM cur"""

CU = f"""
cu_base AS (
  SELECT c_custkey AS k, 'CUST' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS customer_id,
    ' First' || c_custkey || ' ' AS first_name, 'Last' || c_custkey AS last_name,
    CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 41 = 0 THEN 'dup@example.org'
         ELSE 'c' || c_custkey || '@example.org ' END AS email,
    ' +971' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS phone,
    CAST(c_custkey % 20000 AS INTEGER) AS dob,
    CASE c_custkey % 4 WHEN 0 THEN ' ae' WHEN 1 THEN 'IN' WHEN 2 THEN 'PK'
         ELSE 'US' END AS nationality,
    CASE WHEN c_custkey % 67 = 0 THEN 'VIP'
         ELSE CASE c_custkey % 3 WHEN 0 THEN 'retail' WHEN 1 THEN 'corporate'
              ELSE 'private_banking' END END AS customer_segment,
    CAST(CASE WHEN c_custkey % 59 = 0 THEN 0 ELSE 1 + c_custkey % 100 END AS INTEGER) AS own_risk
  FROM customer
),
cu AS (
  SELECT b.*, 'r' AS op, {ONBOARDED // 1000} AS ts_ms, k AS pos, own_risk AS risk_score,
    'verified' AS kyc_status FROM cu_base b
  UNION ALL
  SELECT b.*, 'u', epoch_ms(o_orderdate), 10000000 + o_orderkey,
    CAST(1 + o_orderkey % 100 AS INTEGER),
    CASE o_orderstatus WHEN 'F' THEN 'VERIFIED' WHEN 'O' THEN 'PENDING' ELSE 'REJECTED' END
  FROM cu_base b JOIN orders ON o_custkey = k
  UNION ALL
  SELECT b.*, 'd', {CLOSED_MS}, 100000000 + k, own_risk, 'verified' FROM cu_base b
  WHERE k % 61 = 5
)"""

CU_BRONZE = f"""
SELECT customer_id, first_name, last_name, email, phone, dob AS date_of_birth_days, nationality,
  risk_score, kyc_status, {ONBOARDED} AS onboarding_date_us, customer_segment,
  'ae' AS country_residence, {ONBOARDED} AS created_at_us, {ONBOARDED} AS updated_at_us,
  op AS cdc_operation, ts_ms AS cdc_timestamp_ms, 'customers' AS source_table,
  'banking_core' AS source_database, 'customers' AS _entity_type,
  'CONFIDENTIAL' AS _data_classification, 'UAE' AS _data_residency,
  CAST(k % 3 AS INTEGER) AS _feed_partition, pos AS _feed_offset
FROM cu"""

CU_CLEAN = f"""{CU},
cu_clean AS (
  SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
    trim(email) AS email, trim(phone) AS phone, dob AS date_of_birth_days,
    upper(trim(nationality)) AS nationality, risk_score, upper(kyc_status) AS kyc_status,
    {ONBOARDED} AS onboarding_date_us, upper(customer_segment) AS customer_segment,
    'AE' AS country_residence, op AS cdc_operation, ts_ms, pos
  FROM cu WHERE email IS NOT NULL
)"""

CU_COLUMNS = """customer_id, first_name, last_name, email, phone, date_of_birth_days,
  nationality, risk_score, kyc_status, onboarding_date_us, customer_segment, country_residence,
  cdc_operation"""


def cu_versions(source: str) -> str:
    return f"""
SELECT {CU_COLUMNS}, ts_ms AS effective_from_ms, next_ms AS effective_to_ms,
  next_ms IS NULL AS is_current, pos AS _source_offset
FROM (SELECT *, lead(ts_ms) OVER (PARTITION BY customer_id ORDER BY ts_ms, pos) AS next_ms
      FROM {source})
WHERE cdc_operation <> 'd'"""


CU_LAST = """
cu_last AS (
  SELECT * FROM cu_clean
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY ts_ms DESC, pos DESC) = 1
)"""

AC = f"""
ac_base AS (
  SELECT c_custkey AS k, 'ACC' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS account_id,
    CASE WHEN c_custkey % 53 = 0 THEN 'CUST9999999999'
         ELSE 'CUST' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') END AS customer_id,
    CASE c_custkey % 4 WHEN 0 THEN 'SAVINGS' WHEN 1 THEN 'checking ' WHEN 2 THEN 'CREDIT_CARD'
         ELSE 'LOAN' END AS account_type,
    CASE c_custkey % 4 WHEN 0 THEN 'AED' WHEN 1 THEN 'USD' WHEN 2 THEN 'EUR'
         ELSE 'GBP' END AS currency,
    CASE WHEN c_custkey % 23 <> 6 THEN c_acctbal END AS balance0,
    CASE WHEN c_custkey % 19 = 4 THEN NULL WHEN c_custkey % 71 = 9 THEN 'dormant'
         ELSE 'active' END AS status
  FROM customer
),
ac AS (
  SELECT *, 'r' AS op, balance0 AS balance, {ONBOARDED // 1000} AS ts_ms, k * 10 AS pos
  FROM ac_base
  UNION ALL
  SELECT *, 'u', balance0 + 100, {ONBOARDED // 1000 + 60000}, k * 10 + 1
  FROM ac_base WHERE k % 5 = 2
)"""

AC_BRONZE = f"""
SELECT account_id, customer_id, account_type, currency, balance, status,
  {ONBOARDED} AS opened_date_us, {ONBOARDED} AS last_activity_date_us,
  {ONBOARDED} AS created_at_us, {ONBOARDED} AS updated_at_us, op AS cdc_operation,
  ts_ms AS cdc_timestamp_ms, 'accounts' AS source_table, 'banking_core' AS source_database,
  'accounts' AS _entity_type, 'CONFIDENTIAL' AS _data_classification, 'UAE' AS _data_residency,
  CAST(k % 3 AS INTEGER) AS _feed_partition, pos AS _feed_offset
FROM ac"""


# --- windows -----------------------------------------------------------------------------------


def windows(source: str, condition: str = "TRUE") -> str:
    return f"""
win AS (
  SELECT account_id, (tx_us // {HOUR_US}) * {HOUR_US} AS window_start_us,
    (tx_us // {HOUR_US}) * {HOUR_US} + {HOUR_US} AS window_end_us,
    CAST(count(*) AS INTEGER) AS transaction_count,
    CAST(sum(amount) AS DOUBLE) AS total_amount,
    CAST(sum(amount) AS DOUBLE) / count(*) AS avg_amount,
    CAST(max(amount) AS DOUBLE) AS max_amount
  FROM {source}
  WHERE status = 'COMPLETED' AND {condition}
  GROUP BY ALL
),
scored AS (
  SELECT *, CAST(least(100, CASE WHEN max_amount > 50000 THEN 40 ELSE 0 END
    + CASE WHEN transaction_count > 10 THEN 30 ELSE 0 END
    + CASE WHEN total_amount > 100000 THEN 25 ELSE 0 END) AS INTEGER) AS risk_score
  FROM win
),
classified AS (
  SELECT *,
    CASE WHEN max_amount > 50000 THEN 'HIGH_VALUE_TRANSACTION'
         WHEN transaction_count > 10 THEN 'VELOCITY_ATTACK'
         WHEN total_amount > 100000 THEN 'CUMULATIVE_THRESHOLD_EXCEEDED'
         ELSE 'SUSPICIOUS_PATTERN' END AS alert_type,
    CASE WHEN risk_score >= 90 THEN 'CRITICAL' WHEN risk_score >= 80 THEN 'HIGH'
         WHEN risk_score >= 70 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
    concat_ws(',', CASE WHEN max_amount > 50000 THEN 'HIGH_VALUE' END,
      CASE WHEN transaction_count > 10 THEN 'HIGH_VELOCITY' END,
      CASE WHEN total_amount > 100000 THEN 'HIGH_CUMULATIVE' END) AS risk_factors
  FROM scored
)"""


CUR_WINDOWS = f"{TX_CURRENT},{windows('cur', 'NOT is_deleted')}"
FIRST_WINDOWS = f"{TX_CURRENT},{windows('cur_first')}"

ALERTS = """
SELECT 'AML-' || account_id || '-' || CAST(window_start_us // 1000000 AS VARCHAR) AS alert_id,
  * FROM classified WHERE risk_score > 70"""


def per_window(measures: str, condition: str, having: str = "TRUE") -> str:
    return f"""
SELECT account_id, (tx_us // {HOUR_US}) * {HOUR_US} AS window_start_us, {measures}
FROM cur WHERE NOT is_deleted AND {condition} GROUP BY 1, 2 HAVING {having}"""


# --- quality -----------------------------------------------------------------------------------


def rule_report(rules: dict[str, dict[str, str]]) -> str:
    """``{entity: {column: condition that breaks the rule}}``"""
    source = {"customers": "cu", "accounts": "ac", "transactions": "tx"}
    return "\nUNION ALL\n".join(
        f"SELECT '{entity}' AS entity, count(*) AS n_rows, '{column}' AS column_name, "
        f"count(*) FILTER (WHERE {broken}) AS n_violations FROM {source[entity]}"
        for entity, columns in rules.items()
        for column, broken in columns.items()
    )


def not_in(expression: str, *values: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"NOT ({expression} IN ({listed}))"


ALL_EVENTS = f"{TX},{CU},{AC}"

DOMAIN_RULES = {
    "customers": {
        "kyc_status": not_in("upper(kyc_status)", "VERIFIED", "PENDING", "REJECTED"),
        "customer_segment": not_in(
            "upper(customer_segment)", "RETAIL", "CORPORATE", "PRIVATE_BANKING"
        ),
    },
    "accounts": {
        "account_type": not_in(
            "upper(trim(account_type))", "SAVINGS", "CHECKING", "CREDIT_CARD", "LOAN"
        ),
        "currency": not_in("currency", "AED", "USD", "EUR", "GBP", "SAR"),
        "status": not_in("upper(status)", "ACTIVE", "INACTIVE", "FROZEN", "CLOSED"),
    },
    "transactions": {
        "transaction_type": not_in("upper(trim(transaction_type))", "DEBIT", "CREDIT"),
        "status": not_in(
            "upper(trim(status))", "COMPLETED", "PENDING", "FAILED", "REVERSED"
        ),
    },
}
RANGE_RULES = {
    "customers": {"risk_score": "NOT (risk_score BETWEEN 1 AND 100)"},
    "transactions": {"amount": "NOT (amount > 0)"},
}
NOT_NULL_RULES = {
    "customers": {c: f"{c} IS NULL" for c in ("first_name", "last_name", "email")},
    "accounts": {"customer_id": "customer_id IS NULL"},
    "transactions": {c: f"{c} IS NULL" for c in ("account_id", "amount")},
}



def row_rules() -> str:
    """Events that break a rule, with a bit and a name per rule in order of kind, then column."""
    keys = {"customers": "customer_id", "accounts": "account_id", "transactions": "transaction_id"}
    parts = {"customers": "k % 3", "accounts": "k % 3", "transactions": "event_id % 3"}
    source = {"customers": "cu", "accounts": "ac", "transactions": "tx"}
    kinds = {"domain": DOMAIN_RULES, "range": RANGE_RULES, "not_null": NOT_NULL_RULES}
    selects = []
    for entity, key in keys.items():
        broken = [
            (f"{kind}:{column}", condition)
            for kind, rules in kinds.items()
            for column, condition in rules.get(entity, {}).items()
        ]
        mask = " + ".join(f"CASE WHEN {c} THEN {1 << k} ELSE 0 END" for k, (_, c) in enumerate(broken))
        names = ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in broken)
        selects.append(
            f"SELECT '{entity}' AS entity, {key} AS key_value, op AS cdc_operation, "
            f"ts_ms AS cdc_timestamp_ms, CAST({parts[entity]} AS INTEGER) AS _feed_partition, "
            f"pos AS _feed_offset, CAST({mask} AS INTEGER) AS mask, "
            f"concat_ws(',', {names}) AS broken FROM {source[entity]}"
        )
    return "SELECT * FROM (" + " UNION ALL ".join(selects) + ") WHERE mask <> 0"


LINKED = f"{TX_CURRENT},{CU_CLEAN},{CU_LAST},{AC}"
LIVE_CUSTOMERS = "(SELECT customer_id FROM cu_last WHERE cdc_operation <> 'd')"
GONE_ACCOUNTS = """(SELECT account_id FROM ac_base WHERE customer_id IN
  (SELECT customer_id FROM cu_last WHERE cdc_operation = 'd'))"""


ORACLES: dict[str, str] = {
    "bronze_transactions": f"WITH {TX} {TX_BRONZE}",
    "bronze_customers": f"WITH {CU} {CU_BRONZE}",
    "bronze_accounts": f"WITH {AC} {AC_BRONZE}",
    "bronze_quarantine": f"WITH {TX} {REJECTED}",
    "bronze_op_counts": f"""WITH {ALL_EVENTS}
SELECT 'transactions' AS entity, op AS cdc_operation, count(*) AS n_events FROM tx GROUP BY op
UNION ALL SELECT 'customers', op, count(*) FROM cu GROUP BY op
UNION ALL SELECT 'accounts', op, count(*) FROM ac GROUP BY op""",
    "envelope_unwrap": f"WITH {TX} {TX_BRONZE}",
    "envelope_mixed": f"WITH {TX} {TX_BRONZE}",
    "envelope_quarantine": f"WITH {TX} {REJECTED}",
    "stream_envelopes": f"WITH {TX} {TX_BRONZE}",
    "initial_snapshot": f"""WITH {TX_CURRENT}
SELECT transaction_id, 'r' AS op, true AS nothing_before,
  CAST(amount AS DOUBLE) AS amount_after, status AS status_after FROM cur WHERE NOT is_deleted""",
    "snapshot_diff": f"""WITH {TX_CLEAN},
early AS (SELECT * FROM tx_clean WHERE ts_ms <= {SNAPSHOT_MS}),
{tx_state('old_rows', 'early')}, {tx_state('new_rows')},
o AS (SELECT * FROM old_rows WHERE NOT is_deleted),
w AS (SELECT * FROM new_rows WHERE NOT is_deleted)
SELECT coalesce(o.transaction_id, w.transaction_id) AS transaction_id,
  CASE WHEN o.transaction_id IS NULL THEN 'c' WHEN w.transaction_id IS NULL THEN 'd'
       ELSE 'u' END AS op,
  CAST(o.amount AS DOUBLE) AS amount_before, o.status AS status_before,
  CAST(w.amount AS DOUBLE) AS amount_after, w.status AS status_after
FROM o FULL JOIN w ON o.transaction_id = w.transaction_id
WHERE o.transaction_id IS NULL OR w.transaction_id IS NULL
  OR o.amount IS DISTINCT FROM w.amount OR o.status IS DISTINCT FROM w.status""",
    "silver_transactions_clean": f"""WITH {TX_CLEAN}
SELECT transaction_id, account_id, transaction_type, CAST(amount AS DOUBLE) AS amount, currency,
  merchant_name, merchant_category, tx_us AS transaction_timestamp_us, country,
  is_international, status, op AS cdc_operation, op = 'd' AS _is_deleted,
  ts_ms AS _source_ts_ms, pos AS _source_offset FROM tx_clean""",
    "silver_transactions_merge": f"WITH {TX_CURRENT} {CURRENT_ROWS}",
    "silver_transactions_live": f"WITH {TX_CURRENT} {CURRENT_ROWS} WHERE NOT is_deleted",
    "silver_transactions_inserts_only": (
        f"""WITH {TX_CLEAN},{tx_state('cur', inserts="'c'")} {CURRENT_ROWS}"""
    ),
    "silver_orphan_changes": f"""WITH {TX_CLEAN}
SELECT transaction_id, account_id, CAST(amount AS DOUBLE) AS amount, op = 'd' AS _is_deleted,
  ts_ms AS _source_ts_ms, pos AS _source_offset
FROM tx_clean
WHERE transaction_id NOT IN (SELECT transaction_id FROM tx_clean WHERE op IN ('c', 'r'))
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY ts_ms DESC, pos DESC) = 1""",
    "silver_customers_clean": f"""WITH {CU_CLEAN}
SELECT {CU_COLUMNS}, ts_ms AS _source_ts_ms, pos AS _source_offset FROM cu_clean""",
    "silver_customers_scd2": f"WITH {CU_CLEAN} {cu_versions('cu_clean')}",
    "silver_customers_scd2_changes": f"""WITH {CU_CLEAN},
seen AS (
  SELECT *, row_number() OVER w AS nth, lag(risk_score) OVER w AS risk0,
    lag(kyc_status) OVER w AS kyc0, lag(cdc_operation = 'd') OVER w AS gone0
  FROM cu_clean WINDOW w AS (PARTITION BY customer_id ORDER BY ts_ms, pos)
),
kept AS (
  SELECT * FROM seen WHERE nth = 1 OR risk_score <> risk0 OR kyc_status <> kyc0
    OR (cdc_operation = 'd') <> gone0
) {cu_versions('kept')}""",
    "silver_customers_current": f"""WITH {CU_CLEAN},{CU_LAST}
SELECT {CU_COLUMNS}, ts_ms AS _source_ts_ms, pos AS _source_offset
FROM cu_last WHERE cdc_operation <> 'd'""",
    "silver_customers_as_of": f"""WITH {CU_CLEAN},
then_last AS (
  SELECT * FROM cu_clean WHERE ts_ms <= {AS_OF_MS}
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY ts_ms DESC, pos DESC) = 1
)
SELECT {CU_COLUMNS}, ts_ms AS _source_ts_ms, pos AS _source_offset
FROM then_last WHERE cdc_operation <> 'd'""",
    "gold_metrics": f"WITH {CUR_WINDOWS} SELECT * FROM win",
    "gold_scored": f"WITH {CUR_WINDOWS} SELECT * FROM scored",
    "gold_classified": f"WITH {CUR_WINDOWS} SELECT * FROM classified",
    "gold_risk_factors": f"""WITH {CUR_WINDOWS}
SELECT 'HIGH_VALUE' AS risk_factor, count(*) AS n_windows, max(total_amount) AS max_total
FROM win WHERE max_amount > 50000 HAVING count(*) > 0
UNION ALL SELECT 'HIGH_VELOCITY', count(*), max(total_amount)
FROM win WHERE transaction_count > 10 HAVING count(*) > 0
UNION ALL SELECT 'HIGH_CUMULATIVE', count(*), max(total_amount)
FROM win WHERE total_amount > 100000 HAVING count(*) > 0""",
    "gold_aml_alerts": f"WITH {CUR_WINDOWS} {ALERTS}",
    "dq_domain": f"WITH {ALL_EVENTS} {rule_report(DOMAIN_RULES)}",
    "dq_range": f"WITH {ALL_EVENTS} {rule_report(RANGE_RULES)}",
    "dq_not_null": f"WITH {ALL_EVENTS} {rule_report(NOT_NULL_RULES)}",
    "dq_violation_rows": f"WITH {ALL_EVENTS} {row_rules()}",
    "stream_violations": f"WITH {ALL_EVENTS} {row_rules()}",
    "dq_unique": f"""WITH {TX},{CU_CLEAN},{CU_LAST},{AC}
SELECT 'transactions' AS entity, 'transaction_id' AS column_name, transaction_id AS key_value,
  count(*) AS n_rows FROM tx WHERE op IN ('c', 'r') GROUP BY transaction_id HAVING count(*) > 1
UNION ALL SELECT 'customers', 'customer_id', customer_id, count(*) FROM cu
  WHERE op IN ('c', 'r') GROUP BY customer_id HAVING count(*) > 1
UNION ALL SELECT 'customers', 'email', email, count(*) FROM cu_last
  WHERE cdc_operation <> 'd' GROUP BY email HAVING count(*) > 1
UNION ALL SELECT 'accounts', 'account_id', account_id, count(*) FROM ac
  WHERE op IN ('c', 'r') GROUP BY account_id HAVING count(*) > 1""",
    "dq_fk_orphans": f"""WITH {LINKED}
SELECT 'accounts' AS entity, 'customer_id' AS column_name, customer_id AS key_value,
  count(*) AS n_rows FROM ac_base WHERE customer_id NOT IN {LIVE_CUSTOMERS} GROUP BY customer_id
UNION ALL SELECT 'transactions', 'account_id', account_id, count(*) FROM cur
  WHERE account_id NOT IN (SELECT account_id FROM ac_base) GROUP BY account_id""",
    "dq_cascade": f"""WITH {LINKED}
SELECT 'accounts' AS entity, account_id AS key_value FROM {GONE_ACCOUNTS}
UNION ALL SELECT 'transactions', transaction_id FROM cur WHERE account_id IN {GONE_ACCOUNTS}""",
    "dq_defaults": f"""WITH {AC}
SELECT account_id, op AS cdc_operation, coalesce(balance, 0) AS balance,
  coalesce(status, 'ACTIVE') AS status, {ONBOARDED} AS opened_date_us,
  {ONBOARDED} AS created_at_us, {ONBOARDED} AS updated_at_us FROM ac""",
    "dq_defaults_customers": f"""WITH {CU}
SELECT customer_id, op AS cdc_operation, pos AS _feed_offset, {ONBOARDED} AS onboarding_date_us,
  {ONBOARDED} AS created_at_us, {ONBOARDED} AS updated_at_us FROM cu""",
    "dq_defaults_transactions": f"""WITH {TX}
SELECT transaction_id, op AS cdc_operation, pos AS _feed_offset,
  coalesce(is_international, false) AS is_international, coalesce(status, 'COMPLETED') AS status,
  tx_us AS transaction_timestamp_us, tx_us AS created_at_us FROM tx""",
    "check_stored_records": f"""WITH {FIRST_WINDOWS},{CU_CLEAN},
counted AS (
  SELECT 'bronze_transactions' AS table_name, count(*) AS n_rows, 1 AS min_records FROM tx
  UNION ALL SELECT 'silver_transactions', count(*), 1 FROM cur
  UNION ALL SELECT 'silver_customers', count(*), 1 FROM cu_clean WHERE cdc_operation <> 'd'
  UNION ALL SELECT 'gold_aml_alerts', count(*), 0 FROM classified WHERE risk_score > 70
)
SELECT table_name, n_rows, CAST(min_records AS BIGINT) AS min_records,
  n_rows >= min_records AS healthy FROM counted""",
    "stream_late_rows": f"""WITH {TX_CLEAN},
sent AS (
  SELECT *, CASE WHEN ts_ms <= {SNAPSHOT_MS} AND (pos // 10) % 70 <> 13 THEN 0 ELSE 1 END AS batch
  FROM tx_clean WHERE op IN ('c', 'r')
), logged AS (
  SELECT * FROM sent
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY batch, ts_ms, pos) = 1
), clock AS (SELECT max(tx_us) - 600000000 AS mark FROM logged WHERE batch = 0)
SELECT transaction_id, account_id, CAST(amount AS DOUBLE) AS amount,
  tx_us AS transaction_timestamp_us
FROM logged, clock WHERE batch = 1 AND (tx_us // {HOUR_US} + 1) * {HOUR_US} <= mark""",
    "silver_as_of_version": f"""WITH {TX_CLEAN},
early AS (SELECT * FROM tx_clean WHERE ts_ms <= {SNAPSHOT_MS}),
{tx_state('cur', 'early')} {CURRENT_ROWS}""",
    "check_min_records": f"""WITH {CUR_WINDOWS},{CU_CLEAN},
counted AS (
  SELECT 'bronze_transactions' AS table_name, count(*) AS n_rows, 1 AS min_records FROM tx
  UNION ALL SELECT 'silver_transactions', count(*), 1 FROM cur
  UNION ALL SELECT 'silver_customers', count(*), 1 FROM cu_clean WHERE cdc_operation <> 'd'
  UNION ALL SELECT 'gold_aml_alerts', count(*), 0 FROM scored WHERE risk_score > 70
)
SELECT table_name, n_rows, CAST(min_records AS BIGINT) AS min_records,
  n_rows >= min_records AS healthy FROM counted""",
    "feed_counts": f"""WITH {ALL_EVENTS},
sent AS (
  SELECT 'cdc.public.transactions' AS topic, event_id % 3 AS p, pos FROM tx_sent
  UNION ALL SELECT 'cdc.public.customers', k % 3, pos FROM cu
  UNION ALL SELECT 'cdc.public.accounts', k % 3, pos FROM ac
),
parts AS (SELECT topic, p, count(*) AS n, max(pos) - min(pos) + 1 AS span FROM sent GROUP BY ALL)
SELECT topic, count(*) AS n_partitions, CAST(sum(n) AS BIGINT) AS n_messages,
  CAST(sum(span) AS BIGINT) AS offset_span FROM parts GROUP BY topic""",
    "stream_bronze": f"WITH {TX} {TX_BRONZE}",
    "stream_bronze_accounts": f"WITH {AC} {AC_BRONZE}",
    "stream_quarantine": f"WITH {TX} {REJECTED}",
    "stream_merge": f"WITH {TX_CURRENT} {CURRENT_ROWS}",
    "stream_scd2": f"WITH {CU_CLEAN} {cu_versions('cu_clean')}",
    "stream_metrics": f"WITH {FIRST_WINDOWS} SELECT * FROM win",
    "stream_alerts": f"WITH {FIRST_WINDOWS} {ALERTS}",
    "ext_merchant_category": f"WITH {TX_CURRENT} "
    + per_window(
        "count(*) AS n_flagged, CAST(sum(amount) AS DOUBLE) AS flagged_amount",
        "merchant_category IN ('CRYPTO', 'GAMBLING')",
    ),
    "ext_geo": f"WITH {TX_CURRENT} "
    + per_window(
        "count(DISTINCT country) AS n_countries, count(*) AS n_transactions",
        "status = 'COMPLETED'",
        "count(DISTINCT country) > 2",
    ),
    "ext_duplicates": f"""WITH {TX_CLEAN},
paired AS (
  SELECT *, lag(transaction_id) OVER w AS earlier_id, tx_us - lag(tx_us) OVER w AS apart
  FROM tx_clean WHERE op IN ('c', 'r') AND account_id IS NOT NULL AND merchant_name IS NOT NULL
  WINDOW w AS (PARTITION BY account_id, amount, merchant_name ORDER BY tx_us, pos)
)
SELECT transaction_id, account_id, CAST(amount AS DOUBLE) AS amount, merchant_name,
  pos AS _source_offset, earlier_id AS earlier_transaction_id, apart AS micros_apart
FROM paired WHERE apart <= 600000000""",
    "ext_unusual_spend": f"""WITH {TX_CURRENT},
running AS (
  SELECT transaction_id, account_id, amount, CAST(amount * 100 AS HUGEINT) AS x,
    count(*) OVER w AS n, sum(CAST(amount * 100 AS HUGEINT)) OVER w AS s,
    sum(CAST(amount * 100 AS HUGEINT) * CAST(amount * 100 AS HUGEINT)) OVER w AS q
  FROM cur WHERE status = 'COMPLETED' AND NOT is_deleted
  WINDOW w AS (PARTITION BY account_id ORDER BY tx_us, transaction_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
d AS (
  SELECT *, CAST(n AS HUGEINT) * x - s AS above, CAST(n AS HUGEINT) * q - s * s AS spread
  FROM running WHERE n >= 5
)
SELECT transaction_id, account_id, CAST(amount AS DOUBLE) AS amount, n AS n_earlier,
  CAST(s AS DOUBLE) / n / 100 AS mean_earlier
FROM d WHERE above > 0 AND above * above > 9 * spread""",
    "ext_cross_border": f"WITH {TX_CURRENT} "
    + per_window(
        "count(*) AS n_transactions, count(*) FILTER (WHERE is_international) AS n_international,"
        " CAST(count(*) FILTER (WHERE is_international) AS DOUBLE) / count(*)"
        " AS international_share",
        "status = 'COMPLETED'",
        "count(*) FILTER (WHERE is_international) > 0",
    ),
    "ext_customer_history": f"""WITH {LINKED}
SELECT c.customer_id, c.customer_segment, c.kyc_status,
  count(DISTINCT a.account_id) AS n_accounts, count(*) AS n_transactions,
  CAST(sum(t.amount) AS DOUBLE) AS total_amount, min(t.tx_us) AS first_transaction_us,
  max(t.tx_us) AS last_transaction_us
FROM cur t JOIN ac_base a USING (account_id) JOIN cu_last c ON c.customer_id = a.customer_id
WHERE t.status = 'COMPLETED' AND NOT t.is_deleted AND c.cdc_operation <> 'd'
GROUP BY 1, 2, 3""",
    "ext_risk_recalc": f"""WITH {CUR_WINDOWS},{AC}
SELECT a.customer_id, max(risk_score) AS max_score,
  CAST(sum(risk_score) AS DOUBLE) / count(*) AS mean_score, count(*) AS n_windows
FROM scored JOIN ac_base a USING (account_id) GROUP BY a.customer_id""",
    "ext_audit_diff": f"""WITH {TX},
paired AS (
  SELECT *, row_number() OVER w AS nth, lag(amount) OVER w AS a0, lag(status) OVER w AS s0
  FROM tx WINDOW w AS (PARTITION BY transaction_id ORDER BY ts_ms, pos)
)
SELECT transaction_id, op AS cdc_operation, ts_ms AS cdc_timestamp_ms, pos AS _feed_offset,
  a0 AS amount_before, amount AS amount_after, s0 AS status_before, status AS status_after,
  concat_ws(',', CASE WHEN amount IS DISTINCT FROM a0 THEN 'amount' END,
    CASE WHEN status IS DISTINCT FROM s0 THEN 'status' END) AS changed_columns
FROM paired WHERE nth > 1""",
}

# The same questions, asked of the stored versions and of a stream.
ORACLES["silver_version_diff"] = ORACLES["snapshot_diff"]
ORACLES["stream_duplicates"] = ORACLES["ext_duplicates"]
ORACLES["stream_customers_as_of"] = ORACLES["silver_customers_as_of"]

# The feed of transactions ends with one message of its own.
ORACLES["batch_log"] = f"""WITH {TX}, {CU}
SELECT 'bronze-transactions' AS query, (SELECT count(*) + 1 FROM tx_sent) AS input_rows,
  (SELECT count(*) + 1 FROM tx) AS observed_rows
UNION ALL SELECT 'rejected-transactions', (SELECT count(*) + 1 FROM tx_sent), 0
UNION ALL SELECT 'bronze-customers', (SELECT count(*) FROM cu), (SELECT count(*) FROM cu)
UNION ALL SELECT 'rejected-customers', (SELECT count(*) FROM cu), 0"""
