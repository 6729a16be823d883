"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each statement reads the driver views (customer, orders, lineitem) and
re-derives Bronze, Silver and Gold in plain SQL, written independently of
the Spark plans: dedupe uses ``row_number()``, reject counts are
differences of stage counts, gold tables use the straightforward joins with
``COUNT(DISTINCT ...)``, rates and averages are DuckDB's own ``ROUND`` of a double
division. Amounts of two decimals are summed as DECIMAL(18,2), so that the order of
the rows plays no part; the ``fine_amounts`` queries use plain SUM and AVG of the doubles.
"""

from __future__ import annotations

from ledgerlake.constants import WHITESPACE
from ledgerlake import registry as R

_WS = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)


def _norm(x: str) -> str:
    return f"trim(lower({x}), {_WS})"


def _rate(num: str, den: str, factor: int = 100, digits: int = 2) -> str:
    return f"ROUND({float(factor)}::DOUBLE * ({num}) / NULLIF({den}, 0), {digits})"


def _half_even(num: str, den: str, factor: int = 100, digits: int = 1) -> str:
    scale = 10 ** digits
    scaled = f"(({num}) * {factor * scale})"
    k0 = f"({scaled} // NULLIF({den}, 0))"
    r2 = f"(({scaled} - {k0} * ({den})) * 2)"
    bump = f"(CASE WHEN {r2} > ({den}) THEN 1 WHEN {r2} = ({den}) AND {k0} % 2 = 1 THEN 1 ELSE 0 END)"
    return f"(CAST({k0} + {bump} AS DOUBLE) / {float(scale)})"


def _money_sum(x: str) -> str:
    return f"SUM(CAST({x} AS DECIMAL(18,2)))"


def _avg_money(x: str) -> str:
    return f"(CAST({_money_sum(x)} AS DOUBLE) / NULLIF(COUNT({x}), 0))"


_STAMP = R.PROCESSED_AT

def _prelude(tx_lines: str = "true", detail_lines: str = "true", amount: str = "amount") -> str:
    """Bronze, Silver and their steps; only the Bronze rows that satisfy the given conditions arrive."""
    return f"""
WITH
b_users AS (
  SELECT 'U' || CAST(c_custkey AS VARCHAR) AS user_id,
         CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE c_name END AS name,
         CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE ' ' || c_name || '@' || c_mktsegment || '.CO ' END AS email,
         '2024-01-' || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') || 'T00:00:00' AS created_at,
         CAST(s.seq AS BIGINT) AS _seq
  FROM customer, (SELECT 0 AS seq UNION ALL SELECT 1) s
  WHERE s.seq = 0 OR c_custkey % 29 = 0
),
b_tx AS (
  SELECT * REPLACE ({amount} AS amount) FROM (
  SELECT 'T' || CAST(o_orderkey AS VARCHAR) AS transaction_id,
         'U' || CAST(o_custkey AS VARCHAR) AS user_id,
         CASE WHEN o_orderkey % 83 = 0 THEN NULL
              WHEN s.seq = 2 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE)
              ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) - 20000 AS DOUBLE) END AS amount,
         CASE WHEN o_orderkey % 101 = 0 THEN NULL
              WHEN o_orderkey % 30 = 5 OR o_custkey % 61 = 0 THEN 'pending'
              WHEN o_orderkey % 6 IN (0, 5) THEN 'success'
              WHEN o_orderkey % 6 = 1 THEN 'failed'
              WHEN o_orderkey % 6 = 2 THEN 'SUCCESS'
              WHEN o_orderkey % 6 = 3 THEN chr(9) || 'Failed' || chr(160) || chr(10)
              ELSE 'FAILED' END AS status,
         replace(CAST(o_orderdate AS VARCHAR), ' ', 'T') AS created_at,
         CAST(s.seq AS BIGINT) AS _seq
  FROM orders, (SELECT 0 AS seq UNION ALL SELECT 1 UNION ALL SELECT 2) s
  WHERE s.seq = 0 OR (s.seq = 1 AND o_orderkey % 50 = 0) OR (s.seq = 2 AND o_orderkey % 53 = 0)
  ) WHERE {tx_lines}
),
b_details AS (
  SELECT * FROM (
  SELECT 'D' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS detail_id,
         'T' || CAST(l_orderkey AS VARCHAR) AS transaction_id,
         CASE WHEN l_partkey % 89 = 0 THEN NULL
              WHEN l_suppkey % 6 = 0 THEN 'card'
              WHEN l_suppkey % 6 = 1 THEN 'PSE'
              WHEN l_suppkey % 6 = 2 THEN chr(9) || chr(8195) || 'cash'
              WHEN l_suppkey % 6 = 3 THEN 'Nequi'
              WHEN l_suppkey % 6 = 4 THEN 'daviplata'
              ELSE 'crypto' END AS payment_method,
         CASE WHEN l_partkey % 97 = 0 THEN NULL
              WHEN l_partkey % 59 = 0 THEN 'pos'
              WHEN l_returnflag = 'A' THEN 'Web'
              WHEN l_returnflag = 'N' THEN ' mobile '
              ELSE 'api' END AS channel,
         CAST(l_quantity * 60 AS BIGINT) - 100 AS processing_time_ms,
         l_partkey * 100000 + l_suppkey AS _seq
  FROM lineitem
  ) WHERE {detail_lines}
),
d_users AS (
  SELECT user_id, name, email, created_at, _seq FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY _seq NULLS FIRST, name NULLS FIRST,
                                 email NULLS FIRST, created_at NULLS FIRST) AS rn
    FROM b_users) WHERE rn = 1
),
v_users AS (
  SELECT * FROM d_users WHERE user_id IS NOT NULL AND name IS NOT NULL AND email IS NOT NULL
),
s_users AS (
  SELECT user_id, name, {_norm('email')} AS email, created_at,
         '{_STAMP}' AS _silver_processed_at, 'bronze' AS _source
  FROM v_users
),
d_tx AS (
  SELECT transaction_id, user_id, amount, status, created_at, _seq FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY _seq NULLS FIRST, user_id NULLS FIRST,
                                 amount NULLS FIRST, status NULLS FIRST, created_at NULLS FIRST) AS rn
    FROM b_tx) WHERE rn = 1
),
p_tx AS (SELECT * FROM d_tx WHERE amount > 0 AND NOT isnan(amount)),
c_tx AS (
  SELECT transaction_id, user_id, amount, {_norm('status')} AS status, created_at, _seq
  FROM p_tx WHERE {_norm('status')} IN ('success', 'failed')
),
s_tx AS (
  SELECT transaction_id, user_id, amount, status, CAST(created_at AS TIMESTAMP) AS created_at,
         '{_STAMP}' AS _silver_processed_at, 'bronze' AS _source
  FROM c_tx WHERE user_id IN (SELECT user_id FROM s_users)
),
d_details AS (
  SELECT detail_id, transaction_id, payment_method, channel, processing_time_ms, _seq FROM (
    SELECT *, row_number() OVER (PARTITION BY detail_id ORDER BY _seq NULLS FIRST,
                                 processing_time_ms NULLS FIRST, channel NULLS FIRST,
                                 payment_method NULLS FIRST, transaction_id NULLS FIRST) AS rn
    FROM b_details) WHERE rn = 1
),
t_details AS (SELECT * FROM d_details WHERE transaction_id IN (SELECT transaction_id FROM s_tx)),
m_details AS (
  SELECT detail_id, transaction_id, {_norm('payment_method')} AS payment_method, channel,
         processing_time_ms, _seq
  FROM t_details WHERE {_norm('payment_method')} IN ('card', 'pse', 'cash', 'nequi', 'daviplata')
),
c_details AS (
  SELECT detail_id, transaction_id, payment_method, {_norm('channel')} AS channel, processing_time_ms, _seq
  FROM m_details WHERE {_norm('channel')} IN ('web', 'mobile', 'api')
),
v_details AS (SELECT * FROM c_details WHERE processing_time_ms > 0),
s_details AS (
  SELECT detail_id, transaction_id, payment_method, channel, processing_time_ms,
         '{_STAMP}' AS _silver_processed_at, 'bronze' AS _source
  FROM v_details
),
r_tx AS (
  SELECT transaction_id, user_id, amount, status, CAST(created_at AS TIMESTAMP) AS created_at FROM b_tx
)
"""


PRELUDE = _prelude()


def _q(body: str) -> str:
    return PRELUDE + body


# --------------------------------------------------------------------------- gold

GOLD_USER_METRICS = f"""
SELECT u.user_id, u.name, u.email,
       COUNT(t.transaction_id) AS total_transactions,
       CAST({_money_sum('t.amount')} AS DOUBLE) AS total_amount,
       {_avg_money('t.amount')} AS avg_amount,
       MAX(t.amount) AS max_amount,
       MIN(t.amount) AS min_amount,
       COUNT(CASE WHEN t.status = 'success' THEN 1 END) AS successful_transactions,
       COUNT(CASE WHEN t.status = 'failed' THEN 1 END) AS failed_transactions,
       {_rate("COUNT(CASE WHEN t.status = 'success' THEN 1 END)", "COUNT(t.transaction_id)")} AS success_rate_pct,
       MIN(t.created_at) AS first_transaction_at,
       MAX(t.created_at) AS last_transaction_at
FROM s_users u LEFT JOIN s_tx t ON u.user_id = t.user_id
GROUP BY u.user_id, u.name, u.email
ORDER BY total_amount DESC NULLS LAST
"""


def _dimension(dim: str, cols: list[str], order: str) -> str:
    exprs = {
        "total_transactions": "COUNT(DISTINCT t.transaction_id)",
        "total_amount": f"CAST({_money_sum('t.amount')} AS DOUBLE)",
        "avg_amount": _avg_money("t.amount"),
        "avg_processing_time_ms": _rate("SUM(td.processing_time_ms)", "COUNT(td.processing_time_ms)", 1),
        "successful": "COUNT(CASE WHEN t.status = 'success' THEN 1 END)",
        "failed": "COUNT(CASE WHEN t.status = 'failed' THEN 1 END)",
        "success_rate_pct": _rate("COUNT(CASE WHEN t.status = 'success' THEN 1 END)",
                                  "COUNT(DISTINCT t.transaction_id)"),
    }
    select = ",\n       ".join(f"{exprs[c]} AS {c}" for c in cols)
    return f"""
SELECT td.{dim},
       {select}
FROM s_tx t JOIN s_details td ON t.transaction_id = td.transaction_id
GROUP BY td.{dim}
ORDER BY {order} DESC
"""


GOLD_CHANNEL = _dimension(
    "channel",
    ["total_transactions", "total_amount", "avg_amount", "avg_processing_time_ms", "successful", "failed",
     "success_rate_pct"],
    "total_amount")
GOLD_PAYMENT = _dimension(
    "payment_method",
    ["total_transactions", "total_amount", "avg_amount", "avg_processing_time_ms", "success_rate_pct"],
    "total_transactions")

GOLD_SUMMARY = f"""
SELECT COUNT(DISTINCT t.transaction_id) AS total_transactions,
       COUNT(DISTINCT t.user_id) AS active_users,
       CAST({_money_sum('t.amount')} AS DOUBLE) AS total_volume,
       {_avg_money('t.amount')} AS avg_transaction_amount,
       {_rate("COUNT(CASE WHEN t.status = 'success' THEN 1 END)", "COUNT(t.transaction_id)")}
           AS overall_success_rate_pct,
       {_rate("SUM(td.processing_time_ms)", "COUNT(td.processing_time_ms)", 1)} AS avg_processing_time_ms,
       MIN(t.created_at) AS pipeline_start,
       MAX(t.created_at) AS pipeline_end
FROM s_tx t LEFT JOIN s_details td ON t.transaction_id = td.transaction_id
"""

CHANNEL_PER_TX = f"""
, pairs AS (SELECT DISTINCT transaction_id, channel FROM s_details),
ms AS (
  SELECT channel, SUM(processing_time_ms) AS ms_sum, COUNT(processing_time_ms) AS ms_n
  FROM s_details WHERE transaction_id IN (SELECT transaction_id FROM s_tx) GROUP BY channel
)
SELECT p.channel,
       COUNT(t.transaction_id) AS total_transactions,
       CAST({_money_sum('t.amount')} AS DOUBLE) AS total_amount,
       {_avg_money('t.amount')} AS avg_amount,
       {_rate('ms.ms_sum', 'ms.ms_n', 1)} AS avg_processing_time_ms,
       COUNT(CASE WHEN t.status = 'success' THEN 1 END) AS successful,
       COUNT(CASE WHEN t.status = 'failed' THEN 1 END) AS failed,
       {_rate("COUNT(CASE WHEN t.status = 'success' THEN 1 END)", "COUNT(t.transaction_id)")} AS success_rate_pct
FROM s_tx t JOIN pairs p ON t.transaction_id = p.transaction_id JOIN ms ON ms.channel = p.channel
GROUP BY p.channel, ms.ms_sum, ms.ms_n
"""

SUMMARY_PER_TX = f"""
SELECT COUNT(DISTINCT transaction_id) AS total_transactions,
       COUNT(DISTINCT user_id) AS active_users,
       CAST({_money_sum('amount')} AS DOUBLE) AS total_volume,
       {_avg_money('amount')} AS avg_transaction_amount,
       {_rate("COUNT(CASE WHEN status = 'success' THEN 1 END)", "COUNT(transaction_id)")}
           AS overall_success_rate_pct,
       (SELECT {_rate('SUM(processing_time_ms)', 'COUNT(processing_time_ms)', 1)}
          FROM s_details WHERE transaction_id IN (SELECT transaction_id FROM s_tx)) AS avg_processing_time_ms,
       MIN(created_at) AS pipeline_start,
       MAX(created_at) AS pipeline_end
FROM s_tx
"""

SUCCESS_RATE = f"""
SELECT CAST(date_trunc('month', created_at) AS DATE) AS month,
       COUNT(transaction_id) AS total_transactions,
       COUNT(CASE WHEN status = 'success' THEN 1 END) AS successful,
       {_rate("COUNT(CASE WHEN status = 'success' THEN 1 END)", "COUNT(transaction_id)")} AS success_rate_pct
FROM s_tx GROUP BY 1
"""

# --------------------------------------------------------------------------- quality


def _quality_report(users: str, tx: str, details: str, btx: str, bdetails: str) -> str:
    as_of, checked = R.AS_OF, R.CHECKED_AT
    latest_text = ("COALESCE(strftime(tx_latest, '%Y-%m-%d %H:%M:%S') || "
                   "CASE WHEN strftime(tx_latest, '%f') <> '000000' THEN '.' || strftime(tx_latest, '%f') "
                   "ELSE '' END, 'NaT')")

    def row(entity: str, check: str, ok: str, detail: str) -> str:
        return (f"SELECT '{entity}' AS entity, '{check}' AS \"check\", "
                f"CASE WHEN COALESCE({ok}, false) THEN 'PASS' ELSE 'FAIL' END AS status, "
                f"{detail} AS detail, '{checked}' AS checked_at FROM m")

    def txt(x: str) -> str:
        return f"CAST({x} AS VARCHAR)"

    rows = [
        row("users", "record_count", "users_rows > 0", f"{txt('users_rows')} || ' registros en Silver'"),
        row("transactions", "record_count", "tx_rows > 0", f"{txt('tx_rows')} || ' registros en Silver'"),
        row("transaction_details", "record_count", "details_rows > 0",
            f"{txt('details_rows')} || ' registros en Silver'"),
        row("transactions", "bronze_to_silver_traceability", "tx_rows <= tx_bronze_rows",
            f"'Bronze=' || {txt('tx_bronze_rows')} || ' → Silver=' || {txt('tx_rows')} || "
            f"' (se eliminaron ' || {txt('tx_bronze_rows - tx_rows')} || ' invalidos)'"),
        row("transaction_details", "bronze_to_silver_traceability", "details_rows <= details_bronze_rows",
            f"'Bronze=' || {txt('details_bronze_rows')} || ' → Silver=' || {txt('details_rows')}"),
    ]
    for c in ("user_id", "name", "email"):
        rows.append(row("users", f"null_check_{c}", f"users_null_{c} = 0",
                        f"{txt(f'users_null_{c}')} || ' nulls en columna {c}'"))
    for c in ("transaction_id", "user_id", "amount", "status"):
        rows.append(row("transactions", f"null_check_{c}", f"tx_null_{c} = 0",
                        f"{txt(f'tx_null_{c}')} || ' nulls en columna {c}'"))
    rows += [
        row("transactions", "amount_positive", "tx_amount_le0 = 0",
            f"{txt('tx_amount_le0')} || ' transacciones con amount <= 0'"),
        row("transactions", "status_standardized", "tx_bad_status = 0",
            f"{txt('tx_bad_status')} || ' registros con status invalido'"),
        row("transactions", "no_duplicates", "tx_dupes = 0", f"{txt('tx_dupes')} || ' duplicados encontrados'"),
        row("transactions", "referential_integrity_users", "tx_orphans = 0",
            f"{txt('tx_orphans')} || ' transacciones sin usuario valido'"),
        row("transaction_details", "referential_integrity_transactions", "details_orphans = 0",
            f"{txt('details_orphans')} || ' detalles sin transaccion valida'"),
        row("transactions", "freshness", f"tx_latest > TIMESTAMP '{as_of}' - INTERVAL 365 DAY",
            f"'Transaccion mas reciente: ' || {latest_text}"),
    ]
    metrics = f"""
, m AS (
  SELECT
    (SELECT COUNT(*) FROM {users}) AS users_rows,
    (SELECT COUNT(*) FILTER (WHERE user_id IS NULL) FROM {users}) AS users_null_user_id,
    (SELECT COUNT(*) FILTER (WHERE name IS NULL) FROM {users}) AS users_null_name,
    (SELECT COUNT(*) FILTER (WHERE email IS NULL) FROM {users}) AS users_null_email,
    (SELECT COUNT(*) FROM {tx}) AS tx_rows,
    (SELECT COUNT(*) FILTER (WHERE transaction_id IS NULL) FROM {tx}) AS tx_null_transaction_id,
    (SELECT COUNT(*) FILTER (WHERE user_id IS NULL) FROM {tx}) AS tx_null_user_id,
    (SELECT COUNT(*) FILTER (WHERE amount IS NULL OR isnan(amount)) FROM {tx}) AS tx_null_amount,
    (SELECT COUNT(*) FILTER (WHERE status IS NULL) FROM {tx}) AS tx_null_status,
    (SELECT COUNT(*) FILTER (WHERE amount <= 0) FROM {tx}) AS tx_amount_le0,
    (SELECT COUNT(*) FILTER (WHERE status IS NULL OR status NOT IN ('success', 'failed')) FROM {tx})
        AS tx_bad_status,
    (SELECT COUNT(*) - COUNT(DISTINCT transaction_id)
            - COALESCE(MAX(CASE WHEN transaction_id IS NULL THEN 1 ELSE 0 END), 0) FROM {tx}) AS tx_dupes,
    (SELECT COUNT(*) FROM {tx} t WHERE NOT EXISTS (SELECT 1 FROM {users} u WHERE u.user_id = t.user_id))
        AS tx_orphans,
    (SELECT COUNT(*) FROM {details} d
      WHERE NOT EXISTS (SELECT 1 FROM {tx} t WHERE t.transaction_id = d.transaction_id)) AS details_orphans,
    (SELECT MAX(created_at) FROM {tx}) AS tx_latest,
    (SELECT COUNT(*) FROM {details}) AS details_rows,
    (SELECT COUNT(*) FROM {btx}) AS tx_bronze_rows,
    (SELECT COUNT(*) FROM {bdetails}) AS details_bronze_rows
), report AS (
{chr(10).join(' UNION ALL ' + r if i else r for i, r in enumerate(rows))}
)
"""
    return metrics


REPORT_SILVER = _quality_report("s_users", "s_tx", "s_details", "b_tx", "b_details")
REPORT_RAW = _quality_report("b_users", "r_tx", "b_details", "b_tx", "b_details")

QUALITY_SUMMARY = f"""
SELECT COUNT(*) AS total_checks,
       COUNT(*) FILTER (WHERE status = 'PASS') AS passed,
       COUNT(*) FILTER (WHERE status = 'FAIL') AS failed,
       CASE WHEN COUNT(*) > 0
            THEN {_half_even("COUNT(*) FILTER (WHERE status = 'PASS')", "COUNT(*)")}
            ELSE 0.0 END AS pass_rate
FROM report
"""

NULL_CHECKS = """
SELECT 'users' AS entity, 'user_id' AS column_name, COUNT(*) FILTER (WHERE user_id IS NULL) AS nulls FROM b_users
UNION ALL SELECT 'users', 'name', COUNT(*) FILTER (WHERE name IS NULL) FROM b_users
UNION ALL SELECT 'users', 'email', COUNT(*) FILTER (WHERE email IS NULL) FROM b_users
UNION ALL SELECT 'transactions', 'transaction_id', COUNT(*) FILTER (WHERE transaction_id IS NULL) FROM b_tx
UNION ALL SELECT 'transactions', 'user_id', COUNT(*) FILTER (WHERE user_id IS NULL) FROM b_tx
UNION ALL SELECT 'transactions', 'amount', COUNT(*) FILTER (WHERE amount IS NULL OR isnan(amount)) FROM b_tx
UNION ALL SELECT 'transactions', 'status', COUNT(*) FILTER (WHERE status IS NULL) FROM b_tx
"""


def _dupes(table: str, key: str) -> str:
    return (f"SELECT COUNT(*) - COUNT(DISTINCT {key}) "
            f"- COALESCE(MAX(CASE WHEN {key} IS NULL THEN 1 ELSE 0 END), 0) FROM {table}")


DUPLICATE_COUNT = f"""
SELECT 'users' AS entity, 'user_id' AS key, ({_dupes('b_users', 'user_id')}) AS duplicates
UNION ALL SELECT 'transactions', 'transaction_id', ({_dupes('b_tx', 'transaction_id')})
UNION ALL SELECT 'transaction_details', 'detail_id', ({_dupes('b_details', 'detail_id')})
"""

TRACEABILITY = """
SELECT entity, bronze_rows, silver_rows, bronze_rows - silver_rows AS removed FROM (
  SELECT 'users' AS entity, (SELECT COUNT(*) FROM b_users) AS bronze_rows, (SELECT COUNT(*) FROM s_users) AS silver_rows
  UNION ALL SELECT 'transactions', (SELECT COUNT(*) FROM b_tx), (SELECT COUNT(*) FROM s_tx)
  UNION ALL SELECT 'transaction_details', (SELECT COUNT(*) FROM b_details), (SELECT COUNT(*) FROM s_details)
)
"""

FRESHNESS = f"""
SELECT a.as_of, l.latest, CAST(a.as_of AS TIMESTAMP) - INTERVAL 365 DAY AS threshold,
       COALESCE(l.latest > CAST(a.as_of AS TIMESTAMP) - INTERVAL 365 DAY, false) AS is_fresh
FROM (SELECT '{R.AS_OF}' AS as_of UNION ALL SELECT '{R.AS_OF_LATE}') a,
     (SELECT MAX(created_at) AS latest FROM s_tx) l
"""

SILVER_REJECTS = """
SELECT 'users' AS entity, 'duplicate_key' AS rule,
       (SELECT COUNT(*) FROM b_users) - (SELECT COUNT(*) FROM d_users) AS rejected
UNION ALL SELECT 'users', 'missing_required_field', (SELECT COUNT(*) FROM d_users) - (SELECT COUNT(*) FROM v_users)
UNION ALL SELECT 'transactions', 'duplicate_key', (SELECT COUNT(*) FROM b_tx) - (SELECT COUNT(*) FROM d_tx)
UNION ALL SELECT 'transactions', 'amount_not_positive', (SELECT COUNT(*) FROM d_tx) - (SELECT COUNT(*) FROM p_tx)
UNION ALL SELECT 'transactions', 'invalid_status', (SELECT COUNT(*) FROM p_tx) - (SELECT COUNT(*) FROM c_tx)
UNION ALL SELECT 'transactions', 'unknown_user', (SELECT COUNT(*) FROM c_tx) - (SELECT COUNT(*) FROM s_tx)
UNION ALL SELECT 'transaction_details', 'duplicate_key',
       (SELECT COUNT(*) FROM b_details) - (SELECT COUNT(*) FROM d_details)
UNION ALL SELECT 'transaction_details', 'unknown_transaction',
       (SELECT COUNT(*) FROM d_details) - (SELECT COUNT(*) FROM t_details)
UNION ALL SELECT 'transaction_details', 'invalid_payment_method',
       (SELECT COUNT(*) FROM t_details) - (SELECT COUNT(*) FROM m_details)
UNION ALL SELECT 'transaction_details', 'invalid_channel',
       (SELECT COUNT(*) FROM m_details) - (SELECT COUNT(*) FROM c_details)
UNION ALL SELECT 'transaction_details', 'processing_time_not_positive',
       (SELECT COUNT(*) FROM c_details) - (SELECT COUNT(*) FROM v_details)
"""

LAYER_COUNTS = """
SELECT 'bronze' AS layer, 'users' AS entity, (SELECT COUNT(*) FROM b_users) AS row_count
UNION ALL SELECT 'bronze', 'transactions', (SELECT COUNT(*) FROM b_tx)
UNION ALL SELECT 'bronze', 'transaction_details', (SELECT COUNT(*) FROM b_details)
UNION ALL SELECT 'silver', 'users', (SELECT COUNT(*) FROM s_users)
UNION ALL SELECT 'silver', 'transactions', (SELECT COUNT(*) FROM s_tx)
UNION ALL SELECT 'silver', 'transaction_details', (SELECT COUNT(*) FROM s_details)
"""

_MONTH = "CAST(date_trunc('month', CAST(created_at AS TIMESTAMP)) AS DATE)"

INCREMENTAL = f"""
SELECT *, {_MONTH} AS date, {_MONTH} >= DATE '{R.HISTORY_END}' AS is_new, COUNT(*) OVER (PARTITION BY {_MONTH}) AS loaded_rows
FROM b_tx
"""



def _common(layer: str, prefix: str, label: str = "", mark: str = "") -> str:
    """All rows of a layer's tables in the common form of the stored rows; ``mark`` follows each id."""
    seq = "_seq" if layer == "bronze" else "CAST(NULL AS BIGINT)"
    columns = {
        "users": ("user_id", "name", "email", "created_at", "CAST(NULL AS DOUBLE)"),
        "tx": ("transaction_id", "user_id", "status",
               "created_at" if layer == "bronze" else "strftime(created_at, '%Y-%m-%d %H:%M:%S')", "amount"),
        "details": ("detail_id", "transaction_id", "payment_method", "channel", "CAST(processing_time_ms AS DOUBLE)"),
    }
    names = {"users": "users", "tx": "transactions", "details": "transaction_details"}
    return " UNION ALL ".join(
        f"SELECT {label} '{layer}' AS layer, '{names[t]}' AS entity, {c[0]} || '{mark}' AS id, {c[1]} AS text_1, {c[2]} AS text_2, "
        f"{c[3]} AS text_3, {c[4]} AS number, {seq} AS arrival FROM {prefix}_{t}" for t, c in columns.items())


RERUN_EMPTY = f"""
SELECT * FROM ({_common('bronze', 'b')} UNION ALL {_common('silver', 's')}) WHERE entity <> 'transaction_details'
"""

ALL_REJECTED = """
, keys AS (SELECT (SELECT COUNT(*) FROM b_users) AS u, (SELECT COUNT(DISTINCT coalesce(CAST(user_id AS VARCHAR), 'null')) FROM b_users) AS ku,
  (SELECT COUNT(*) FROM b_tx) AS t, (SELECT COUNT(*) FROM d_tx) AS kt, (SELECT COUNT(*) FROM p_tx) AS pt, (SELECT COUNT(*) FROM c_tx) AS ct,
  (SELECT COUNT(*) FROM b_details) AS d, (SELECT COUNT(*) FROM d_details) AS kd)
SELECT 'users' AS entity, 'duplicate_key' AS rule, u - ku AS rejected FROM keys
UNION ALL SELECT 'users', 'missing_required_field', ku FROM keys
UNION ALL SELECT 'transactions', 'duplicate_key', t - kt FROM keys
UNION ALL SELECT 'transactions', 'amount_not_positive', kt - pt FROM keys
UNION ALL SELECT 'transactions', 'invalid_status', pt - ct FROM keys
UNION ALL SELECT 'transactions', 'unknown_user', ct FROM keys
UNION ALL SELECT 'transaction_details', 'duplicate_key', d - kd FROM keys
UNION ALL SELECT 'transaction_details', 'unknown_transaction', kd FROM keys
UNION ALL SELECT 'transaction_details', 'invalid_payment_method', 0 FROM keys
UNION ALL SELECT 'transaction_details', 'invalid_channel', 0 FROM keys
UNION ALL SELECT 'transaction_details', 'processing_time_not_positive', 0 FROM keys
"""

SKIP_FORCE = " UNION ALL ".join(
    _common("bronze", "b", f"'{step}' AS step,", mark) for step, mark in (("first", ""), ("skipped", ""), ("forced", "x")))

# Text landings: places count all lines, the broken ones do not become rows.
_TX_BROKEN = "CAST(substr(transaction_id, 2) AS BIGINT) % 71 = 0 OR CAST(substr(transaction_id, 2) AS BIGINT) % 73 = 0"
_DETAILS_BROKEN = "_seq % 67 = 0 OR _seq % 61 = 0"
LANDED_TX = f"""
SELECT transaction_id, user_id, amount, status, created_at, place AS _seq
FROM (SELECT *, row_number() OVER (ORDER BY transaction_id, _seq) - 1 AS place FROM b_tx) WHERE NOT ({_TX_BROKEN})
"""
LANDED_DETAILS = f"""
SELECT detail_id, transaction_id, payment_method, channel, processing_time_ms, place AS _seq
FROM (SELECT *, row_number() OVER (ORDER BY detail_id, _seq, processing_time_ms NULLS FIRST, channel NULLS FIRST,
                                   payment_method NULLS FIRST) - 1 AS place FROM b_details) WHERE NOT ({_DETAILS_BROKEN})
"""
TEXT_REJECTS = f"""
{SILVER_REJECTS}
UNION ALL SELECT 'transactions', 'malformed_record', (SELECT COUNT(*) FROM all_tx WHERE {_TX_BROKEN})
UNION ALL SELECT 'transaction_details', 'malformed_record', (SELECT COUNT(*) FROM all_details WHERE {_DETAILS_BROKEN})
"""


def _text_rejects() -> str:
    whole, kept = _prelude(), _prelude(f"NOT ({_TX_BROKEN})", f"NOT ({_DETAILS_BROKEN})")
    cut = lambda name, after: whole[whole.index(f"{name} AS ("):whole.index(f"{after} AS (")].replace(name, f"all_{name[2:]}", 1)
    return kept + ", " + cut("b_tx", "b_details") + cut("b_details", "d_users").rstrip().rstrip(",") + TEXT_REJECTS


SORTED_COUNTS = """
SELECT 'users' AS table_name, COUNT(*) AS reported, COUNT(*) AS stored FROM s_users
UNION ALL SELECT 'transactions', COUNT(*), COUNT(*) FROM s_tx
UNION ALL SELECT 'gold_user_metrics', COUNT(*), COUNT(*) FROM s_users
"""

FINE_PER_USER = """
SELECT u.user_id, ROUND(SUM(t.amount), 6) AS total_amount, ROUND(AVG(t.amount), 6) AS avg_amount
FROM s_users u LEFT JOIN s_tx t ON u.user_id = t.user_id GROUP BY u.user_id
"""
FINE_PER_CHANNEL = """
SELECT td.channel, ROUND(SUM(t.amount), 3) AS total_amount, ROUND(AVG(t.amount), 6) AS avg_amount
FROM s_tx t JOIN s_details td ON t.transaction_id = td.transaction_id GROUP BY td.channel
"""
_SEVENTHS = _prelude(amount="amount / 7")


def _ordered(body: str, order: str) -> str:
    return _q(f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({body})")


def _gate(report: str, name: str) -> str:
    return f"""
SELECT '{name}' AS report, total_checks, passed, failed, pass_rate, failed = 0 AS passed_gate,
       CASE WHEN failed > 0 THEN 'Quality checks fallaron: ' || failed || '/' || total_checks || '. Pass rate: '
            || CAST(pass_rate AS VARCHAR) || '%' END AS message
FROM (SELECT COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE status = 'PASS') AS passed,
             COUNT(*) FILTER (WHERE status = 'FAIL') AS failed,
             ROUND(100.0::DOUBLE * COUNT(*) FILTER (WHERE status = 'PASS') / COUNT(*), 1) AS pass_rate FROM {report})
"""


QUALITY_GATE = f"""
{REPORT_SILVER.replace(', m AS (', ', m1 AS (').replace('FROM m', 'FROM m1').replace('report AS (', 'report1 AS (')}
{REPORT_RAW.replace(', m AS (', ', m2 AS (').replace('FROM m', 'FROM m2').replace('report AS (', 'report2 AS (')}
, report3 AS (SELECT entity, "check", CASE WHEN "check" = 'freshness' THEN 'FAIL' ELSE status END AS status FROM report1)
{_gate('report1', 'silver')} UNION ALL {_gate('report2', 'raw')} UNION ALL {_gate('report3', 'stale')}
"""

FILL_UNKNOWN = f"""
, f AS (
  SELECT detail_id, transaction_id,
         COALESCE({_norm('payment_method')}, 'unknown') AS payment_method,
         COALESCE({_norm('channel')}, 'unknown') AS channel,
         processing_time_ms, _seq
  FROM t_details
)
SELECT * FROM f
WHERE payment_method IN ('card', 'pse', 'cash', 'nequi', 'daviplata', 'unknown')
  AND channel IN ('web', 'mobile', 'api', 'unknown')
  AND processing_time_ms > 0
"""

SQL: dict[str, str] = {
    "ingest_bronze": _q("SELECT * FROM b_tx"),
    "ingest_bronze_users": _q("SELECT * FROM b_users"),
    "ingest_bronze_details": _q("SELECT * FROM b_details"),
    "layer_roundtrip": _q("SELECT * FROM s_users"),
    "layer_roundtrip_transactions": _q("SELECT * FROM s_tx"),
    "layer_roundtrip_details": _q("SELECT * FROM s_details"),
    "landed_json_transactions": _q(LANDED_TX),
    "landed_csv_details": _q(LANDED_DETAILS),
    "text_rejects": _text_rejects(),
    "sorted_write_counts": _q(SORTED_COUNTS),
    "incremental_new_dates": _q(INCREMENTAL),
    "rerun_with_empty_entity": _q(RERUN_EMPTY),
    "all_rejected_day": _q(ALL_REJECTED),
    "skip_and_force": _q(SKIP_FORCE),
    "layer_counts": _q(LAYER_COUNTS),
    "dedup_users": _q("SELECT * FROM d_users"),
    "dedup_transactions": _q("SELECT * FROM d_tx"),
    "dedup_details": _q("SELECT * FROM d_details"),
    "required_not_null": _q("SELECT * FROM v_users"),
    "positive_amount": _q("SELECT * FROM p_tx"),
    "valid_status": _q("SELECT * FROM c_tx"),
    "valid_payment_method": _q("SELECT * FROM m_details"),
    "valid_channel": _q("SELECT * FROM c_details"),
    "positive_processing_time": _q("SELECT * FROM v_details"),
    "normalize_status": _q(f"SELECT transaction_id, {_norm('status')} AS status FROM d_tx"),
    "parse_created_at": _q("SELECT transaction_id, CAST(created_at AS TIMESTAMP) AS created_at FROM d_tx"),
    "fill_unknown": _q(FILL_UNKNOWN),
    "semi_valid_user": _q("SELECT * FROM c_tx WHERE user_id IN (SELECT user_id FROM s_users)"),
    "semi_valid_transaction": _q("SELECT * FROM t_details"),
    "orphan_transactions": _q(
        "SELECT * FROM c_tx t WHERE NOT EXISTS (SELECT 1 FROM s_users u WHERE u.user_id = t.user_id)"),
    "orphan_details": _q(
        "SELECT * FROM d_details d "
        "WHERE NOT EXISTS (SELECT 1 FROM s_tx t WHERE t.transaction_id = d.transaction_id)"),
    "silver_users": _q("SELECT * FROM s_users"),
    "silver_transactions": _q("SELECT * FROM s_tx"),
    "silver_transaction_details": _q("SELECT * FROM s_details"),
    "silver_rejects": _q(SILVER_REJECTS),
    "success_rate": _q(SUCCESS_RATE),
    "gold_user_metrics": _q(GOLD_USER_METRICS),
    "gold_channel_metrics": _q(GOLD_CHANNEL),
    "gold_payment_method_metrics": _q(GOLD_PAYMENT),
    "gold_summary": _q(GOLD_SUMMARY),
    "channel_metrics_per_tx": _q(CHANNEL_PER_TX),
    "summary_per_tx": _q(SUMMARY_PER_TX),
    "gold_user_metrics_sql": _q(GOLD_USER_METRICS),
    "gold_channel_metrics_sql": _q(GOLD_CHANNEL),
    "gold_payment_method_metrics_sql": _q(GOLD_PAYMENT),
    "gold_summary_sql": _q(GOLD_SUMMARY),
    "stored_gold_user_metrics": _q(GOLD_USER_METRICS),
    "stored_order_user_metrics": _ordered(GOLD_USER_METRICS, "total_amount DESC NULLS LAST, user_id"),
    "stored_order_channel": _ordered(GOLD_CHANNEL, "total_amount DESC, channel"),
    "stored_order_payment_method": _ordered(GOLD_PAYMENT, "total_transactions DESC, payment_method"),
    "fine_amounts_per_user": _SEVENTHS + FINE_PER_USER,
    "fine_amounts_per_channel": _SEVENTHS + FINE_PER_CHANNEL,
    "quality_gate": _q(QUALITY_GATE),
    "stored_quality_report": _q(REPORT_SILVER + "SELECT * FROM report"),
    "null_checks": _q(NULL_CHECKS),
    "duplicate_count": _q(DUPLICATE_COUNT),
    "traceability": _q(TRACEABILITY),
    "freshness": _q(FRESHNESS),
    "quality_report_silver": _q(REPORT_SILVER + "SELECT * FROM report"),
    "quality_report_raw": _q(REPORT_RAW + "SELECT * FROM report"),
    "quality_summary": _q(REPORT_RAW + QUALITY_SUMMARY),
}
