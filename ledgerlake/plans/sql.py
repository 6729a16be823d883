"""The Gold tables as Spark SQL over registered Silver views.

For users who keep their metric definitions as SQL text: the three Silver
tables are registered as temporary views (``users``, ``transactions``,
``transaction_details``) and each Gold table is one ``spark.sql`` statement.
Catalyst plans SQL and DataFrame code alike; the statements use the same
exact arithmetic as ``ledgerlake.plans.gold`` (order-independent sums, integer
half-up rounding with ``div``), so both forms return the same values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.functions.numeric import exact_sum_sql

VIEW_NAMES = {"users": "users", "transactions": "transactions", "transaction_details": "transaction_details"}


def register_views(silver: dict[str, DataFrame], names: dict[str, str] | None = None) -> None:
    """Register Silver DataFrames as temporary views (session scope)."""
    for entity, view in (names or VIEW_NAMES).items():
        silver[entity].createOrReplaceTempView(view)


def _rate(num: str, den: str, factor: int = 100) -> str:
    """ROUND(factor * num / den, 2), exact half-up, NULL for den = 0."""
    return (f"CAST((({num}) * {2 * factor * 100} + ({den})) DIV NULLIF(2 * ({den}), 0) AS DOUBLE)"
            f" / CAST(100 AS DOUBLE)")


# Details are reduced per transaction before the join: n details, their milliseconds.
_PER = """
SELECT transaction_id, {dims} COUNT(*) AS n, SUM(processing_time_ms) AS ms, COUNT(processing_time_ms) AS ms_n
FROM transaction_details GROUP BY ALL
"""

_WEIGHTED_SUM = exact_sum_sql("amount", "n")
_WEIGHT = "SUM(IF(amount IS NULL, 0, n))"


def _by_dimension(dim: str, outcomes: str, order: str) -> str:
    """Metrics of one detail column: a transaction counts once in total_transactions and
    once per detail in amounts and outcomes."""
    return f"""
WITH per AS ({_PER.format(dims=dim + ',')}),
fact AS (SELECT per.*, amount, status FROM per INNER JOIN transactions USING (transaction_id)),
metric AS (
  SELECT {dim}, COUNT(*) AS total_transactions, {_WEIGHTED_SUM} AS volume, {_WEIGHT} AS weight,
         SUM(IF(status = 'success', n, 0)) AS successful, SUM(IF(status = 'failed', n, 0)) AS failed,
         SUM(ms) AS ms, SUM(ms_n) AS ms_n
  FROM fact GROUP BY {dim})
SELECT {dim}, total_transactions, volume AS total_amount,
       volume / NULLIF(weight, 0) AS avg_amount,
       {_rate('ms', 'ms_n', 1)} AS avg_processing_time_ms, {outcomes}
       {_rate('successful', 'total_transactions')} AS success_rate_pct
FROM metric ORDER BY {order} DESC, {dim}
"""


GOLD_SQL = {
    "gold_user_metrics": f"""
WITH activity AS (
  SELECT user_id, COUNT(transaction_id) AS n, {exact_sum_sql('amount')} AS volume, COUNT(amount) AS priced,
         MAX(amount) AS highest, MIN(amount) AS lowest,
         COUNT_IF(status = 'success') AS ok, COUNT_IF(status = 'failed') AS bad,
         MIN(created_at) AS earliest, MAX(created_at) AS latest
  FROM transactions GROUP BY user_id)
SELECT user_id, name, email, COALESCE(n, 0) AS total_transactions, volume AS total_amount,
       volume / NULLIF(priced, 0) AS avg_amount, highest AS max_amount, lowest AS min_amount,
       COALESCE(ok, 0) AS successful_transactions, COALESCE(bad, 0) AS failed_transactions,
       {_rate('ok', 'n')} AS success_rate_pct,
       earliest AS first_transaction_at, latest AS last_transaction_at
FROM users LEFT JOIN activity USING (user_id)
ORDER BY total_amount DESC NULLS LAST, user_id
""",
    "gold_channel_metrics": _by_dimension("channel", "successful, failed,", "total_amount"),
    "gold_payment_method_metrics": _by_dimension("payment_method", "", "total_transactions"),
    "gold_summary": f"""
WITH per AS ({_PER.format(dims='')}),
fact AS (SELECT t.transaction_id, t.user_id, t.amount, t.status, t.created_at, COALESCE(per.n, 1) AS n, ms, ms_n
         FROM transactions AS t LEFT JOIN per USING (transaction_id)),
active AS (SELECT COUNT(*) AS active_users FROM (SELECT user_id FROM transactions WHERE user_id IS NOT NULL GROUP BY user_id)),
total AS (
  SELECT COUNT(transaction_id) AS total_transactions, {_WEIGHTED_SUM} AS volume, {_WEIGHT} AS weight,
         SUM(n) AS joined_rows, SUM(IF(status = 'success', n, 0)) AS ok, SUM(ms) AS ms, SUM(ms_n) AS ms_n,
         MIN(created_at) AS pipeline_start, MAX(created_at) AS pipeline_end
  FROM fact)
SELECT total_transactions, (SELECT active_users FROM active) AS active_users, volume AS total_volume,
       volume / NULLIF(weight, 0) AS avg_transaction_amount,
       {_rate('ok', 'joined_rows')} AS overall_success_rate_pct,
       {_rate('ms', 'ms_n', 1)} AS avg_processing_time_ms,
       pipeline_start, pipeline_end, CURRENT_TIMESTAMP() AS generated_at
FROM total
""",
}


def gold_sql(spark: SparkSession, name: str) -> DataFrame:
    """Run one Gold statement against the registered views."""
    return spark.sql(GOLD_SQL[name])
