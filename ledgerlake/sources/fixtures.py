"""Bronze inputs derived from the driver tables.

customer -> users, orders -> transactions, lineitem -> transaction_details.
The derivation injects, deterministically, every defect the Silver rules
exist for: duplicate keys (with a later copy that differs), NULLs in
required fields, non-positive amounts and durations, mixed case and padding
in coded fields, values outside a domain, and references to removed parents.

Each column is one SQL expression (``selectExpr``): Spark parses it once on
the JVM side. Copies are produced with ``explode`` over a per-row array, so
every source table is scanned once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.schemas import SEQ
from ledgerlake.sources.tables import LazyFrames, read_table
from ledgerlake.sources.text import TextSource

# The Bronze derivation of FIXTURES.md, column by column.
USERS_COPIES = "explode(IF(c_custkey % 29 = 0, array(0L, 1L), array(0L)))"
USERS = {
    "user_id": "concat('U', CAST(c_custkey AS STRING))",
    "name": "CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE c_name END",
    "email": "CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE concat(' ', c_name, '@', c_mktsegment, '.CO ') END",
    "created_at": "concat('2024-01-', lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0'), 'T00:00:00')",
}

TX_COPIES = ("explode(concat(array(0L), IF(o_orderkey % 50 = 0, array(1L), array()), "
             "IF(o_orderkey % 53 = 0, array(2L), array())))")
TX = {
    "transaction_id": "concat('T', CAST(o_orderkey AS STRING))",
    "user_id": "concat('U', CAST(o_custkey AS STRING))",
    "amount": ("CASE WHEN o_orderkey % 83 = 0 THEN NULL "
               "WHEN _seq = 2 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) "
               "ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) - 20000 AS DOUBLE) END"),
    "status": ("CASE WHEN o_orderkey % 101 = 0 THEN NULL "
               "WHEN o_orderkey % 30 = 5 OR o_custkey % 61 = 0 THEN 'pending' "
               "WHEN o_orderkey % 6 IN (0, 5) THEN 'success' "
               "WHEN o_orderkey % 6 = 1 THEN 'failed' "
               "WHEN o_orderkey % 6 = 2 THEN 'SUCCESS' "
               "WHEN o_orderkey % 6 = 3 THEN '\\tFailed\\u00a0\\n' "
               "ELSE 'FAILED' END"),
    "created_at": "replace(CAST(o_orderdate AS STRING), ' ', 'T')",
}

DETAILS = {
    "detail_id": "concat('D', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))",
    "transaction_id": "concat('T', CAST(l_orderkey AS STRING))",
    "payment_method": ("CASE WHEN l_partkey % 89 = 0 THEN NULL "
                       "WHEN l_suppkey % 6 = 0 THEN 'card' "
                       "WHEN l_suppkey % 6 = 1 THEN 'PSE' "
                       "WHEN l_suppkey % 6 = 2 THEN '\\t\\u2003cash' "
                       "WHEN l_suppkey % 6 = 3 THEN 'Nequi' "
                       "WHEN l_suppkey % 6 = 4 THEN 'daviplata' "
                       "ELSE 'crypto' END"),
    "channel": ("CASE WHEN l_partkey % 97 = 0 THEN NULL "
                "WHEN l_partkey % 59 = 0 THEN 'pos' "
                "WHEN l_returnflag = 'A' THEN 'Web' "
                "WHEN l_returnflag = 'N' THEN ' mobile ' "
                "ELSE 'api' END"),
    "processing_time_ms": "CAST(l_quantity * 60 AS BIGINT) - 100",
    SEQ: "l_partkey * 100000 + l_suppkey",
}


def _exprs(columns: dict[str, str]) -> list[str]:
    return [f"{sql} AS {name}" for name, sql in columns.items()]


def bronze_users(customer: DataFrame) -> DataFrame:
    """users(user_id, name, email, created_at, _seq): every 29th customer arrives twice."""
    return customer.selectExpr(*_exprs(USERS), f"{USERS_COPIES} AS {SEQ}")


def bronze_transactions(orders: DataFrame) -> DataFrame:
    """transactions(transaction_id, user_id, amount, status, created_at, _seq).

    ``_seq`` 0 is the order itself with ``amount = totalprice - 20000``; every
    50th order arrives again unchanged (``_seq`` 1), every 53rd arrives again
    with the full total price (``_seq`` 2), so keep-first must run before the
    amount rule.
    """
    copies = orders.selectExpr("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                               f"{TX_COPIES} AS {SEQ}")
    return copies.selectExpr(*_exprs(TX), SEQ)


def bronze_transaction_details(lineitem: DataFrame) -> DataFrame:
    """transaction_details(detail_id, transaction_id, payment_method, channel, processing_time_ms, _seq)."""
    return lineitem.selectExpr(*_exprs(DETAILS))


def bronze_sources(spark: SparkSession, sf_dir: str) -> LazyFrames:
    """The three Bronze inputs of one scale-factor directory (each plan built when first used)."""
    return LazyFrames({
        "users": lambda: bronze_users(read_table(spark, sf_dir, "customer")),
        "transactions": lambda: bronze_transactions(read_table(spark, sf_dir, "orders")),
        "transaction_details": lambda: bronze_transaction_details(read_table(spark, sf_dir, "lineitem")),
    })


# Which arriving lines of the text sources are broken, and how (see FIXTURES.md).
_TX_NUMBER = "CAST(substr(transaction_id, 2) AS BIGINT)"
TRUNCATED_TX, MISTYPED_TX = f"{_TX_NUMBER} % 71 = 0", f"{_TX_NUMBER} % 73 = 0"
SHORT_DETAIL, MISTYPED_DETAIL = f"{SEQ} % 67 = 0", f"{SEQ} % 61 = 0"
TX_ORDER = ("transaction_id", SEQ)
DETAIL_ORDER = ("detail_id", SEQ, "processing_time_ms", "channel", "payment_method")
UNTRIMMED = "map('ignoreLeadingWhiteSpace', 'false', 'ignoreTrailingWhiteSpace', 'false')"


def transactions_json(transactions: DataFrame, path: str) -> TextSource:
    """The transactions as JSON lines in arrival order; some are cut off, some hold text as amount."""
    whole = "to_json(struct(transaction_id, user_id, amount, status, created_at))"
    mistyped = "concat('{\"transaction_id\":\"', transaction_id, '\",\"amount\":\"much\"}')"
    (transactions.orderBy(*TX_ORDER).selectExpr(
        f"CASE WHEN {TRUNCATED_TX} THEN substr({whole}, 1, 20) WHEN {MISTYPED_TX} THEN {mistyped} ELSE {whole} END AS value")
        .write.text(path))
    return TextSource("json", path)


def details_csv(details: DataFrame, path: str) -> TextSource:
    """The details as CSV lines in arrival order; some lack fields, some hold text as milliseconds."""
    whole = f"to_csv(struct(detail_id, transaction_id, payment_method, channel, processing_time_ms), {UNTRIMMED})"
    (details.orderBy(*DETAIL_ORDER).selectExpr(
        f"CASE WHEN {SHORT_DETAIL} THEN concat(detail_id, ',', transaction_id) "
        f"WHEN {MISTYPED_DETAIL} THEN concat(detail_id, ',', transaction_id, ',card,web,soon') ELSE {whole} END AS value")
        .write.text(path))
    return TextSource("csv", path, {"header": "false"})
