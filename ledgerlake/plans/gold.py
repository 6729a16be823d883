"""Silver -> Gold metric tables.

Plan shape, chosen for scale:

* ``transaction_facts`` reduces the details to one row of counters per
  transaction: rows, milliseconds and timed rows, in all and for each value of
  the fixed domains of channel and payment method. The partial aggregate runs before the
  shuffle, so a transaction with a huge number of details cannot skew it, and
  its exchange on transaction_id is the one the join with the transactions
  uses. The channel, payment-method and summary tables are sums over these rows:
  nothing is shuffled on transaction_id again.
* Because Silver transactions are unique on transaction_id (the dedupe
  guarantees it), ``COUNT(DISTINCT transaction_id)`` per dimension is a
  plain count of the transactions whose counter is not zero.
* ``user_activity`` folds the transactions per user, map-side first. It serves the user
  metrics (users LEFT JOIN activity) and, stored, the number of active users of the
  summary, so the Gold job counts no distinct users over joined rows.
* ``gold_from_bronze`` computes the tables from Bronze in one plan. There the
  joins above do the work of the reference checks: details and transactions
  are folded per key before they meet their parents, so neither a hot key nor keys without a
  parent are shuffled row by row.
* Sums of amounts are exact and rates are rounded with integer arithmetic
  (``ledgerlake.functions.numeric``), so results do not depend on the order
  rows arrive in.

Semantics are those of the SQL the tables are defined by, including the
fan-out of the joined forms: in channel, payment-method and summary metrics
a transaction's amount and status count once per detail row, while
``total_transactions`` counts it once. ``per_transaction=True`` gives the
figures with every transaction counted once instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.constants import CHANNELS, FAILED, PAYMENT_METHODS, SUCCESS, UNKNOWN
from ledgerlake.functions.numeric import exact_sum, ratio, round_ratio
from ledgerlake.plans import silver
from ledgerlake.sources.tables import LazyFrames

TX = "transaction_id"
MS = "processing_time_ms"

# What Silver lets through (``null_policy="unknown"`` adds the last value).
DOMAINS = {"channel": (*CHANNELS, UNKNOWN), "payment_method": (*PAYMENT_METHODS, UNKNOWN)}


def _zero(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(0)).cast("long")


# --------------------------------------------------------------------------- per user

def user_activity(transactions: DataFrame) -> DataFrame:
    """One row per user_id of ``transactions``: counts, amounts and times."""
    status = F.col("status")
    return transactions.groupBy("user_id").agg(
        F.count(TX).alias("n_tx"),
        exact_sum("amount").alias("amount_sum"),
        F.count("amount").alias("amount_n"),
        F.max("amount").alias("max_amount"),
        F.min("amount").alias("min_amount"),
        F.count_if(status == SUCCESS).alias("n_ok"),
        F.count_if(status == FAILED).alias("n_failed"),
        F.min("created_at").alias("first_transaction_at"),
        F.max("created_at").alias("last_transaction_at"),
    )


def metrics_of_users(users: DataFrame, activity: DataFrame) -> DataFrame:
    """KPIs per user from ``user_activity``; users without transactions get zero counts and NULL amounts."""
    joined = users.select("user_id", "name", "email").join(activity, "user_id", "left")
    return joined.select(
        "user_id", "name", "email",
        _zero("n_tx").alias("total_transactions"),
        F.col("amount_sum").alias("total_amount"),
        ratio(F.col("amount_sum"), F.col("amount_n")).alias("avg_amount"),
        "max_amount",
        "min_amount",
        _zero("n_ok").alias("successful_transactions"),
        _zero("n_failed").alias("failed_transactions"),
        round_ratio(_zero("n_ok"), _zero("n_tx"), factor=100).alias("success_rate_pct"),
        "first_transaction_at",
        "last_transaction_at",
    )


def gold_user_metrics(users: DataFrame, transactions: DataFrame) -> DataFrame:
    """KPIs per user (transactions of unknown users play no part)."""
    return metrics_of_users(users, user_activity(transactions))


def sorted_user_metrics(metrics: DataFrame) -> DataFrame:
    """ORDER BY total_amount DESC NULLS LAST (user_id breaks ties)."""
    return metrics.orderBy(F.desc_nulls_last("total_amount"), F.asc("user_id"))


# --------------------------------------------------------------------------- facts

_TX_ATTRS = ("user_id", "amount", "status", "created_at")


def _counter(dim: str, value: str, what: str) -> str:
    return f"{dim}_{value}_{what}"


def _code_sql(dim: str) -> str:
    """The place of a value in its domain; one outside it fails the job instead of being left out of a table."""
    places = " ".join(f"WHEN {dim} = '{value}' THEN {i}" for i, value in enumerate(DOMAINS[dim]))
    outside = f"raise_error(concat('{dim} outside its domain (clean the details, or use dimension_metrics): ', coalesce({dim}, 'NULL')))"
    return f"CASE {places} ELSE CAST({outside} AS INT) END AS {dim}"


def transaction_counters(details: DataFrame, dims: Sequence[str] = tuple(DOMAINS)) -> DataFrame:
    """One row per transaction_id: ``_n`` details, ``_ms_sum``, ``_ms_n``, and the same per value of ``dims``."""
    aggs = ["count(1) AS _n", f"sum({MS}) AS _ms_sum", f"count({MS}) AS _ms_n"]
    for dim in dims:
        for i, value in enumerate(DOMAINS[dim]):
            timed = f"CASE WHEN {dim} = {i} THEN {MS} END"
            aggs += [f"count_if({dim} = {i}) AS {_counter(dim, value, 'n')}",
                     f"sum({timed}) AS {_counter(dim, value, 'ms_sum')}",
                     f"count({timed}) AS {_counter(dim, value, 'ms_n')}"]
    coded = details.selectExpr(TX, MS, *map(_code_sql, dims))
    return coded.groupBy(TX).agg(*map(F.expr, aggs))


def transaction_facts(transactions: DataFrame, details: DataFrame, dims: Sequence[str] = tuple(DOMAINS)) -> DataFrame:
    """``transactions LEFT JOIN details`` as one row per transaction with the counters of its details.

    A transaction without details keeps NULL counters; details without a
    transaction drop out. Values of ``dims`` outside their domain fail the job.
    """
    return transactions.select(TX, *_TX_ATTRS).join(transaction_counters(details, dims), TX, "left")


def per_value(facts: DataFrame, dim: str) -> DataFrame:
    """One row per (transaction, value of ``dim`` that its details have): a split of each fact row, no shuffle."""
    cells = ", ".join(
        f"named_struct('{dim}', '{value}', " + ", ".join(f"'_{w}', {_counter(dim, value, w)}" for w in ("n", "ms_sum", "ms_n")) + ")"
        for value in DOMAINS[dim])
    split = facts.where(F.col("_n").isNotNull()).selectExpr(TX, "amount", "status", f"explode(array({cells})) AS _cell")
    return split.select(TX, "amount", "status", "_cell.*").where(F.col("_n") > 0)


# --------------------------------------------------------------------------- per detail dimension

def _details_per_transaction(details: DataFrame, dims: list[str]) -> DataFrame:
    return details.groupBy(TX, *dims).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(MS).alias("_ms_sum"),
        F.count(MS).alias("_ms_n"),
    )


def dimension_metrics(
    transactions: DataFrame, details: DataFrame, dim: str, per_transaction: bool = False
) -> DataFrame:
    """All metrics of ``transactions JOIN details GROUP BY details.<dim>``, for any column ``dim`` of any values.

    Columns: dim, total_transactions, total_amount, avg_amount,
    avg_processing_time_ms, successful, failed, success_rate_pct.
    """
    pairs = _details_per_transaction(details, [dim])
    j = transactions.select(TX, "amount", "status").join(pairs, TX, "inner")
    return _dimension_agg(j, dim, per_transaction)


def domain_metrics(
    transactions: DataFrame, details: DataFrame, dim: str, per_transaction: bool = False
) -> DataFrame:
    """``dimension_metrics`` for a ``dim`` with a fixed domain: details are shuffled once, on transaction_id."""
    return _dimension_agg(per_value(transaction_facts(transactions, details, [dim]), dim), dim, per_transaction)


def _dimension_agg(j: DataFrame, dim: str, per_transaction: bool) -> DataFrame:
    """Metrics per ``dim`` from one row per (transaction, dim) with its detail count ``_n``."""
    weighed = j.withColumn("_w", F.lit(1).cast("long") if per_transaction else F.col("_n"))
    w, status = F.col("_w"), F.col("status")
    g = weighed.groupBy(dim).agg(
        F.count(TX).alias("total_transactions"),
        exact_sum("amount", "_w").alias("_amount_sum"),
        F.sum(F.when(F.col("amount").isNotNull(), w)).alias("_amount_n"),
        F.sum("_ms_sum").alias("_ms_sum"),
        F.sum("_ms_n").alias("_ms_n"),
        F.sum(F.when(status == SUCCESS, w).otherwise(0)).alias("_ok"),
        F.sum(F.when(status == FAILED, w).otherwise(0)).alias("_failed"),
    )
    return g.select(
        dim,
        F.col("total_transactions").cast("long").alias("total_transactions"),
        F.col("_amount_sum").alias("total_amount"),
        ratio(F.col("_amount_sum"), F.col("_amount_n")).alias("avg_amount"),
        round_ratio(F.col("_ms_sum"), F.col("_ms_n")).alias("avg_processing_time_ms"),
        F.col("_ok").cast("long").alias("successful"),
        F.col("_failed").cast("long").alias("failed"),
        round_ratio(F.col("_ok"), F.col("total_transactions"), factor=100).alias("success_rate_pct"),
    )


def _order_channel(m: DataFrame) -> DataFrame:
    return m.orderBy(F.desc("total_amount"), "channel")


def _order_payment(m: DataFrame) -> DataFrame:
    return (m.select("payment_method", "total_transactions", "total_amount", "avg_amount",
                     "avg_processing_time_ms", "success_rate_pct")
             .orderBy(F.desc("total_transactions"), "payment_method"))


def gold_channel_metrics(transactions: DataFrame, details: DataFrame) -> DataFrame:
    return _order_channel(domain_metrics(transactions, details, "channel"))


def gold_payment_method_metrics(transactions: DataFrame, details: DataFrame) -> DataFrame:
    return _order_payment(domain_metrics(transactions, details, "payment_method"))


def channel_metrics_per_tx(transactions: DataFrame, details: DataFrame) -> DataFrame:
    """Channel metrics with each transaction weighed once per channel it used."""
    return domain_metrics(transactions, details, "channel", per_transaction=True)


# --------------------------------------------------------------------------- summary

def _active_users(activity: DataFrame) -> DataFrame:
    """One row: how many users ``activity`` (one row per user_id) names."""
    return activity.agg(F.count("user_id").alias("active_users"))


def summary_metrics(
    transactions: DataFrame,
    details: DataFrame,
    per_transaction: bool = False,
    generated_at: Column | None = None,
) -> DataFrame:
    """One-row business summary of ``transactions LEFT JOIN details``."""
    return _summary(transaction_facts(transactions, details, ()), None, per_transaction, generated_at)


def _summary(facts: DataFrame, activity: DataFrame | None, per_transaction: bool,
             generated_at: Column | None) -> DataFrame:
    """The summary from one row per transaction with its detail count ``_n`` (NULL: no details).

    Active users are counted in ``activity`` (one stored row per user) if given, else within
    the same pass over the facts: reading those twice would make their whole plan twice.
    """
    whole = F.lit(1).cast("long")
    weighed = facts.withColumn("_w", whole if per_transaction else F.coalesce(F.col("_n"), whole))
    w, tx_id, status = F.col("_w"), F.col(TX), F.col("status")
    users = [] if activity is not None else [F.countDistinct("user_id").alias("active_users")]
    totals = weighed.agg(
        *users,
        F.count(TX).alias("total_transactions"),
        exact_sum("amount", "_w").alias("_amount_sum"),
        F.sum(F.when(F.col("amount").isNotNull(), w)).alias("_amount_n"),
        F.sum(F.when(status == SUCCESS, w).otherwise(0)).alias("_ok"),
        F.sum(F.when(tx_id.isNotNull(), w).otherwise(0)).alias("_rows"),
        F.sum("_ms_sum").alias("_ms_sum"),
        F.sum("_ms_n").alias("_ms_n"),
        F.min("created_at").alias("pipeline_start"),
        F.max("created_at").alias("pipeline_end"),
    )
    if activity is not None:
        # Two one-row results side by side, without a cross join.
        both = totals.unionByName(_active_users(activity), allowMissingColumns=True)
        totals = both.agg(*[F.max(c).alias(c) for c in both.columns])
    cols = [
        F.col("total_transactions").cast("long").alias("total_transactions"),
        F.col("active_users").cast("long").alias("active_users"),
        F.col("_amount_sum").alias("total_volume"),
        ratio(F.col("_amount_sum"), F.col("_amount_n")).alias("avg_transaction_amount"),
        round_ratio(F.col("_ok"), F.col("_rows"), factor=100).alias("overall_success_rate_pct"),
        round_ratio(F.col("_ms_sum"), F.col("_ms_n")).alias("avg_processing_time_ms"),
        "pipeline_start",
        "pipeline_end",
    ]
    if generated_at is not None:
        cols.append(generated_at.alias("generated_at"))
    return totals.select(*cols)


def gold_summary(transactions: DataFrame, details: DataFrame, with_generated_at: bool = True) -> DataFrame:
    gen = F.current_timestamp() if with_generated_at else None
    return summary_metrics(transactions, details, per_transaction=False, generated_at=gen)


def summary_per_tx(transactions: DataFrame, details: DataFrame) -> DataFrame:
    """Summary with each transaction counted once (no detail fan-out)."""
    return summary_metrics(transactions, details, per_transaction=True)


# --------------------------------------------------------------------------- all tables

def build_gold(silver_tables, with_generated_at: bool = True) -> dict[str, DataFrame]:
    """The four Gold tables from the Silver tables, each as its own plan (details read once per table)."""
    users, tx, details = (silver_tables[e] for e in ("users", "transactions", "transaction_details"))
    return {
        "gold_user_metrics": sorted_user_metrics(gold_user_metrics(users, tx)),
        "gold_channel_metrics": gold_channel_metrics(tx, details),
        "gold_payment_method_metrics": gold_payment_method_metrics(tx, details),
        "gold_summary": gold_summary(tx, details, with_generated_at),
    }


def gold_from_facts(users: DataFrame, transactions: DataFrame, facts: DataFrame,
                    with_generated_at: bool = True, activity: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four Gold tables from shared ``transaction_facts`` and ``user_activity`` (taken from the transactions if not given)."""
    activity = user_activity(transactions) if activity is None else activity
    gen = F.current_timestamp() if with_generated_at else None
    return {
        "gold_user_metrics": sorted_user_metrics(metrics_of_users(users, activity)),
        "gold_channel_metrics": _order_channel(_dimension_agg(per_value(facts, "channel"), "channel", False)),
        "gold_payment_method_metrics": _order_payment(
            _dimension_agg(per_value(facts, "payment_method"), "payment_method", False)),
        "gold_summary": _summary(facts, activity, False, gen),
    }


def gold_from_bronze(bronze, null_policy: str = "drop", with_generated_at: bool = True) -> LazyFrames:
    """The Gold tables (and their per-transaction forms) from Bronze, each as one plan.

    Equal to ``build_gold`` of the Silver tables. The details are deduplicated, checked by their own
    columns and folded per transaction; the join with the clean transactions then drops the
    folded rows of unknown transactions, in place of a semi-join of every detail row. User metrics fold
    the transactions per user in the same way before the users are joined.
    """
    frames: LazyFrames = LazyFrames({
        "users": lambda: silver.clean_users(bronze["users"]),
        "unlinked": lambda: silver.transactions_unlinked(bronze["transactions"]),
        "transactions": lambda: silver.clean_transactions(bronze["transactions"], frames["users"]),
        "details": lambda: silver.details_unlinked(bronze["transaction_details"], null_policy),
        "gold_user_metrics": lambda: sorted_user_metrics(gold_user_metrics(frames["users"], frames["unlinked"])),
        "gold_channel_metrics": lambda: gold_channel_metrics(frames["transactions"], frames["details"]),
        "gold_payment_method_metrics": lambda: gold_payment_method_metrics(frames["transactions"], frames["details"]),
        "gold_summary": lambda: gold_summary(frames["transactions"], frames["details"], with_generated_at),
        "channel_metrics_per_tx": lambda: channel_metrics_per_tx(frames["transactions"], frames["details"]),
        "summary_per_tx": lambda: summary_per_tx(frames["transactions"], frames["details"]),
    })
    return frames


def success_rate_by_month(transactions: DataFrame) -> DataFrame:
    """Success rate per calendar month of created_at: (month, total, successful, rate)."""
    month = F.trunc(F.to_date("created_at"), "month").alias("month")
    g = transactions.groupBy(month).agg(
        F.count(TX).alias("total_transactions"),
        F.count_if(F.col("status") == SUCCESS).alias("successful"),
    )
    return g.select(
        "month", "total_transactions", "successful",
        round_ratio(F.col("successful"), F.col("total_transactions"), factor=100).alias("success_rate_pct"),
    )
