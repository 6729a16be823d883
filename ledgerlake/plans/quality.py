"""The quality report: 18 checks over Bronze and Silver, as a DataFrame.

Plan shape: one aggregate pass per table computes every number the checks
need (row counts, NULL counts, rule violations, distinct keys, newest
timestamp), plus one anti-join count per foreign key. The one-row results
are stacked with ``unionByName`` and folded into a single metrics row by a
tiny global aggregate (no cross join), and that row is exploded into the
18 report rows. Only the report (18 rows) or its one-row summary ever
reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.constants import (
    FAIL,
    FRESHNESS_DAYS,
    MSG_AMOUNT,
    MSG_DUPES,
    MSG_FRESHNESS,
    MSG_GATE,
    MSG_NO_TIMESTAMP,
    MSG_NULLS,
    MSG_ORPHAN_DETAILS,
    MSG_ORPHAN_TX,
    MSG_RECORD_COUNT,
    MSG_STATUS,
    MSG_TRACE_DETAILS,
    MSG_TRACE_TX,
    PASS,
    VALID_STATUSES,
)
from ledgerlake.functions.numeric import round_half_even_ratio
from ledgerlake.functions.timefmt import iso_text, parse_timestamp
from ledgerlake.operators.integrity import orphans
from ledgerlake.schemas import QUALITY_REPORT

USER_NULL_COLS = ("user_id", "name", "email")
TX_NULL_COLS = ("transaction_id", "user_id", "amount", "status")
FLOAT_COLS = ("amount",)


def _missing_sql(col: str) -> str:
    """pandas ``isnull`` semantics: NULL, and NaN for floating columns."""
    return f"({col} IS NULL OR isnan({col}))" if col in FLOAT_COLS else f"{col} IS NULL"


def _is_missing(col: str) -> Column:
    return F.expr(_missing_sql(col))


def _sql_str(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _fmt(template: str, **values: str) -> str:
    """A ``{name}`` message template as a SQL ``concat`` of literals and values."""
    parts: list[str] = []
    rest = template
    while "{" in rest:
        head, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        if head:
            parts.append(_sql_str(head))
        parts.append(f"CAST({values[name]} AS STRING)")
    if rest:
        parts.append(_sql_str(rest))
    return f"concat({', '.join(parts)})"


def _in_domain_sql(col: str, domain) -> str:
    values = ", ".join(_sql_str(v) for v in domain)
    return f"coalesce({col} IN ({values}), false)"


def _duplicates_sql(key: str) -> str:
    """Rows whose key already appeared (NULL keys are equal to each other)."""
    return (f"count(1) - count(DISTINCT {key}) "
            f"- coalesce(max(IF({key} IS NULL, 1, 0)), 0)")


def _timestamp_text_sql(col: str) -> str:
    frac = f"date_format({col}, 'SSSSSS')"
    return (f"coalesce(concat(date_format({col}, 'yyyy-MM-dd HH:mm:ss'), "
            f"IF({frac} != '000000', concat('.', {frac}), '')), {_sql_str(MSG_NO_TIMESTAMP)})")


def _freshness_threshold(as_of: str | None) -> Column:
    now = F.localtimestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    return now - F.make_interval(days=F.lit(FRESHNESS_DAYS))


def _agg(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.agg(*[F.expr(sql).alias(name) for name, sql in exprs.items()])


def collect_metrics(
    users: DataFrame,
    transactions: DataFrame,
    details: DataFrame,
    bronze_transactions: DataFrame,
    bronze_details: DataFrame,
    as_of: str | None = None,
) -> DataFrame:
    """Every number the checks need, as one row (one aggregate pass per table)."""
    u = _agg(users, {"users_rows": "count(1)",
                     **{f"users_null_{c}": f"count_if({_missing_sql(c)})" for c in USER_NULL_COLS}})
    t = _agg(transactions, {
        "tx_rows": "count(1)",
        **{f"tx_null_{c}": f"count_if({_missing_sql(c)})" for c in TX_NULL_COLS},
        "tx_amount_not_positive": "count_if(amount <= 0)",
        "tx_bad_status": f"count_if(NOT {_in_domain_sql('status', VALID_STATUSES)})",
        "tx_duplicates": _duplicates_sql("transaction_id"),
        "tx_latest": "max(created_at)",
    })
    d = _agg(details, {"details_rows": "count(1)"})
    tb = _agg(bronze_transactions, {"tx_bronze_rows": "count(1)"})
    db = _agg(bronze_details, {"details_bronze_rows": "count(1)"})
    ot = orphan_rows(transactions, users, "user_id").withColumnRenamed("orphan_rows", "tx_orphans")
    od = orphan_rows(details, transactions, "transaction_id").withColumnRenamed("orphan_rows", "details_orphans")

    stacked = u
    for part in (t, d, tb, db, ot, od):
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    one = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    return one.withColumn(
        "tx_fresh",
        F.coalesce(F.col("tx_latest") > _freshness_threshold(as_of), F.lit(False)),
    )


def orphan_rows(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row: how many ``child`` rows have a NULL or unknown ``key`` (``orphan_rows``).

    Child rows are counted per key first (a partial aggregate before the
    shuffle), so the anti-join sees one row per key: a key holding a third
    of the rows costs one row, not a skewed partition.
    """
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return orphans(per_key, parent, key).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("orphan_rows"))


@dataclass(frozen=True)
class Check:
    """One report row: pass condition and detail text as SQL over the metrics row."""
    entity: str
    name: str
    passed: str
    detail: str


def _checks() -> list[Check]:
    checks = [
        Check("users", "record_count", "users_rows > 0", _fmt(MSG_RECORD_COUNT, n="users_rows")),
        Check("transactions", "record_count", "tx_rows > 0", _fmt(MSG_RECORD_COUNT, n="tx_rows")),
        Check("transaction_details", "record_count", "details_rows > 0",
              _fmt(MSG_RECORD_COUNT, n="details_rows")),
        Check("transactions", "bronze_to_silver_traceability", "tx_rows <= tx_bronze_rows",
              _fmt(MSG_TRACE_TX, b="tx_bronze_rows", s="tx_rows", d="tx_bronze_rows - tx_rows")),
        Check("transaction_details", "bronze_to_silver_traceability", "details_rows <= details_bronze_rows",
              _fmt(MSG_TRACE_DETAILS, b="details_bronze_rows", s="details_rows")),
    ]
    for col in USER_NULL_COLS:
        n = f"users_null_{col}"
        checks.append(Check("users", f"null_check_{col}", f"{n} = 0", _fmt(MSG_NULLS, n=n, col=_sql_str(col))))
    for col in TX_NULL_COLS:
        n = f"tx_null_{col}"
        checks.append(Check("transactions", f"null_check_{col}", f"{n} = 0",
                            _fmt(MSG_NULLS, n=n, col=_sql_str(col))))
    checks += [
        Check("transactions", "amount_positive", "tx_amount_not_positive = 0",
              _fmt(MSG_AMOUNT, n="tx_amount_not_positive")),
        Check("transactions", "status_standardized", "tx_bad_status = 0", _fmt(MSG_STATUS, n="tx_bad_status")),
        Check("transactions", "no_duplicates", "tx_duplicates = 0", _fmt(MSG_DUPES, n="tx_duplicates")),
        Check("transactions", "referential_integrity_users", "tx_orphans = 0",
              _fmt(MSG_ORPHAN_TX, n="tx_orphans")),
        Check("transaction_details", "referential_integrity_transactions", "details_orphans = 0",
              _fmt(MSG_ORPHAN_DETAILS, n="details_orphans")),
        Check("transactions", "freshness", "tx_fresh",
              _fmt(MSG_FRESHNESS, ts=_timestamp_text_sql("tx_latest"))),
    ]
    return checks


def report_from_metrics(metrics: DataFrame, checked_at: str | None = None) -> DataFrame:
    """Unpivot the one-row metrics into the report rows (``stack``), in check order."""
    checks = _checks()
    args = ", ".join(
        f"{_sql_str(c.entity)}, {_sql_str(c.name)}, "
        f"CASE WHEN coalesce({c.passed}, false) THEN {_sql_str(PASS)} ELSE {_sql_str(FAIL)} END, {c.detail}"
        for c in checks
    )
    rows = metrics.selectExpr(f"stack({len(checks)}, {args}) AS (entity, `check`, status, detail)")
    stamp = F.lit(checked_at) if checked_at is not None else iso_text(F.localtimestamp())
    return rows.select("entity", "check", "status", "detail", stamp.alias("checked_at"))


def quality_report(
    users: DataFrame,
    transactions: DataFrame,
    details: DataFrame,
    bronze_transactions: DataFrame,
    bronze_details: DataFrame,
    as_of: str | None = None,
    checked_at: str | None = None,
) -> DataFrame:
    """The 18-row report (entity, check, status, detail, checked_at).

    ``transactions.created_at`` may be a timestamp (Silver) or ISO text
    (raw Bronze); text is parsed first. ``as_of`` (default: now) anchors the
    365-day freshness window.
    """
    if dict(transactions.dtypes)["created_at"] == "string":
        transactions = transactions.withColumn("created_at", parse_timestamp("created_at"))
    metrics = collect_metrics(users, transactions, details, bronze_transactions, bronze_details, as_of)
    return report_from_metrics(metrics, checked_at)


def quality_summary(report: DataFrame) -> DataFrame:
    """One row: total_checks, passed, failed, pass_rate (one decimal, 0 for an empty report)."""
    g = report.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("status") == PASS).alias("passed"),
        F.count_if(F.col("status") == FAIL).alias("failed"),
    )
    rate = (F.when(F.col("total_checks") > 0,
                   round_half_even_ratio(F.col("passed"), F.col("total_checks"), factor=100, digits=1))
             .otherwise(F.lit(0.0)))
    return g.select("total_checks", "passed", "failed", rate.alias("pass_rate"))


class QualityGateError(ValueError):
    """Raised when a quality report contains a failed check."""


def gate_result(report: DataFrame) -> DataFrame:
    """One row: the summary with ``passed_gate`` and ``message`` (NULL where every check passed)."""
    summary = quality_summary(report)
    message = F.expr(_fmt(MSG_GATE, failed="failed", total="total_checks", rate="pass_rate"))
    return summary.select("*", (F.col("failed") == 0).alias("passed_gate"),
                          F.when(F.col("failed") > 0, message).alias("message"))


def assert_quality(report: DataFrame) -> dict:
    """Fail the run if any check failed; return the summary otherwise."""
    result = gate_result(report).first().asDict()
    if not result.pop("passed_gate"):
        raise QualityGateError(result["message"])
    del result["message"]
    return result


def write_report_csv(report: DataFrame, path: str) -> str:
    """The report as one CSV file with a header (18 rows: one task is enough)."""
    (report.select(*[f.name for f in QUALITY_REPORT.fields])
           .coalesce(1).write.mode("overwrite").option("header", True).csv(path))
    return path


# --------------------------------------------------------------------------- standalone checks

def null_counts(df: DataFrame, entity: str, cols) -> DataFrame:
    """(entity, column_name, nulls) for each column, from one aggregate pass."""
    one = df.agg(*[F.count_if(_is_missing(c)).alias(f"_n{i}") for i, c in enumerate(cols)])
    rows = F.array(*[
        F.struct(F.lit(entity).alias("entity"), F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("nulls"))
        for i, c in enumerate(cols)
    ])
    return one.select(F.explode(rows).alias("r")).select("r.entity", "r.column_name", "r.nulls")


def duplicate_counts(df: DataFrame, entity: str, key: str) -> DataFrame:
    """(entity, key, duplicates): rows whose key value already appeared."""
    return df.agg(F.expr(_duplicates_sql(key)).alias("duplicates")).select(
        F.lit(entity).alias("entity"), F.lit(key).alias("key"), "duplicates")


def traceability(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(entity, bronze_rows, silver_rows, removed) per entity of ``{entity: (bronze, silver)}``."""
    out = None
    for entity, (bronze, silver) in pairs.items():
        counts = (bronze.select(F.lit(1).alias("_b"), F.lit(0).alias("_s"))
                        .unionByName(silver.select(F.lit(0).alias("_b"), F.lit(1).alias("_s")))
                        .agg(F.sum("_b").cast("long").alias("bronze_rows"),
                             F.sum("_s").cast("long").alias("silver_rows")))
        part = counts.select(
            F.lit(entity).alias("entity"),
            F.coalesce("bronze_rows", F.lit(0)).alias("bronze_rows"),
            F.coalesce("silver_rows", F.lit(0)).alias("silver_rows"),
            (F.coalesce("bronze_rows", F.lit(0)) - F.coalesce("silver_rows", F.lit(0))).alias("removed"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def freshness(transactions: DataFrame, as_of_values) -> DataFrame:
    """(as_of, latest, threshold, is_fresh) for each reference time in ``as_of_values``."""
    latest = transactions.agg(F.max("created_at").alias("latest"))
    refs = F.array(*[F.lit(v) for v in as_of_values])
    with_ref = latest.select(F.explode(refs).alias("as_of"), "latest")
    threshold = F.col("as_of").cast("timestamp_ntz") - F.make_interval(days=F.lit(FRESHNESS_DAYS))
    return with_ref.select(
        "as_of", "latest", threshold.alias("threshold"),
        F.coalesce(F.col("latest") > threshold, F.lit(False)).alias("is_fresh"),
    )
