"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables of ``sf_dir`` (customer, orders,
lineitem) in full, derives the Bronze inputs from them
(``ledgerlake.sources.fixtures``) and runs one operator or layer of the
pipeline over the whole data. Queries that exercise the layer store write
under a fresh folder of the shared checkpoint location.

Run parameters are fixed so that results are reproducible: the audit
timestamp, the report timestamp, the run date and the freshness reference.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.constants import PAYMENT_METHODS, CHANNELS
from ledgerlake.functions.text import normalize
from ledgerlake.functions.timefmt import parse_timestamp
from ledgerlake.operators.integrity import orphans, require_reference
from ledgerlake.operators.rules import require_in, require_positive
from ledgerlake.plans import gold, quality, silver
from ledgerlake.plans import sql as gold_sql
from ledgerlake.operators.position import file_position
from ledgerlake.plans.medallion import gold_order, ingest_bronze, read_gold, run_medallion, run_silver
from ledgerlake.session import scratch_root
from ledgerlake.sources.fixtures import bronze_sources, details_csv, transactions_json
from ledgerlake.sources.layers import read_layer, write_layer, write_layer_counted
from ledgerlake.streaming.incremental import ingest_new_dates

RUN_DATE = "2024-01-31"
PROCESSED_AT = "2024-01-31T06:00:00"
CHECKED_AT = "2024-01-31T06:00:00"
AS_OF = "2001-12-31T00:00:00"          # newest transaction is 2001-08-01: fresh
AS_OF_LATE = "2003-01-01T00:00:00"     # more than 365 days later: stale
HISTORY_END = "1998-01-01"             # months before it are stored before the incremental load

Query = Callable[[SparkSession, str], DataFrame]


def _bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return bronze_sources(spark, sf_dir)


def _silver(spark: SparkSession, sf_dir: str, null_policy: str = "drop") -> dict[str, DataFrame]:
    return silver.build_silver(_bronze(spark, sf_dir), PROCESSED_AT, null_policy)


# --------------------------------------------------------------------------- store

def q_ingest_bronze(entity: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_root(spark, "ingest")
        ingest_bronze(spark, _bronze(spark, sf_dir), root, RUN_DATE)
        return read_layer(spark, root, "bronze", entity, RUN_DATE, schemas.BRONZE[entity])
    return run


def q_layer_roundtrip(entity: str) -> Query:
    """Write day 1 (stale), day 2, rewrite day 1 from the stored day 2; day 1 must hold only the rewrite."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_root(spark, "roundtrip")
        bronze = _bronze(spark, sf_dir)
        stale = silver.build_silver(bronze, "stale")[entity]
        fresh = silver.build_silver(bronze, PROCESSED_AT)[entity]
        write_layer(stale, root, "silver", entity, "2024-01-30")
        write_layer(fresh, root, "silver", entity, RUN_DATE)
        stored = read_layer(spark, root, "silver", entity, RUN_DATE, schemas.SILVER[entity])
        write_layer(stored, root, "silver", entity, "2024-01-30")
        return read_layer(spark, root, "silver", entity, "2024-01-30", schemas.SILVER[entity])
    return run


# One form for the rows of all three Bronze tables: id, three texts, a number, the arrival order.
_COMMON = {
    "users": ("user_id", "name", "email", "created_at", "CAST(NULL AS DOUBLE)"),
    "transactions": ("transaction_id", "user_id", "status", "created_at", "amount"),
    "transaction_details": ("detail_id", "transaction_id", "payment_method", "channel", "CAST(processing_time_ms AS DOUBLE)"),
}


def _common_rows(spark: SparkSession, root: str, layer: str, **labels: str) -> DataFrame:
    """All rows of the three tables of a stored layer, in their common form."""
    out = None
    for entity, schema in (schemas.BRONZE if layer == "bronze" else schemas.SILVER).items():
        seq = schemas.SEQ if layer == "bronze" else "CAST(NULL AS BIGINT)"
        exprs = dict(zip(("id", "text_1", "text_2", "text_3", "number", "arrival"), (*_COMMON[entity], seq)))
        exprs["text_3"] = f"CAST({exprs['text_3']} AS STRING)"
        part = read_layer(spark, root, layer, entity, RUN_DATE, schema).selectExpr(
            *[f"'{v}' AS {k}" for k, v in labels.items()], f"'{layer}' AS layer", f"'{entity}' AS entity",
            *[f"{sql} AS {name}" for name, sql in exprs.items()])
        out = part if out is None else out.unionByName(part)
    return out


def q_incremental_new_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly partitions: history first, then a full load writes only the new months."""
    root = scratch_root(spark, "incremental")
    tx = _bronze(spark, sf_dir)["transactions"].withColumn(
        "month", F.trunc(F.to_date(parse_timestamp("created_at")), "month"))
    history = tx.where(F.col("month") < F.lit(HISTORY_END).cast("date"))
    ingest_new_dates(spark, history, root, "bronze", "transactions_by_month", "month")
    done = ingest_new_dates(spark, tx, root, "bronze", "transactions_by_month", "month")
    stored = spark.read.schema(schemas.with_date(schemas.BRONZE["transactions"])).parquet(
        f"{root}/bronze/transactions_by_month")
    # All stored rows, with what the second load says it wrote or skipped of their month.
    said = spark.createDataFrame(
        [(d, True, n) for d, n in done.written.items()] + [(d, False, n) for d, n in done.skipped_stored.items()],
        "day string, is_new boolean, loaded_rows long")
    return stored.join(said, F.col(schemas.DATE) == F.col("day").cast("date"), "left").drop("day")


def q_rerun_with_empty_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forced re-run whose details source is empty replaces the stored day; all rows of Bronze and Silver."""
    root = scratch_root(spark, "rerun")
    bronze = dict(_bronze(spark, sf_dir))
    args = {"as_of": AS_OF, "processed_at": PROCESSED_AT, "checked_at": CHECKED_AT}
    run_medallion(spark, bronze, root, RUN_DATE, **args)
    bronze["transaction_details"] = bronze["transaction_details"].limit(0)
    run_medallion(spark, bronze, root, RUN_DATE, force=True, **args)
    return _common_rows(spark, root, "bronze").unionByName(_common_rows(spark, root, "silver"))


def q_all_rejected_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day whose users all lack a required field: the run ends, and the stored rejects say why."""
    root = scratch_root(spark, "rejected")
    bronze = dict(_bronze(spark, sf_dir))
    bronze["users"] = bronze["users"].withColumn("email", F.lit(None).cast("string"))
    run_medallion(spark, bronze, root, RUN_DATE, as_of=AS_OF, processed_at=PROCESSED_AT, checked_at=CHECKED_AT)
    return read_layer(spark, root, "silver", "rejects", RUN_DATE)


def q_skip_and_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load of a landed day is skipped; with ``force`` it replaces the day. All stored rows after each.

    The second source is the whole one with its ids marked. Each step is a copy of its own, so
    that its rows can still be read.
    """
    bronze = _bronze(spark, sf_dir)
    marked = {e: df.withColumn(df.columns[0], F.concat(F.col(df.columns[0]), F.lit("x"))) for e, df in bronze.items()}
    out = None
    for step, loads in (("first", ((bronze, False),)), ("skipped", ((bronze, False), (marked, False))),
                        ("forced", ((bronze, False), (marked, False), (marked, True)))):
        root = scratch_root(spark, "force")
        for source, force in loads:
            ingest_bronze(spark, source, root, RUN_DATE, force)
        rows = _common_rows(spark, root, "bronze", step=step)
        out = rows if out is None else out.unionByName(rows)
    return out


def _landed_text(spark: SparkSession, sf_dir: str) -> str:
    """Root of a store whose transactions came as JSON lines and whose details came as CSV, some of them broken."""
    root, text = scratch_root(spark, "text"), scratch_root(spark, "text-in")
    bronze = _bronze(spark, sf_dir)
    ingest_bronze(spark, {
        "users": bronze["users"],
        "transactions": transactions_json(bronze["transactions"], f"{text}/transactions"),
        "transaction_details": details_csv(bronze["transaction_details"], f"{text}/details")}, root, RUN_DATE)
    return root


def q_landed_text(entity: str) -> Query:
    """Bronze rows of an entity landed from text, with their place of arrival; malformed lines are not among them."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return read_layer(spark, _landed_text(spark, sf_dir), "bronze", entity, RUN_DATE, schemas.BRONZE[entity])
    return run


def q_text_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of a day landed from text: malformed lines are a rule of their own."""
    root = _landed_text(spark, sf_dir)
    run_silver(spark, root, RUN_DATE, PROCESSED_AT)
    return read_layer(spark, root, "silver", "rejects", RUN_DATE)


def q_sorted_write_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a sorted write of unsorted frames reports, beside the rows read back; (table, reported, stored)."""
    root = scratch_root(spark, "sorted")
    tables = _silver(spark, sf_dir)
    frames = {"users": (tables["users"], ["email", "user_id"]),
              "transactions": (tables["transactions"], ["amount", "transaction_id"]),
              "gold_user_metrics": (gold.gold_user_metrics(tables["users"], tables["transactions"]), None)}
    out = None
    for name, (df, order) in frames.items():
        order = gold_order(name) if order is None else [F.col(c) for c in order]
        _, reported = write_layer_counted(df, root, "sorted", name, RUN_DATE, order)
        row = read_layer(spark, root, "sorted", name, RUN_DATE, df.schema).agg(F.count(F.lit(1)).alias("stored")).select(
            F.lit(name).alias("table_name"), F.lit(reported).cast("long").alias("reported"), "stored")
        out = row if out is None else out.unionByName(row)
    return out


def q_layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _bronze(spark, sf_dir)
    slv = silver.build_silver(bronze, PROCESSED_AT)
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count"))
          .select(F.lit(layer).alias("layer"), F.lit(entity).alias("entity"), "row_count")
        for layer, tables in (("bronze", bronze), ("silver", slv))
        for entity, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --------------------------------------------------------------------------- operators

def q_dedup(entity: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return silver.dedupe(entity, _bronze(spark, sf_dir)[entity])
    return run


def q_required_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.users_valid(_bronze(spark, sf_dir)["users"])


def q_positive_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return require_positive(silver.dedupe("transactions", _bronze(spark, sf_dir)["transactions"]), "amount")


def q_valid_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.transactions_candidates(_bronze(spark, sf_dir)["transactions"])


def _details_with_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _silver(spark, sf_dir)
    return silver.details_with_transaction(_bronze(spark, sf_dir)["transaction_details"], s["transactions"])


def q_valid_payment_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    return require_in(_details_with_tx(spark, sf_dir), "payment_method", PAYMENT_METHODS)


def q_valid_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = require_in(_details_with_tx(spark, sf_dir), "payment_method", PAYMENT_METHODS)
    return require_in(df, "channel", CHANNELS)


def q_positive_processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _silver(spark, sf_dir)
    return silver.details_valid(_bronze(spark, sf_dir)["transaction_details"], s["transactions"])


def q_normalize_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = silver.dedupe("transactions", _bronze(spark, sf_dir)["transactions"])
    return df.select("transaction_id", normalize("status").alias("status"))


def q_parse_created_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = silver.dedupe("transactions", _bronze(spark, sf_dir)["transactions"])
    return df.select("transaction_id", parse_timestamp("created_at").alias("created_at"))


def q_fill_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _silver(spark, sf_dir)
    return silver.details_valid(_bronze(spark, sf_dir)["transaction_details"], s["transactions"], "unknown")


def q_semi_valid_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _bronze(spark, sf_dir)
    users = silver.clean_users(b["users"], PROCESSED_AT)
    return require_reference(silver.transactions_candidates(b["transactions"]), users, "user_id")


def q_semi_valid_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _details_with_tx(spark, sf_dir)


def q_orphan_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _bronze(spark, sf_dir)
    users = silver.clean_users(b["users"], PROCESSED_AT)
    return orphans(silver.transactions_candidates(b["transactions"]), users, "user_id")


def q_orphan_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _bronze(spark, sf_dir)
    s = silver.build_silver(b, PROCESSED_AT)
    return orphans(silver.dedupe("transaction_details", b["transaction_details"]), s["transactions"],
                   "transaction_id")


def q_silver(entity: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _silver(spark, sf_dir)[entity]
    return run


def q_silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _bronze(spark, sf_dir)
    s = silver.build_silver(b, PROCESSED_AT)
    return silver.silver_rejects(b, s["users"], s["transactions"])


# --------------------------------------------------------------------------- gold

def q_success_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.success_rate_by_month(_silver(spark, sf_dir)["transactions"])


def q_gold(name: str) -> Query:
    """A Gold table (or its per-transaction form) from Bronze in one plan."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return gold.gold_from_bronze(_bronze(spark, sf_dir), with_generated_at=False)[name]
    return run


def q_gold_sql(name: str) -> Query:
    """A Gold table from its SQL text over the registered Silver views."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        gold_sql.register_views(_silver(spark, sf_dir))
        df = gold_sql.gold_sql(spark, name)
        return df.drop("generated_at") if "generated_at" in df.columns else df
    return run


def _stored_run(spark: SparkSession, sf_dir: str) -> tuple[str, dict]:
    root = scratch_root(spark, "stored")
    result = run_medallion(spark, _bronze(spark, sf_dir), root, RUN_DATE, as_of=AS_OF,
                           processed_at=PROCESSED_AT, checked_at=CHECKED_AT)
    return root, result


def q_stored_gold_user_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job (Bronze -> Silver -> Gold -> report) through the store; Gold read back."""
    root, _ = _stored_run(spark, sf_dir)
    return read_gold(spark, root, "gold_user_metrics", RUN_DATE)


def q_stored_order(name: str) -> Query:
    """A Gold table as stored by the whole job, each row with its place in the stored files."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, _ = _stored_run(spark, sf_dir)
        return file_position(read_gold(spark, root, name, RUN_DATE))
    return run


def _sevenths(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Bronze whose amounts are sevenths: doubles with as many decimals as they have room for."""
    bronze = dict(_bronze(spark, sf_dir))
    bronze["transactions"] = bronze["transactions"].withColumn("amount", F.col("amount") / 7)
    return bronze


def q_fine_amounts_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums and averages of amounts with many decimals, to six decimals."""
    m = gold.gold_from_bronze(_sevenths(spark, sf_dir))["gold_user_metrics"]
    return m.select("user_id", F.round("total_amount", 6).alias("total_amount"), F.round("avg_amount", 6).alias("avg_amount"))


def q_fine_amounts_per_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = gold.gold_from_bronze(_sevenths(spark, sf_dir))["gold_channel_metrics"]
    return m.select("channel", F.round("total_amount", 3).alias("total_amount"), F.round("avg_amount", 6).alias("avg_amount"))


def q_stored_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job through the store; the CSV quality report read back."""
    _, result = _stored_run(spark, sf_dir)
    return spark.read.schema(schemas.QUALITY_REPORT).option("header", True).csv(result["quality"]["path"])


# --------------------------------------------------------------------------- quality

def q_null_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _bronze(spark, sf_dir)
    return (quality.null_counts(b["users"], "users", quality.USER_NULL_COLS)
            .unionByName(quality.null_counts(b["transactions"], "transactions", quality.TX_NULL_COLS)))


def q_duplicate_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _bronze(spark, sf_dir)
    return (quality.duplicate_counts(b["users"], "users", "user_id")
            .unionByName(quality.duplicate_counts(b["transactions"], "transactions", "transaction_id"))
            .unionByName(quality.duplicate_counts(b["transaction_details"], "transaction_details",
                                                  "detail_id")))


def q_traceability(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _bronze(spark, sf_dir)
    s = silver.build_silver(b, PROCESSED_AT)
    return quality.traceability({e: (b[e], s[e]) for e in b})


def q_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.freshness(_silver(spark, sf_dir)["transactions"], [AS_OF, AS_OF_LATE])


def _report_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _bronze(spark, sf_dir)
    s = silver.build_silver(b, PROCESSED_AT)
    return quality.quality_report(s["users"], s["transactions"], s["transaction_details"],
                                  b["transactions"], b["transaction_details"], AS_OF, CHECKED_AT)


def _report_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _bronze(spark, sf_dir)
    return quality.quality_report(b["users"], b["transactions"], b["transaction_details"],
                                  b["transactions"], b["transaction_details"], AS_OF, CHECKED_AT)


def q_quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_summary(_report_raw(spark, sf_dir))


def q_quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate's outcome and message for a report that passes (Silver), one that is stale, and one that fails (raw)."""
    b = _bronze(spark, sf_dir)
    s = silver.build_silver(b, PROCESSED_AT)
    reports = {
        "silver": _report_silver(spark, sf_dir),
        "stale": quality.quality_report(s["users"], s["transactions"], s["transaction_details"],
                                        b["transactions"], b["transaction_details"], AS_OF_LATE, CHECKED_AT),
        "raw": _report_raw(spark, sf_dir),
    }
    out = None
    for name, report in reports.items():
        row = quality.gate_result(report).select(F.lit(name).alias("report"), "*")
        out = row if out is None else out.unionByName(row)
    return out


QUERIES: dict[str, Query] = {
    "ingest_bronze": q_ingest_bronze("transactions"),
    "ingest_bronze_users": q_ingest_bronze("users"),
    "ingest_bronze_details": q_ingest_bronze("transaction_details"),
    "layer_roundtrip": q_layer_roundtrip("users"),
    "layer_roundtrip_transactions": q_layer_roundtrip("transactions"),
    "layer_roundtrip_details": q_layer_roundtrip("transaction_details"),
    "landed_json_transactions": q_landed_text("transactions"),
    "landed_csv_details": q_landed_text("transaction_details"),
    "text_rejects": q_text_rejects,
    "sorted_write_counts": q_sorted_write_counts,
    "incremental_new_dates": q_incremental_new_dates,
    "rerun_with_empty_entity": q_rerun_with_empty_entity,
    "all_rejected_day": q_all_rejected_day,
    "skip_and_force": q_skip_and_force,
    "layer_counts": q_layer_counts,
    "dedup_users": q_dedup("users"),
    "dedup_transactions": q_dedup("transactions"),
    "dedup_details": q_dedup("transaction_details"),
    "required_not_null": q_required_not_null,
    "positive_amount": q_positive_amount,
    "valid_status": q_valid_status,
    "valid_payment_method": q_valid_payment_method,
    "valid_channel": q_valid_channel,
    "positive_processing_time": q_positive_processing_time,
    "normalize_status": q_normalize_status,
    "parse_created_at": q_parse_created_at,
    "fill_unknown": q_fill_unknown,
    "semi_valid_user": q_semi_valid_user,
    "semi_valid_transaction": q_semi_valid_transaction,
    "orphan_transactions": q_orphan_transactions,
    "orphan_details": q_orphan_details,
    "silver_users": q_silver("users"),
    "silver_transactions": q_silver("transactions"),
    "silver_transaction_details": q_silver("transaction_details"),
    "silver_rejects": q_silver_rejects,
    "success_rate": q_success_rate,
    "gold_user_metrics": q_gold("gold_user_metrics"),
    "gold_channel_metrics": q_gold("gold_channel_metrics"),
    "gold_payment_method_metrics": q_gold("gold_payment_method_metrics"),
    "gold_summary": q_gold("gold_summary"),
    "channel_metrics_per_tx": q_gold("channel_metrics_per_tx"),
    "summary_per_tx": q_gold("summary_per_tx"),
    "gold_user_metrics_sql": q_gold_sql("gold_user_metrics"),
    "gold_channel_metrics_sql": q_gold_sql("gold_channel_metrics"),
    "gold_payment_method_metrics_sql": q_gold_sql("gold_payment_method_metrics"),
    "gold_summary_sql": q_gold_sql("gold_summary"),
    "stored_gold_user_metrics": q_stored_gold_user_metrics,
    "stored_order_user_metrics": q_stored_order("gold_user_metrics"),
    "stored_order_channel": q_stored_order("gold_channel_metrics"),
    "stored_order_payment_method": q_stored_order("gold_payment_method_metrics"),
    "stored_quality_report": q_stored_quality_report,
    "fine_amounts_per_user": q_fine_amounts_per_user,
    "fine_amounts_per_channel": q_fine_amounts_per_channel,
    "quality_gate": q_quality_gate,
    "null_checks": q_null_checks,
    "duplicate_count": q_duplicate_count,
    "traceability": q_traceability,
    "freshness": q_freshness,
    "quality_report_silver": _report_silver,
    "quality_report_raw": _report_raw,
    "quality_summary": q_quality_summary,
}
