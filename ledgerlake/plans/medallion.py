"""Layer jobs and the end-to-end run: Bronze -> Silver -> Gold -> quality.

Each layer is written and read back before the next one starts, as in any
medallion layout: the next layer's plan starts from Parquet (fresh
statistics for AQE, no lineage to recompute after a lost executor), and a
layer can be re-run on its own for a given ``run_date``.

Row counts are those of the files written (``sources.layers``).
"""

from __future__ import annotations

from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.constants import ENTITIES
from ledgerlake.operators.position import file_position, has_file_positions
from ledgerlake.plans.gold import gold_from_facts, transaction_facts, user_activity
from ledgerlake.plans.quality import assert_quality, quality_report, quality_summary, write_report_csv
from ledgerlake.plans.silver import accepted, classify, rejects_of
from ledgerlake.schemas import SEQ
from ledgerlake.session import scratch_root, side_by_side
from ledgerlake.sources.layers import (
    delete_folder,
    layer_path,
    partition_exists,
    read_layer,
    read_manifest,
    write_layer,
    write_layer_counted,
)
from ledgerlake.sources.text import TextSource, malformed, well_formed


def with_arrival_order(df: DataFrame) -> DataFrame:
    """Add ``_seq`` (arrival order) when the source has none.

    Rows read from files arrive in the order of their files and of their places there, however
    the scan is split; other sources in the order of their partitions. It is materialised in Bronze once.
    """
    if SEQ in df.columns:
        return df
    if has_file_positions(df):
        return file_position(df, SEQ, start=0)
    return df.withColumn(SEQ, F.monotonically_increasing_id())


def malformed_table(entity: str) -> str:
    """Bronze table of the lines of a text source that did not fit the schema."""
    return f"{entity}_malformed"


def _land(spark: SparkSession, source: DataFrame | TextSource, root: str, entity: str, run_date: str) -> int:
    """Write one source as the ``run_date`` partition of Bronze, malformed lines beside it; the rows landed."""
    bad = malformed_table(entity)
    if isinstance(source, TextSource):
        folder = scratch_root(spark, "lines")
        lines = source.load(spark, schemas.BRONZE[entity], folder)
        write_layer(malformed(lines), root, "bronze", bad, run_date)
        _, rows = write_layer_counted(well_formed(lines), root, "bronze", entity, run_date)
        delete_folder(spark, folder)
        return rows
    if partition_exists(spark, root, "bronze", bad, run_date):  # of an earlier landing from text
        write_layer(spark.createDataFrame([], f"line string, {SEQ} long"), root, "bronze", bad, run_date)
    return write_layer_counted(with_arrival_order(source), root, "bronze", entity, run_date)[1]


def ingest_bronze(
    spark: SparkSession,
    sources: dict[str, DataFrame | TextSource],
    root: str,
    run_date: str | None = None,
    force: bool = False,
) -> dict:
    """Land the sources as the ``run_date`` partition of Bronze.

    Incremental: when every entity already has that partition and ``force``
    is false, nothing is read or written. Any DataFrame is a valid source
    (``spark.read.parquet/jdbc`` ...); a ``TextSource`` names CSV or JSON text, whose
    malformed lines go to ``bronze/<entity>_malformed``.
    """
    run_date = run_date or date.today().isoformat()
    paths = {e: layer_path(root, "bronze", e) for e in sources}
    if not force and all(partition_exists(spark, root, "bronze", e, run_date) for e in sources):
        return {"paths": paths, "counts": {"skipped": True}, "incremental": True}
    plans = dict(sources.items())  # all of them are built before the first job
    counts = side_by_side({e: partial(_land, spark, source, root, e, run_date) for e, source in plans.items()})
    return {"paths": paths, "counts": counts, "incremental": False}


def load_layer(spark: SparkSession, root: str, layer: str, run_date: str) -> dict[str, DataFrame]:
    table_schemas = schemas.BRONZE if layer == "bronze" else schemas.SILVER
    return {e: read_layer(spark, root, layer, e, run_date, table_schemas[e]) for e in ENTITIES}


def malformed_counts(spark: SparkSession, root: str, run_date: str) -> dict[str, int]:
    """Malformed lines per entity that was landed from text on ``run_date`` (from the manifests)."""
    found = {e: read_manifest(spark, root, "bronze", malformed_table(e), run_date) for e in ENTITIES}
    return {e: m.rows for e, m in found.items() if m is not None}


def run_silver(
    spark: SparkSession,
    root: str,
    run_date: str,
    processed_at: str | None = None,
    null_policy: str = "drop",
) -> dict:
    """Clean Bronze into Silver; users first, each parent read back from Silver.

    The deduplicated rows of an entity are stored once with the rule that each fails: the
    Silver rows and the reject counts both come from there.
    """
    bronze = load_layer(spark, root, "bronze", run_date)
    folder = scratch_root(spark, "classified")
    counts, paths, classified, parent = {}, {}, {}, None
    for entity in ENTITIES:
        rows = classify(entity, bronze[entity], parent, null_policy)
        rows.write.parquet(f"{folder}/{entity}")
        classified[entity] = spark.read.schema(rows.schema).parquet(f"{folder}/{entity}")
        paths[entity], counts[entity] = write_layer_counted(
            accepted(entity, classified[entity], processed_at), root, "silver", entity, run_date)
        parent = read_layer(spark, root, "silver", entity, run_date, schemas.SILVER[entity])
    # Rows removed per rule: a stored table (a few rows), exact whatever tasks were repeated.
    write_layer(rejects_of(classified, malformed_counts(spark, root, run_date)),
                root, "silver", "rejects", run_date, bounded=True)
    delete_folder(spark, folder)
    rejects: dict[str, dict] = {e: {} for e in ENTITIES}
    for r in read_layer(spark, root, "silver", "rejects", run_date).collect():
        rejects[r["entity"]][r["rule"]] = int(r["rejected"])
    return {"paths": paths, "counts": counts, "rejects": rejects}


def gold_order(name: str) -> list | None:
    """Stored order of each Gold table (the ORDER BY of its definition, key as tie-break)."""
    return {
        "gold_user_metrics": lambda: [F.desc_nulls_last("total_amount"), F.asc("user_id")],
        "gold_channel_metrics": lambda: [F.desc("total_amount"), F.asc("channel")],
        "gold_payment_method_metrics": lambda: [F.desc("total_transactions"), F.asc("payment_method")],
        "gold_summary": lambda: None,
    }[name]()


# Gold tables with one row per domain value (channel, payment method) or a
# single row: their size does not grow with the data.
BOUNDED_GOLD = ("gold_channel_metrics", "gold_payment_method_metrics", "gold_summary")


def run_gold(spark: SparkSession, root: str, run_date: str) -> dict:
    """Build the four Gold tables from Silver and write them (sorted as specified).

    The details are read, folded per transaction and joined with the transactions once, the
    transactions folded per user once: both are stored (``gold/transaction_facts``,
    ``gold/user_activity``) and the four tables come from them, at every input size.
    """
    silver = load_layer(spark, root, "silver", run_date)
    tx = silver["transactions"]
    made = {"transaction_facts": transaction_facts(tx, silver["transaction_details"]), "user_activity": user_activity(tx)}
    side_by_side({name: partial(write_layer_counted, df, root, "gold", name, run_date) for name, df in made.items()})
    shared = {name: read_layer(spark, root, "gold", name, run_date, df.schema) for name, df in made.items()}
    tables = gold_from_facts(silver["users"], tx, shared["transaction_facts"], activity=shared["user_activity"])
    # The writer's own ordering (partition column first) replaces the
    # plan's ORDER BY, so the order is passed to it explicitly.
    written = side_by_side({
        name: partial(write_layer_counted, df, root, "gold", name, run_date, gold_order(name), bounded=name in BOUNDED_GOLD)
        for name, df in tables.items()})
    paths, counts = {n: path for n, (path, _) in written.items()}, {n: rows for n, (_, rows) in written.items()}
    return {"paths": paths, "counts": counts}


def read_gold(spark: SparkSession, root: str, name: str, run_date: str) -> DataFrame:
    return read_layer(spark, root, "gold", name, run_date, schemas.GOLD[name])


def run_quality(
    spark: SparkSession,
    root: str,
    run_date: str,
    as_of: str | None = None,
    checked_at: str | None = None,
    gate: bool = False,
) -> dict:
    """Run the 18 checks on the stored layers, write the CSV report, return the summary."""
    bronze = load_layer(spark, root, "bronze", run_date)
    silver = load_layer(spark, root, "silver", run_date)
    report = quality_report(
        silver["users"], silver["transactions"], silver["transaction_details"],
        bronze["transactions"], bronze["transaction_details"], as_of=as_of, checked_at=checked_at)
    # One report per run: without a given report time, the run's own time names it.
    stamp = (checked_at or datetime.now().isoformat(timespec="microseconds")).replace(":", "").replace("-", "").replace(" ", "_").replace(".", "_")
    path = write_report_csv(report, f"{root.rstrip('/')}/quality/report_{stamp}")
    stored = spark.read.schema(schemas.QUALITY_REPORT).option("header", True).csv(path)
    if gate:
        summary = assert_quality(stored)
    else:
        summary = quality_summary(stored).first().asDict()
    return {"path": path, "summary": summary}


def run_medallion(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    root: str,
    run_date: str | None = None,
    as_of: str | None = None,
    force: bool = False,
    gate: bool = False,
    processed_at: str | None = None,
    checked_at: str | None = None,
    null_policy: str = "drop",
) -> dict:
    """Bronze -> Silver -> Gold -> quality for one ``run_date``.

    With ``gate=True`` a failed check raises ``QualityGateError`` after the
    report is written (the scheduler's retry/alert hook).
    """
    run_date = run_date or date.today().isoformat()
    bronze = ingest_bronze(spark, sources, root, run_date, force)
    silver = run_silver(spark, root, run_date, processed_at, null_policy)
    done = side_by_side({  # both read Bronze and Silver only
        "gold": partial(run_gold, spark, root, run_date),
        "quality": partial(run_quality, spark, root, run_date, as_of, checked_at, gate)})
    return {"bronze": bronze, "silver": silver, **done, "run_date": run_date}
