"""Incremental loads.

* ``already_processed``: has a date been landed for every entity (the daily
  skip test).
* ``new_dates`` / ``ingest_new_dates``: for a source spanning many dates,
  only the dates not yet stored are written (dynamic partition overwrite
  touches nothing else); what is left out is counted.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.schemas import DATE
from ledgerlake.sources.layers import forget_versions, layer_path, partition_exists, stored_dates


def already_processed(spark: SparkSession, root: str, run_date: str, entities: Iterable[str],
                      layer: str = "bronze") -> bool:
    """True when every entity has the ``run_date`` partition in ``layer``."""
    return all(partition_exists(spark, root, layer, e, run_date) for e in entities)


def new_dates(incoming: DataFrame, stored: DataFrame, date_col: str = DATE) -> DataFrame:
    """Distinct ``date_col`` values of ``incoming`` that are not in ``stored``."""
    dates = incoming.select(F.col(date_col).alias(DATE)).where(F.col(DATE).isNotNull()).distinct()
    return dates.join(stored.select(DATE), DATE, "left_anti")


@dataclass(frozen=True)
class IngestResult:
    """What an incremental load did: rows per written date, and the rows it left out."""

    written: dict[str, int]
    skipped_stored: dict[str, int]
    skipped_null_date: int


def ingest_new_dates(
    spark: SparkSession,
    incoming: DataFrame,
    root: str,
    layer: str,
    entity: str,
    date_col: str = DATE,
    force: bool | Iterable[str] = False,
) -> IngestResult:
    """Write the rows of ``incoming`` whose date is not stored yet.

    ``force``: True writes every date again, an iterable of dates writes those
    again. A first pass over the date column alone counts rows per date (one
    number per date reaches the driver); the second keeps only the dates to write,
    by a literal filter (it reaches the scan where the date is a stored column). Rows of dates already
    stored and rows without a date are not written but counted in the result.
    """
    day = F.col(date_col).cast("date")
    per_date = {None if r[0] is None else r[0].isoformat(): r[1]
                for r in incoming.groupBy(day.alias(DATE)).agg(F.count(F.lit(1))).collect()}
    null_rows = per_date.pop(None, 0)
    stored = {r[0].isoformat() for r in stored_dates(spark, root, layer, entity).collect()}
    again = set(per_date) if force is True else set(force or ())
    dates = sorted(d for d in per_date if d not in stored or d in again)
    if dates:
        rows = incoming.where(day.isin([date.fromisoformat(d) for d in dates])).withColumn(DATE, day)
        if date_col != DATE:
            rows = rows.drop(date_col)
        # Rebalance (not repartition) by date: rows of a date are grouped into
        # few files, and AQE splits a date holding a large share of the rows
        # over several tasks instead of sending it to one.
        (rows.hint("rebalance", DATE)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(DATE).parquet(layer_path(root, layer, entity)))
        for d in dates:
            forget_versions(spark, root, layer, entity, d)
    return IngestResult({d: per_date[d] for d in dates},
                        {d: n for d, n in sorted(per_date.items()) if d not in dates}, null_rows)
