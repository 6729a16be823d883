"""Referential integrity between a child and a parent table.

Semi and anti joins leave the join algorithm to Catalyst and AQE: a parent
whose measured size at runtime is under ``spark.sql.autoBroadcastJoinThreshold``
is broadcast, anything larger goes through a sort-merge join, and AQE splits
a skewed child partition. A NULL foreign key never references a parent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _parent_keys(parent: DataFrame, key: str, parent_key: str | None) -> DataFrame:
    pk = parent_key or key
    return parent.select(F.col(pk).alias(key))


def require_reference(df: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` exists in ``parent`` (LEFT SEMI); columns keep their order."""
    return df.join(_parent_keys(parent, key, parent_key), on=key, how="left_semi").select(*df.columns)


def orphans(df: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` is NULL or missing from ``parent`` (LEFT ANTI)."""
    return df.join(_parent_keys(parent, key, parent_key), on=key, how="left_anti").select(*df.columns)


def reference_flag(
    df: DataFrame, parent: DataFrame, key: str, flag: str, parent_key: str | None = None
) -> DataFrame:
    """``df`` plus a boolean ``flag``: does ``key`` exist in ``parent``.

    The parent keys are reduced to distinct values first (partial aggregation
    before the shuffle), so the left join never multiplies child rows.
    """
    keys = _parent_keys(parent, key, parent_key).where(F.col(key).isNotNull()).distinct()
    marked = keys.withColumn(flag, F.lit(True))
    return (df.join(marked, on=key, how="left")
              .select(*df.columns, F.coalesce(F.col(flag), F.lit(False)).alias(flag)))
