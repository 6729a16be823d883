"""Deterministic keep-first deduplication.

``dropDuplicates`` keeps an arbitrary copy, and a ``row_number`` window sends
every copy of a key to one task. Keep-first is an aggregation instead: per
key, the minimum of a struct whose leading fields are the ordering columns.
Struct comparison is lexicographic with NULLs first, and the remaining
columns follow as the final tie-break, so the kept row is fully determined
by the data.

Because it is an aggregate, Spark runs a partial aggregation before the
shuffle: a key with millions of copies leaves each map task as one row, so a
hot key cannot pile up in a single reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FIRST = "__first"


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    copies_col: str | None = None,
) -> DataFrame:
    """One row per ``keys``: the one that sorts first by ``order`` (ascending, NULLs first).

    NULL keys form one group (like pandas ``drop_duplicates``). With
    ``copies_col`` the output also carries the number of input rows of the
    group, so the number of removed copies is ``sum(copies - 1)``.
    """
    keys = list(keys)
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    aggs = [F.min(packed).alias(_FIRST)]
    if copies_col:
        aggs.append(F.count(F.lit(1)).alias(copies_col))
    grouped = df.groupBy(*keys).agg(*aggs)
    cols = [F.col(c) if c in keys else F.col(_FIRST).getField(c).alias(c) for c in df.columns]
    if copies_col:
        cols.append(F.col(copies_col))
    return grouped.select(*cols)
