"""Row-level validation rules: predicates and the filters built on them.

Each rule exists twice: a predicate (``Column``, never NULL) for counting
rejects or failing checks, and a filter that keeps the rows where the
predicate holds.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.constants import UNKNOWN
from ledgerlake.functions.text import normalize


def _is_fractional(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType))


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL (or NaN, for floating columns) in any of ``cols``.

    An empty string is a value, not a missing one, and is kept.
    """
    return df.na.drop(how="any", subset=list(cols))


def is_positive(df: DataFrame, col: str) -> Column:
    """``col > 0``; NULL and NaN are not positive."""
    c = F.col(col)
    cond = c > 0
    if _is_fractional(df, col):
        cond = cond & ~F.isnan(c)
    return F.coalesce(cond, F.lit(False))


def require_positive(df: DataFrame, col: str) -> DataFrame:
    return df.where(is_positive(df, col))


def in_domain(col: Column | str, domain: Iterable[str]) -> Column:
    """Membership that treats NULL as outside the domain (never NULL itself)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.isin(*list(domain)), F.lit(False))


def normalize_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Lower-case and strip every column in ``cols``."""
    return df.withColumns({c: normalize(c) for c in cols})


def require_in(
    df: DataFrame,
    col: str,
    domain: Sequence[str],
    null_policy: str = "drop",
    normalize_first: bool = True,
) -> DataFrame:
    """Normalise ``col`` and keep rows whose value is in ``domain``.

    ``null_policy="drop"`` drops missing values with the rest of the invalid
    ones; ``"unknown"`` first replaces a missing value by ``"unknown"`` and
    accepts it.
    """
    if null_policy not in ("drop", "unknown"):
        raise ValueError(f"null_policy must be 'drop' or 'unknown', not {null_policy!r}")
    value = normalize(col) if normalize_first else F.col(col)
    allowed = list(domain)
    if null_policy == "unknown":
        value = F.coalesce(value, F.lit(UNKNOWN))
        allowed.append(UNKNOWN)
    return df.withColumn(col, value).where(in_domain(col, allowed))
