"""Timestamp parsing and the text forms used in reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.constants import MSG_NO_TIMESTAMP


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_timestamp(col: Column | str) -> Column:
    """ISO-8601 text to TIMESTAMP_NTZ.

    With and without fractional seconds are both accepted; under ANSI mode
    (the Spark 4 default) malformed text fails the job instead of turning into
    NULL.
    """
    return F.to_timestamp_ntz(_c(col))


def _micros(ts: Column) -> Column:
    return F.date_format(ts, "SSSSSS")


def timestamp_text(col: Column | str) -> Column:
    """'yyyy-MM-dd HH:mm:ss[.ffffff]', fraction only when non-zero; NULL -> 'NaT'."""
    ts = _c(col)
    frac = F.when(_micros(ts) != "000000", F.concat(F.lit("."), _micros(ts))).otherwise(F.lit(""))
    return F.coalesce(F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), frac), F.lit(MSG_NO_TIMESTAMP))


def iso_text(col: Column | str) -> Column:
    """ISO-8601 text with a 'T' separator, fraction only when non-zero."""
    ts = _c(col)
    frac = F.when(_micros(ts) != "000000", F.concat(F.lit("."), _micros(ts))).otherwise(F.lit(""))
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), frac)
