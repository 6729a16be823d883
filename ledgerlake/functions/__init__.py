"""Column-level helpers: every function returns a native Spark ``Column``."""

from ledgerlake.functions.numeric import (
    exact_avg,
    exact_sum,
    exact_sum_sql,
    ratio,
    round_half_even_ratio,
    round_ratio,
)
from ledgerlake.functions.text import normalize, strip_all
from ledgerlake.functions.timefmt import iso_text, parse_timestamp, timestamp_text

__all__ = [
    "exact_avg",
    "exact_sum",
    "iso_text",
    "exact_sum_sql",
    "normalize",
    "parse_timestamp",
    "ratio",
    "round_half_even_ratio",
    "round_ratio",
    "strip_all",
    "timestamp_text",
]
