"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.constants import WHITESPACE

ASCII_WHITESPACE = "".join(ch for ch in WHITESPACE if ch.isascii())


def strip_all(col: Column | str) -> Column:
    """Remove every whitespace code point from both ends.

    ``F.trim`` removes only the space character; a value such as
    ``"\\tFailed\\n"`` must come out as ``"Failed"``, so the trim set is the
    full whitespace class. A string of ASCII characters alone, as most are, is held against
    the ASCII part of the class only: trimming compares each end with every member.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.octet_length(c) == F.length(c), F.btrim(c, F.lit(ASCII_WHITESPACE))).otherwise(
        F.btrim(c, F.lit(WHITESPACE)))


def normalize(col: Column | str) -> Column:
    """Lower-case, then strip (the cleaning applied to every coded field)."""
    return strip_all(F.lower(F.col(col) if isinstance(col, str) else col))
