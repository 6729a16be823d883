"""Lineage columns appended to every Silver table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.constants import SOURCE_BRONZE
from ledgerlake.functions.timefmt import iso_text
from ledgerlake.schemas import PROCESSED_AT, SOURCE


def stamp(df: DataFrame, processed_at: str | None = None, source: str = SOURCE_BRONZE) -> DataFrame:
    """Add ``_silver_processed_at`` (ISO text) and ``_source``.

    Pass ``processed_at`` for a reproducible run; by default it is the
    query's start time, identical on every row.
    """
    ts = F.lit(processed_at) if processed_at is not None else iso_text(F.localtimestamp())
    return df.withColumns({PROCESSED_AT: ts, SOURCE: F.lit(source)})
