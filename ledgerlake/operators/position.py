"""Places of rows in files: arrival order, and the order a sorted table was stored in.

Spark's partitions are no order of arrival: the same files read with another split
size, or packed into other partitions, give other row numbers. What stays is
where a row lies: its file, and its place in that file. ``file_position`` numbers rows by
that, 1, 2, ... over the files in the order of their paths, whatever the splits.
The places per file (or per block of a text file) are summed up first; that pass reads no
data column of Parquet files, and one row per file or block is all that is gathered.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_PATH, _BLOCK, _AT = "__path", "__block", "__at"


def _hidden_columns(df: DataFrame) -> list[str]:
    """What the files behind ``df`` tell about a row; nothing if it is not read from files."""
    try:
        return df.select("_metadata").schema["_metadata"].dataType.names
    except AnalysisException:
        return []


def has_file_positions(df: DataFrame) -> bool:
    """Is ``df`` read from files (with projections, filters or explodes above the scan at most)?"""
    return "file_path" in _hidden_columns(df)


def _placed(df: DataFrame) -> DataFrame:
    """``df`` with its file, its block there and a number that grows within the block."""
    if "row_index" in _hidden_columns(df):  # Parquet: the row's place in the whole file
        at = {_BLOCK: F.lit(0).cast("long"), _AT: F.col("_metadata.row_index")}
    else:  # text: splits of a file begin at these bytes, and a task reads a split from front to back
        at = {_BLOCK: F.col("_metadata.file_block_start"), _AT: F.monotonically_increasing_id()}
    return df.withColumns({_PATH: F.col("_metadata.file_path"), **at})


def file_position(df: DataFrame, name: str = "position", start: int = 1,
                  store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``df`` with ``name``: the place of each row over all its files in path order, from ``start``.

    ``df`` must be read from files (``has_file_positions``) in one scan. Without filters the
    places have no gaps; filtered rows leave gaps (Parquet), and rows exploded from one
    row share its place (Parquet). The order is the same for all splits of the files.
    ``store`` writes and rereads the rows with their places, so that they are read
    once; text should be (which lines a text scan counts depends on the columns it reads).
    """
    placed = store(_placed(df)) if store else _placed(df)
    blocks = placed.groupBy(_PATH, _BLOCK).agg((F.max(_AT) - F.min(_AT) + 1).alias("__n"), F.min(_AT).alias("__first"))
    # One row per file or block, as many as the driver lists to plan the scan.
    before = F.sum("__n").over(Window.orderBy(_PATH, _BLOCK).rowsBetween(Window.unboundedPreceding, -1))
    starts = blocks.select(F.col(_PATH).alias("__p"), F.col(_BLOCK).alias("__b"),
                           (F.coalesce(before, F.lit(0)) + start - F.col("__first")).alias("__shift"))
    # Broadcast, so that the rows stay where they are: shuffled by file, a large file would be one task's.
    joined = placed.join(F.broadcast(starts), (F.col(_PATH) == F.col("__p")) & (F.col(_BLOCK) == F.col("__b")))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c != name],
                         (F.col("__shift") + F.col(_AT)).cast("long").alias(name))
