"""Access to the input tables of a scale-factor directory."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class LazyFrames(Mapping):
    """A name -> DataFrame mapping whose plans are built on first access.

    Building a plan costs analysis time on the driver; a job that needs
    one entity of a layer should not pay for the others.
    """

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

# Columns of the driver tables the Bronze derivation reads. Passing them to
# the reader skips footer sampling (a job per table) and prunes the rest.
DRIVER_COLUMNS = {
    "customer": T.StructType([
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]),
    "orders": T.StructType([
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
    ]),
    "lineitem": T.StructType([
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_partkey", T.LongType()),
        T.StructField("l_suppkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()),
    ]),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet`` as a DataFrame (lazy; columns pruned by use).

    Tables listed in ``DRIVER_COLUMNS`` are read with that fixed schema.
    """
    reader = spark.read
    if name in DRIVER_COLUMNS:
        reader = reader.schema(DRIVER_COLUMNS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
