"""Text sources with a fixed schema: CSV with a header and JSON lines.

A line that does not fit the schema (a value of another type, too few or too many fields,
broken JSON) does not become a row with holes: it is kept as text in a column of
its own, so that it can be stored, counted and looked at.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.position import file_position
from ledgerlake.schemas import SEQ

MALFORMED = "_malformed"
FORMATS = ("csv", "json")

# Text as it stands: no trimming, an empty unquoted field is NULL. One line is one record.
CSV_OPTIONS = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
               "emptyValue": "", "nullValue": ""}


def read_text(spark: SparkSession, fmt: str, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """The lines of ``path`` by ``schema``, with ``_malformed``: the whole line where it does not fit, else NULL.

    ``options`` go to Spark's reader (a CSV file is taken to have a header). A malformed line has
    NULL or partial values in the other columns, which nothing should use. Whether a line
    fits is decided on the columns that a query reads: store the rows before using them.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    full = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    reader = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED)
    if fmt == "csv":
        return reader.options(**(CSV_OPTIONS | options)).csv(path)
    return reader.options(**options).json(path)


@dataclass(frozen=True)
class TextSource:
    """Where the text of an entity lies; a source of ``ingest_bronze`` beside DataFrames."""

    fmt: str
    path: str
    options: dict[str, str] = field(default_factory=dict)

    def load(self, spark: SparkSession, schema: T.StructType, folder: str) -> DataFrame:
        """All lines with their place of arrival (``_seq``) and ``_malformed``, parsed once into ``folder``."""
        plain = T.StructType([f for f in schema.fields if f.name != SEQ])

        def store(lines: DataFrame) -> DataFrame:
            lines.write.parquet(folder)
            return spark.read.schema(lines.schema).parquet(folder)

        lines = read_text(spark, self.fmt, self.path, plain, **self.options)
        return file_position(lines, SEQ, start=0, store=store)


def well_formed(lines: DataFrame) -> DataFrame:
    return lines.where(F.col(MALFORMED).isNull()).drop(MALFORMED)


def malformed(lines: DataFrame) -> DataFrame:
    """(line, _seq) of the lines that do not fit the schema."""
    return lines.where(F.col(MALFORMED).isNotNull()).select(F.col(MALFORMED).alias("line"), SEQ)
