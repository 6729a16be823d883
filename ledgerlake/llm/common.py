"""Shared pieces of the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import scratch_root

# Fixed by the operators' contracts: the six separators of a word, and the
# letters that are folded (A-Z only; other letters keep their case).
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FOLD = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
FOLD_AND_BLANK = bytes.maketrans((UPPER + SPACES).encode(), (UPPER.lower() + " " * len(SPACES)).encode())

# Rows per Arrow batch handed to Python: texts may be long, so batches are
# kept small to bound a worker's memory.
BATCH_ROWS = 512


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of an Arrow batch for the Python steps of this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def stage(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor never repeats what lies before it.
    """
    return stage_at(df, label, partition_by)[0]


def stage_at(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> tuple[DataFrame, str]:
    """``stage`` with the folder written, for ``discard`` once a later stage replaces it."""
    path = scratch_root(df.sparkSession, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete staged folders that nothing reads any more, through their own file system."""
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


class Stages:
    """The staged frames of one job, by label, to be deleted once a later stage replaces them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[str, list[str]] = {}

    def put(self, df: DataFrame, label: str) -> DataFrame:
        out, path = stage_at(df, label)
        self._paths.setdefault(label, []).append(path)
        return out

    def drop(self, *labels: str) -> None:
        """Delete what was staged under ``labels``: every frame that reads it must be stored by now."""
        for label in labels:
            discard(self.spark, *self._paths.pop(label, []))


def finite(vector: str, most: float = float("inf")) -> Column:
    """Is the vector there, with every component given, finite and within ``most``?"""
    return F.coalesce(F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (
        F.abs(x) < most if most == float("inf") else F.abs(x) <= most)), F.lit(False))


def label_sample(labels: DataFrame, label: Column, max_labelled: int) -> DataFrame:
    """(__id, __label) of about ``max_labelled`` labelled documents, never more than twice as many.

    Labels without a doc_id or a value are left out. A document counts once, however often it
    is labelled: ``label`` aggregates its rows. Documents are taken by a hash of doc_id.
    """
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("__id")).agg(
        label.alias("__label")).filter("__label is not null")
    share = min(1_000_000, max_labelled * 1_000_000 // max(1, known.count()))
    return known.filter(F.pmod(F.xxhash64("__id"), F.lit(1_000_000)) < share).limit(2 * max_labelled)


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(__id, __label, text) of the sampled documents, one row each (of several texts the smallest)."""
    joined = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("__id"))
    return joined.groupBy("__id", "__label").agg(F.min("text").alias("text"))


def fold(text: Column) -> Column:
    """A-Z to lower case; every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns an operator is about to add (case-insensitively)."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8 bytes, A-Z folded.

    ``bytes.split`` cuts at exactly the six separators, unlike ``str.split``.
    """
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []
