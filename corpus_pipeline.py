"""Training-data pipeline: quality rules, line dedup, near-duplicate removal,
decontamination, packing. Each stage reads what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import decontaminate, jaccard_join, line_dedup, packing, quality_rules
from ledgerlake.llm.common import documents, stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Near duplicates: shingles of five words at a similarity of 0.8.
SHINGLE, NUM, DEN = 5, 80, 100


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned list keep."""
    rules = quality_rules.fit_rules(docs, documents(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules).filter("kept").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from all but the first document; n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group of near duplicates stays."""
    found = jaccard_join.jaccard_components(docs, SHINGLE, NUM, DEN)
    gone = stage(found.filter("component_id <> doc_id").select(F.col("doc_id").alias("gone")).distinct(), "near-dups")
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaking(docs, documents(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("best_fit_packing", pack),
]

# The learned list, the edit-distance search and best fit have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read again."""
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
