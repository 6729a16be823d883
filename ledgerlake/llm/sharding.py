"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

1. The rows are staged with the input partition they sat in and their place
   there, so both stay fixed whatever task is repeated later.
2. With n_p rows in partition p and shard capacities at most one apart, the
   number of rows that p sends to each shard is drawn exactly: partition after
   partition, a multivariate hypergeometric draw from the remaining
   capacities. The matrix has partitions x shards numbers.
3. Each partition permutes its rows locally (a seeded random permutation of
   its places) and cuts the permutation by its row of the matrix.
4. Rows are exchanged by (shard, block) and permuted again: blocks are ranges
   of a random 64-bit key, rows are ranked within a block, and a prefix sum
   of the block sizes makes the rank a gapless slot. No task holds a shard.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlake.llm.common import small_batches, stage, without

SHARDS = 24
BLOCK_ROWS = 4096


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Exact draw: successes among ``n`` taken from ``good`` + ``bad``.

    Inversion over the window mode +- 12 standard deviations (what lies
    outside has a probability below 1e-30); valid for any population, where
    numpy's own draw stops at 10**9.
    """
    total = good + bad
    lo, hi = max(0, n - bad), min(n, good)
    if lo == hi:
        return lo
    mode = min(hi, max(lo, (n + 1) * (good + 1) // (total + 2)))
    sd = math.sqrt(n * (good / total) * (bad / total) * max(total - n, 1) / max(total - 1, 1))
    lo, hi = max(lo, mode - int(12 * sd) - 30), min(hi, mode + int(12 * sd) + 30)
    k = np.arange(lo, hi, dtype=np.float64)
    step = np.log((good - k) * (n - k)) - np.log((k + 1) * (bad - n + k + 1))
    log_p = np.concatenate([[0.0], np.cumsum(step)])
    cdf = np.cumsum(np.exp(log_p - log_p.max()))
    return lo + int(np.searchsorted(cdf, rng.random() * cdf[-1], side="right"))


def communication_matrix(sizes: list[int], shards: int, seed: int) -> np.ndarray:
    """matrix[p, s] = rows that partition p sends to shard s; column sums differ by one at most."""
    total = sum(sizes)
    left = [total // shards + (s < total % shards) for s in range(shards)]
    out = np.zeros((len(sizes), shards), dtype=np.int64)
    rng = np.random.default_rng(seed)
    for p, n in enumerate(sizes):
        pool = sum(left)
        for s in range(shards):
            pool -= left[s]
            out[p, s] = hypergeometric(rng, left[s], pool, n) if n else 0
            n -= int(out[p, s])
            left[s] -= int(out[p, s])
    return out


def _assign(sizes: dict[int, int], ends: dict[int, np.ndarray], seed: int):
    """A pandas UDF (part, row) -> shard: local permutation cut by the matrix row."""

    def shard(parts: pd.Series, rows: pd.Series) -> pd.Series:
        out = np.zeros(len(parts), dtype=np.int32)
        p, r = parts.to_numpy(), rows.to_numpy()
        for one in np.unique(p):
            if shard.last[0] != one:  # rows of a partition come together; one permutation is kept
                place = np.random.default_rng([seed, int(one)]).permutation(sizes[one])
                shard.last = (one, np.searchsorted(ends[one], place, side="right").astype(np.int32))
            at = p == one
            out[at] = shard.last[1][r[at]]
        return pd.Series(out)

    shard.last = (None, None)
    return F.pandas_udf(shard, "int")


def shuffle_into_shards(df: DataFrame, shards: int = SHARDS, seed: int = 20240, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with ``shard`` (0 .. shards-1) and ``slot`` (0, 1, ... in each shard).

    Every row gets one place, whatever its values (nulls, empty texts,
    repeated rows, very long texts). Columns shard and slot of the input are replaced, others
    kept whatever their names. Shard sizes differ by one at most; which rows meet in a
    shard, and their order, is a uniform random permutation given ``seed``.
    Groups of equal rows have no tie to a shard under this law. An empty
    input gives an empty result. The sizes of the input partitions (a few
    bytes each) go through the driver, never rows.
    """
    spark = df.sparkSession
    small_batches(spark, 4096)
    names = without(df, "shard", "slot").columns
    # monotonically_increasing_id is partition << 33 + place; stored, it is fixed from here on.
    # The columns travel as one, so that no name of theirs meets one of these.
    plain = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__columns"))
    staged = stage(plain.withColumn("__id", F.monotonically_increasing_id()), "shard-rows").withColumns({
        "__part": F.shiftright("__id", 33).cast("int"),
        "__row": F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))})
    counts = {r["__part"]: r["n"] for r in staged.groupBy("__part").agg(F.count("*").alias("n")).collect()}
    parts = sorted(counts)
    total = sum(counts.values())
    matrix = communication_matrix([counts[p] for p in parts], shards, seed)
    ends = {p: np.cumsum(matrix[k]) for k, p in enumerate(parts)}
    blocks = max(1, math.ceil(total / shards / block_rows))
    random = F.xxhash64(F.lit(seed), "__id")
    sent = staged.withColumns({
        "shard": _assign(counts, ends, seed)("__part", "__row"),
        "__rand": random,
        # 32 high bits of the random key, scaled to the number of blocks: ascending ranges.
        "__block": F.shiftright(F.shiftrightunsigned(random, 32) * F.lit(blocks), 32).cast("int")})
    sizes = sent.groupBy("shard", "__block").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("shard").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("shard").alias("__s"), F.col("__block").alias("__b"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    rank = F.row_number().over(Window.partitionBy("shard", "__block").orderBy("__rand", "__id"))
    placed = sent.withColumn("__rank", rank).join(
        starts, (F.col("shard") == F.col("__s")) & (F.col("__block") == F.col("__b")))
    return placed.withColumn("slot", (F.col("__start") + F.col("__rank") - 1).cast("long")).select(
        *[F.col("__columns").getField(c).alias(c) for c in names], "shard", "slot")


def write_shards(df: DataFrame, path: str) -> None:
    """Write the sharded rows as ``path/shard=<k>/``, each file in slot order."""
    df.repartition("shard", F.floor(F.col("slot") / F.lit(1_000_000))).sortWithinPartitions("shard", "slot") \
        .write.partitionBy("shard").parquet(path)
