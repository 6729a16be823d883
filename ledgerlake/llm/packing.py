"""Best-fit packing of documents into fixed-size training sequences, with conflicts.

A document is cut into pieces of at most the capacity; the pieces are packed,
largest first, by best fit: open bins are kept in the order of their residual
space, the search starts at the piece's successor (the smallest residual that
holds it) and goes on until the bin is compatible, that is the tightest
compatible one. Each bin carries a bitmap of the sources and one of the
duplicate clusters it holds: a bin takes no two pieces of one cluster, and no
two documents of one source.

Packing runs in shards of a bounded number of pieces. Rows are dealt to the
shards by a hash of the row, not of source or cluster, so a hot source or a
cluster of thousands of copies is spread over all shards.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import SPACES, fold, stage

CAPACITY = 2048
SHARD_PIECES = 4096
_SCAN = 128  # bins looked at in one step of the successor search


def n_words(text: Column) -> Column:
    """Words of a text; null: none."""
    blank = F.translate(F.coalesce(text, F.lit("")), SPACES[1:], " " * (len(SPACES) - 1))
    return F.size(F.filter(F.split(blank, " "), lambda w: w != "")).cast("long")


def _bits(values: np.ndarray, repeated_only: bool) -> tuple[np.ndarray, int]:
    """(bit of each value or -1, 64-bit words of a bitmap); nulls have no bit."""
    codes, _ = pd.factorize(values)
    if repeated_only:  # a value that occurs once here cannot conflict
        count = np.bincount(codes[codes >= 0], minlength=1)
        fresh = np.cumsum(count > 1) - 1
        codes = np.where((codes >= 0) & (count[codes] > 1), fresh[codes], -1)
    return codes, max(1, -(-(int(codes.max(initial=-1)) + 1) // 64))


def best_fit(sizes: np.ndarray, sources: np.ndarray, clusters: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece, in the order given. Sizes lie in 1..capacity;
    a null source or cluster conflicts with nothing."""
    n = len(sizes)
    sbit, sw = _bits(sources, False)
    cbit, cw = _bits(clusters, True)
    smap, cmap = np.zeros((n, sw), dtype=np.uint64), np.zeros((n, cw), dtype=np.uint64)
    residual = np.empty(n, dtype=np.int64)  # of the open bins, ascending
    open_bin = np.empty(n, dtype=np.int64)
    opened = bins = 0
    out, offset = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for i in range(n):
        size, s, c = int(sizes[i]), int(sbit[i]), int(cbit[i])
        at, start = -1, int(np.searchsorted(residual[:opened], size))
        while start < opened:
            b = open_bin[start : min(opened, start + _SCAN)]
            clash = np.zeros(len(b), dtype=bool)
            if s >= 0:
                clash |= (smap[b, s >> 6] >> np.uint64(s & 63)) & np.uint64(1) != 0
            if c >= 0:
                clash |= (cmap[b, c >> 6] >> np.uint64(c & 63)) & np.uint64(1) != 0
            free = np.flatnonzero(~clash)
            if len(free):
                at = start + int(free[0])
                break
            start += _SCAN
        if at < 0:
            b, room = bins, capacity
            bins += 1
        else:
            b, room = int(open_bin[at]), int(residual[at])
            residual[at : opened - 1] = residual[at + 1 : opened]
            open_bin[at : opened - 1] = open_bin[at + 1 : opened]
            opened -= 1
        out[i], offset[i] = b, capacity - room
        if s >= 0:
            smap[b, s >> 6] |= np.uint64(1 << (s & 63))
        if c >= 0:
            cmap[b, c >> 6] |= np.uint64(1 << (c & 63))
        room -= size
        if room > 0:
            k = int(np.searchsorted(residual[:opened], room))
            residual[k + 1 : opened + 1] = residual[k:opened]
            open_bin[k + 1 : opened + 1] = open_bin[k:opened]
            residual[k], open_bin[k] = room, b
            opened += 1
    return out, offset


SCHEMA = "doc_id long, piece long, first_word long, n_tokens long, bin_id string, offset long, source string"


def _pack(capacity: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "row", "piece"], ascending=[False, True, True], kind="stable")
        b, offset = best_fit(pdf["n_tokens"].to_numpy(), pdf["source"].to_numpy(object), pdf["cluster"].to_numpy(object), capacity)
        pdf["bin_id"] = [f"{int(key[0])}-{x}" for x in b]
        pdf["offset"] = offset
        return pdf[["doc_id", "piece", "first_word", "n_tokens", "bin_id", "offset", "source"]]

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES, cluster: str | None = None) -> DataFrame:
    """Pieces (doc_id, piece, first_word, n_tokens, bin_id, offset, source) of all documents.

    A document has its words plus one end token as tokens: a null or empty text
    is one piece of one token. ``first_word`` and ``n_tokens`` give a piece's
    span. Pieces of one document share its source, so they never share a bin.
    The duplicate cluster is the column ``cluster`` (say, component_id of the n-gram join), or else the
    folded text without regard to separators: exact copies. A null cluster is none. A
    null source conflicts with nothing; null doc_ids and repeated rows are
    packed like any other. No rows, no bins.
    """
    total = n_words(F.col("text")) + 1
    blank = F.regexp_replace(F.trim(F.translate(fold(F.coalesce("text", F.lit(""))), SPACES[1:], " " * 5)), " +", " ")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        total.alias("total"), (F.xxhash64(blank) if cluster is None else F.when(
            F.col(cluster).isNotNull(), F.xxhash64(cluster))).alias("cluster"), F.xxhash64("doc_id", "text").alias("row"))
    pieces = stage(rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("total") - 1) / capacity))))
                   .withColumn("first_word", F.col("piece") * capacity)
                   .withColumn("n_tokens", F.least(F.lit(capacity).cast("long"), F.col("total") - F.col("first_word")))
                   .drop("total"), "pieces")
    shards = max(1, math.ceil(pieces.count() / shard_pieces))
    # Copies of one row differ by the salt of the scan order, which only deals them out.
    salted = pieces.withColumn("shard", F.pmod(F.xxhash64("row", "piece", F.monotonically_increasing_id()), F.lit(shards)))
    return stage(salted, "packing-shards").groupBy("shard").applyInPandas(_pack(capacity), SCHEMA)


def write_bins(packed: DataFrame, path: str) -> None:
    """Write the pieces in bin order (bin_id, offset), bins kept whole."""
    packed.repartition("bin_id").sortWithinPartitions("bin_id", "offset").write.parquet(path)
