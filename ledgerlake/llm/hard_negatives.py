"""Hard negatives by Fagin's threshold algorithm over per-dimension sorted lists.

For every anchor: its positives are the best rows of its label; the hard
negatives of a positive are the best rows of other labels whose score lies in
the positive's window, between ``low`` and ``high`` hundredths of its score.

Rows are searched in blocks. A block keeps one list a dimension, sorted by the
component. An anchor reads the lists from the end that its sign prefers (from
the top for a positive component, from the bottom for a negative one), a few
places at a time; each row met is scored at once on all its components (random
access). The anchor's components times the values last read in each list sum to
the threshold, which no row unmet can exceed. The anchor is done with a block
when the threshold is strictly below what each of its windows still needs: its
kth score, or the low end of the window while it has fewer than k rows. (Strictly:
an unmet row with a score equal to the kth may have the smaller id.) What a task
found in earlier blocks counts, so later blocks end sooner.

Anchors go out in groups of bounded size, one broadcast at a time, and each
group's search reads all rows: a task returns k rows a window at most, which
Spark merges. Scores are integers in double, exact below 2**53.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlake.llm.common import finite, small_batches, stage

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 5, 80, 100
BLOCK = 4096  # rows of a block, and of its sorted lists
STEP = 32  # places read from each list before the threshold is looked at; doubled each time
GROUP = 8192  # anchors that are searched together: bounds the broadcast
NO_ID = 2**63 - 1  # sorts rows without an id last

_FOUND = "anchor long, window int, score double, id long, row long"


class Block:
    """Vectors of some rows with their per-dimension lists in ascending order."""

    def __init__(self, batch: pa.RecordBatch, dims: int, scale: int):
        vectors = batch.column("v")
        sizes = np.diff(np.asarray(vectors.offsets))
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        self.x = np.zeros((batch.num_rows, dims))
        at = np.arange(dims) < sizes[:, None]  # shorter vectors end in zeros
        self.x[at] = np.floor(scale * flat)
        self.label, self.id, self.row = (np.asarray(batch.column(c)) for c in ("label", "id", "row"))
        self.order = np.argsort(self.x, axis=0, kind="stable").T.copy()

    def search(self, q: np.ndarray, visit: Callable[[np.ndarray, np.ndarray], None],
               done: Callable[[float], bool]) -> int:
        """Sorted access for the anchor ``q`` until ``done(threshold)``; the number of rows scored."""
        n = len(self.x)
        used = np.flatnonzero(q)
        if len(used) == 0:
            used = np.arange(min(1, len(q)))  # all scores are zero: one list still names every row
        up = q[used] > 0
        down_lists, up_lists = self.order[used[~up]], self.order[used[up], ::-1]
        seen = np.zeros(n, dtype=bool)
        depth, step, met = 0, STEP, 0
        while depth < n and met < n:
            end = min(n, depth + step)
            mark = np.zeros(n, dtype=bool)
            mark[down_lists[:, depth:end].ravel()] = True
            mark[up_lists[:, depth:end].ravel()] = True
            fresh = np.flatnonzero(mark & ~seen)
            if len(fresh):
                seen[fresh] = True
                met += len(fresh)
                visit(fresh, self.x[fresh] @ q)
            last = np.empty(len(used))
            last[~up] = self.x[down_lists[:, end - 1], used[~up]]
            last[up] = self.x[up_lists[:, end - 1], used[up]]
            if done(float(last @ q[used])):
                break
            depth, step = end, step * 2
        return met


class Best:
    """The k best (score, id, row) so far: higher scores first, then smaller ids."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.id, self.row = np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def kth(self) -> float:
        return self.score[-1] if len(self.score) == self.k else -math.inf

    def add(self, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        able = score >= self.kth
        if not able.any():
            return
        score = np.concatenate([self.score, score[able]])
        ids, rows = np.concatenate([self.id, ids[able]]), np.concatenate([self.row, rows[able]])
        first = np.lexsort((rows, ids, -score))[: self.k]
        self.score, self.id, self.row = score[first], ids[first], rows[first]


def _blocks(batches: Iterator[pa.RecordBatch], dims: int, scale: int) -> Iterator[Block]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            yield Block(batch.slice(start, BLOCK), dims, scale)


def _rows_found(found: list[tuple[int, int, Best]]) -> pa.RecordBatch:
    some = [(a, w, b) for a, w, b in found if len(b.score)]
    join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
    return pa.RecordBatch.from_pydict({
        "anchor": pa.array(join([np.full(len(b.score), a) for a, _, b in some], np.int64), pa.int64()),
        "window": pa.array(join([np.full(len(b.score), w) for _, w, b in some], np.int32), pa.int32()),
        "score": pa.array(join([b.score for _, _, b in some], float), pa.float64()),
        "id": pa.array(join([b.id for _, _, b in some], np.int64), pa.int64()),
        "row": pa.array(join([b.row for _, _, b in some], np.int64), pa.int64())})


def _find_positives(sent, k: int, scale: int):
    """Arrow step: the k best rows of each anchor's label, the anchor itself left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels, vectors = sent.value
        best = [Best(k) for _ in rows]
        for block in _blocks(batches, vectors.shape[1], scale):
            held = set(block.label.tolist())
            for a, b in enumerate(best):
                if labels[a] not in held:
                    continue

                def visit(at, score, a=a, b=b):
                    fit = (block.label[at] == labels[a]) & (block.row[at] != rows[a])
                    b.add(score[fit], block.id[at[fit]], block.row[at[fit]])

                block.search(vectors[a], visit, lambda t, b=b: t < b.kth)
        yield _rows_found([(int(rows[a]), 0, b) for a, b in enumerate(best)])

    return run


def _find_negatives(sent, k: int, scale: int, low: int, high: int):
    """Arrow step: per anchor and window the k best rows of other labels within the window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels, vectors, tops = sent.value
        # A window ends at ``high`` hundredths of its positive's score; without a possible score it is left out.
        best = [[(p, Best(k)) for p in top if low * p <= high * p] for top in tops]
        for block in _blocks(batches, vectors.shape[1], scale):
            for a, windows in enumerate(best):
                if not windows:
                    continue
                least = min(p for p, _ in windows)

                def visit(at, score, a=a, windows=windows, least=least):
                    fit = (block.label[at] != labels[a]) & (100 * score >= low * least)
                    if not fit.any():
                        return
                    at, score = at[fit], score[fit]
                    for p, b in windows:
                        inside = (100 * score >= low * p) & (100 * score <= high * p)
                        if inside.any():
                            b.add(score[inside], block.id[at[inside]], block.row[at[inside]])

                block.search(vectors[a], visit,
                             lambda t, windows=windows: all(100 * t < low * p or t < b.kth for p, b in windows))
        yield _rows_found([(int(rows[a]), w, b) for a, windows in enumerate(best) for w, (_, b) in enumerate(windows)])

    return run


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best rows per key: higher score, smaller id, earlier row."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "row"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def _vectors(rows: list, dims: int, scale: int) -> np.ndarray:
    out = np.zeros((len(rows), dims))
    for i, r in enumerate(rows):
        out[i, : len(r["v"])] = np.floor(scale * np.asarray(r["v"], dtype=np.float64))
    return out


def mine(df: DataFrame, anchors: Column, vector: str = "embedding", id_col: str = "vec_id", label: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         scale: int = SCALE, group: int = GROUP) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` picks the anchor rows of ``df``. Rows with a null label, a null
    vector or a null or non-finite component take no part; components become
    floor(scale * x). A shorter vector ends in zeros. Each row counts for
    itself: a repeated row is a row of its own, and equal scores with equal ids
    keep the stored order. A row without an id sorts last. Other columns play no
    part. Anchors without positives, and windows without rows, give nothing; nor
    does an empty table.
    """
    if not 0 <= low <= high:
        raise ValueError("the window must run upwards")
    spark = df.sparkSession
    small_batches(spark, BLOCK)
    rows = df.filter(F.col(label).isNotNull() & finite(vector)).select(
        F.coalesce(F.col(id_col), F.lit(NO_ID)).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        F.col(vector).alias("v"), F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
        F.monotonically_increasing_id().alias("row"))
    rows = stage(rows, "negatives-rows")
    chosen = stage(rows.filter("is_anchor"), "negatives-anchors")
    size = rows.agg(F.max(F.size("v")).alias("dims"), F.count_if("is_anchor").alias("n")).first()
    dims, groups = max(1, size["dims"] or 0), max(1, math.ceil(size["n"] / group))
    part = F.pmod(F.xxhash64("row"), F.lit(groups))  # row is unique: groups are even
    searched = rows.select("id", "label", "v", "row")
    found = None
    for g in range(groups):
        mine_of = chosen.filter(part == g)
        some = sorted(mine_of.select("row", "label", "v").collect(), key=lambda r: r["row"])  # about ``group`` rows
        ids, labels, vectors = [r["row"] for r in some], [r["label"] for r in some], _vectors(some, dims, scale)
        sent = spark.sparkContext.broadcast((ids, labels, vectors))
        best = stage(_first(searched.mapInArrow(_find_positives(sent, positives, scale), _FOUND), ["anchor"], positives),
                     "negatives-positives")
        sent.unpersist()
        of = {r: [] for r in ids}
        for r in best.select("anchor", "score").distinct().collect():  # ``positives`` scores an anchor at most
            of[r["anchor"]].append(r["score"])
        # One window per different score; a score of its own number in ascending order.
        tops = [sorted(p for p in of[r] if low * p <= high * p) for r in ids]
        sent = spark.sparkContext.broadcast((ids, labels, vectors, tops))
        inside = stage(_first(searched.mapInArrow(_find_negatives(sent, negatives, scale, low, high), _FOUND),
                              ["anchor", "window"], negatives), "negatives-found")
        sent.unpersist()
        number = F.dense_rank().over(Window.partitionBy("anchor").orderBy("score")) - 1
        pairs = best.filter(F.col("score") * low <= F.col("score") * high).select(
            "anchor", number.alias("window"), F.col("id").alias("positive"), F.col("score").alias("positive_score"))
        both = mine_of.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")).join(pairs, "anchor").join(
            inside, ["anchor", "window"])
        own = lambda c: F.nullif(F.col(c), F.lit(NO_ID))  # noqa: E731  the stand-in of a missing id goes again
        out = both.select(
            own("anchor_id").alias("anchor_id"), own("positive").alias("positive_id"),
            F.col("rank").cast("int").alias("rank"), own("id").alias("negative_id"),
            F.col("positive_score").cast("long").alias("positive_score"), F.col("score").cast("long").alias("negative_score"))
        found = out if found is None else found.unionByName(out)
    return found
