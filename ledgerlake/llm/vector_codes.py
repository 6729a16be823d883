"""Product codes of vectors: integer Lloyd rounds that follow only the active entries.

A vector becomes integers (components scaled and floored) and is cut into
equal parts; each part position has a codebook of at most 16 entries, begun
with the parts of the smallest ids. Each round assigns every part to its
nearest entry and moves each used entry to the floored mean of its parts.

The state, one stored row per vector, holds each part's entry and its exact
squared distance. After a round, a part whose entry stayed where it was
compares that stored distance with the entries that moved and with no other: the
entries that stayed were no nearer before and are no nearer now. A part whose
entry moved scans its whole codebook. All distances are integers, and equal ones
go to the lower index, so the result is the one of full scans.

Work is spread by rows; a task sends back at most one sum per entry. Only the
codebooks (parts x 16 entries) pass through the driver. Each state is stored
before its predecessor is deleted, so a lost executor repeats one round at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import discard, finite, small_batches, stage, stage_at

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
BLOCK = 4096  # rows compared at once: bounds a task's distance table
LIMIT = 1 << 15  # largest component: keeps squared distances of 64 components within 63 bits


def _parts(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    """(rows, parts, width) integers of the batch's vectors."""
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(batch.num_rows, parts, -1)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances (rows, entries) of integer vectors, exact."""
    out = np.empty((len(x), len(entries)), dtype=np.int64)
    for k, e in enumerate(entries):
        diff = x - e
        out[:, k] = np.einsum("ij,ij->i", diff, diff)
    return out


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, distance) of the nearest entry; the lower index on ties."""
    d = distances(x, book)
    k = d.argmin(axis=1)
    return k, d[np.arange(len(x)), k]


def follow(x: np.ndarray, at: np.ndarray, dist: np.ndarray, book: np.ndarray, moved: np.ndarray) -> None:
    """Bring (at, dist) of one part position up to ``book``, of which the entries ``moved`` changed."""
    if not moved.any():
        return
    active = np.flatnonzero(moved)
    stayed = ~moved[at]
    rows = np.flatnonzero(stayed)
    if len(rows):
        k, d = nearest(x[rows], book[active])
        k = active[k]
        better = (d < dist[rows]) | ((d == dist[rows]) & (k < at[rows]))
        at[rows[better]], dist[rows[better]] = k[better], d[better]
    rows = np.flatnonzero(~stayed)
    if len(rows):
        at[rows], dist[rows] = nearest(x[rows], book)


def _assign(books: np.ndarray, moved: np.ndarray | None, keep: list[str]):
    """Arrow step: state of the next round. ``moved`` None: nothing is assigned yet."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                x = _parts(batch, parts)
                if moved is None:
                    at = np.empty(x.shape[:2], dtype=np.int64)
                    dist = np.empty(x.shape[:2], dtype=np.int64)
                    for p in range(parts):
                        at[:, p], dist[:, p] = nearest(x[:, p], books[p])
                else:
                    at = np.array(batch.column("at").flatten(), dtype=np.int64).reshape(-1, parts)
                    dist = np.array(batch.column("dist").flatten(), dtype=np.int64).reshape(-1, parts)
                    for p in range(parts):
                        a, d = at[:, p].copy(), dist[:, p].copy()
                        follow(x[:, p], a, d, books[p], moved[p])
                        at[:, p], dist[:, p] = a, d
                ends = pa.array(np.arange(0, at.size + 1, parts, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in keep],
                     pa.ListArray.from_arrays(ends, pa.array(at.ravel().astype(np.int16))),
                     pa.ListArray.from_arrays(ends, pa.array(dist.ravel()))], names=[*keep, "at", "dist"])

    return run


def _sums(parts: int, entries: int):
    """Arrow step: per task one row (part, entry, n, total) for each entry in use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = n = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = _parts(batch, parts)
            at = np.array(batch.column("at").flatten(), dtype=np.int64).reshape(-1, parts)
            if total is None:
                total = np.zeros((parts, entries, x.shape[2]), dtype=np.int64)
                n = np.zeros((parts, entries), dtype=np.int64)
            for p in range(parts):
                np.add.at(total[p], at[:, p], x[:, p])
                n[p] += np.bincount(at[:, p], minlength=entries)
        if total is not None:
            p, e = np.nonzero(n)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(p.astype(np.int32)), "entry": pa.array(e.astype(np.int32)), "n": pa.array(n[p, e]),
                "total": pa.array(total[p, e].tolist(), type=pa.list_(pa.int64()))})

    return run


def _moved_books(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one update: floored means, unused entries as they were."""
    parts, entries, width = books.shape
    sums = state.select("x", "at").mapInArrow(_sums(parts, entries), "part int, entry int, n long, total array<long>")
    per = sums.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(width)]).alias("total"))
    out = books.copy()
    for r in per.collect():  # parts x entries rows at most
        out[r["part"], r["entry"]] = [int(s) // int(r["n"]) for s in r["total"]]
    return out


def integer_vectors(df: DataFrame, vector: str = "embedding", scale: int = SCALE, parts: int = PARTS,
                    id_col: str = "vec_id") -> DataFrame:
    """``df`` with ``x``: floor(scale * component), for the vectors that take part.

    Left out: null vectors, those with a null or non-finite component or one
    beyond +-2**15, and those that are not as long as the vector of the smallest
    id whose length is a multiple of ``parts``.
    """
    able = df.filter(finite(vector, float(LIMIT))).filter((F.size(vector) > 0) & (F.size(vector) % parts == 0))
    first = able.select(F.size(vector).alias("n")).orderBy(F.asc_nulls_last(id_col), "n").limit(1).collect()
    width = first[0]["n"] if first else 0
    return able.filter(F.size(vector) == width).withColumn("x", F.transform(
        F.col(vector), lambda c: F.floor(c.cast("double") * scale).cast("int")))


def encode(df: DataFrame, vector: str = "embedding", scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES,
           rounds: int = ROUNDS, id_col: str = "vec_id", keep: tuple[str, ...] = ("label",)
           ) -> tuple[DataFrame, np.ndarray]:
    """(rows, codebooks): each kept vector's ``at`` and ``dist`` (per part), and the final codebooks.

    Rows carry ``id_col``, the ``keep`` columns, ``x``, ``at`` (entry per part)
    and ``dist`` (its squared distance). Codebooks start from the vectors of
    the smallest ids (null ids last, then by the vector); fewer vectors than
    entries make shorter codebooks. Repeated ids are separate rows. Columns
    other than these play no part, whatever their names. No vectors: no rows,
    codebooks without entries.
    """
    spark = df.sparkSession
    small_batches(spark, BLOCK)
    names = list(dict.fromkeys([id_col, *keep]))
    picked = df.select(*[F.col(c) for c in dict.fromkeys([*names, vector])])
    plain, base = stage_at(integer_vectors(picked, vector, scale, parts, id_col).select(*names, "x"), "codes-x")
    seeds = [r["x"] for r in plain.select(id_col, "x").orderBy(F.asc_nulls_last(id_col), "x").limit(entries).collect()]
    if not seeds:
        empty = plain.withColumns({"at": F.array().cast("array<short>"), "dist": F.array().cast("array<long>")})
        return empty, np.empty((parts, 0, 0), dtype=np.int64)
    books = np.array(seeds, dtype=np.int64).reshape(len(seeds), parts, -1).transpose(1, 0, 2).copy()
    carried = [*names, "x"]
    schema = T.StructType([*[plain.schema[c] for c in carried], T.StructField("at", T.ArrayType(T.ShortType())),
                           T.StructField("dist", T.ArrayType(T.LongType()))])
    state, held, moved = plain, base, None
    for k in range(rounds + 1):
        state, path = stage_at(state.mapInArrow(_assign(books, moved, carried), schema), "codes")
        discard(spark, held)
        held = path
        if k < rounds:
            before, books = books, _moved_books(state, books)
            moved = (before != books).any(axis=2)
            if not moved.any():  # nothing moves any more: all later rounds leave the state as it is
                break
    return state, books


def codebook_digest(books: np.ndarray) -> str:
    """sha256 over all components by part, entry and place, in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def code_table(rows: DataFrame, books: np.ndarray, id_col: str = "vec_id", label: str = "label") -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of encoded rows; equal labels (nulls too) share label_error."""
    total = lambda d: F.aggregate(d, F.lit(0).cast("long"), lambda s, v: s + v)
    coded = rows.select(
        id_col, label, F.array_join(F.transform("at", lambda k: F.lower(F.lpad(F.hex(k.cast("long")), 2, "0"))), "").alias("code"),
        total(F.col("dist")).alias("error"))
    per_label = stage(coded.groupBy(label).agg(F.sum("error").alias("label_error")), "codes-labels").withColumnRenamed(label, "__label")
    return coded.join(per_label, F.col(label).eqNullSafe(F.col("__label")), "left").select(
        id_col, "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"))
