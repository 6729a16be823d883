"""Corpus-wide line dedup over levelled sorted runs of line hashes.

``LineRuns`` is the store. A run is a Parquet folder of distinct line hashes,
each with the document that first held the line, sorted by hash. A batch of
documents is grouped to its distinct line hashes, merge-joined with all runs,
and what the runs lack (the anti-join) becomes a new run of level 0. When a
level holds ``fanout`` runs, they are merged into one run of the next level,
so a hash is rewritten O(log n) times. A hash is in one run only.

Line identity is the pair of two 64-bit hashes of the line key (128 bits): no
collision is expected below 10**18 distinct lines. Grouping has a map-side
partial aggregate, so a line of a third of all documents is one row per task.
Removing lines joins lines with the (stored) shared hashes; a hot line is one
row on that side, and adaptive execution splits its lines on the other.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import SPACES, UPPER, stage, without
from ledgerlake.session import scratch_root

MIN_KEY = 10
BATCHES = 4
FANOUT = 3


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(docs: DataFrame, min_key: int = MIN_KEY) -> DataFrame:
    """(doc_id, text_hash, pos, h1, h2): one row per line whose key is long enough.

    A key is the line with separators stripped at both ends and A-Z folded.
    Rows without a doc_id have no lines here: nothing is removed from them.
    """
    key = F.btrim(F.col("line"), F.lit(SPACES))
    return (
        docs.filter(F.col("doc_id").isNotNull())
        .select("doc_id", F.xxhash64("text").alias("text_hash"),
                F.posexplode(_lines(F.translate("text", UPPER, UPPER.lower()))).alias("pos", "line"))
        .select("doc_id", "text_hash", "pos", key.alias("key"))
        .filter(F.char_length("key") >= min_key)
        .select("doc_id", "text_hash", "pos", F.xxhash64("key").alias("h1"),
                F.xxhash64(F.lit(1), "key").alias("h2"))
    )


class LineRuns:
    """The levelled store of line hashes under ``root`` (a shared folder).

    The list of live runs is itself stored after every batch, so a new
    session goes on with ``LineRuns(spark, root)``. Batches count in the order
    they are added: the first holder of a line keeps it, within a batch the
    smallest doc_id.
    """

    def __init__(self, spark: SparkSession, root: str, fanout: int = FANOUT, min_key: int = MIN_KEY):
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.spark, self.root, self.fanout, self.min_key = spark, root.rstrip("/"), fanout, min_key
        self.levels: list[list[str]] = []
        self.batches: list[str] = []
        self._version = 0
        self._load()

    def _load(self) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifests")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return
        done = [int(s.getPath().getName()) for s in fs.listStatus(path)
                if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
        if done:
            self._version = max(done)
            state = json.loads(self.spark.read.text(f"{self.root}/manifests/{self._version}").first()[0])
            self.levels, self.batches = state["levels"], state["batches"]

    def _commit(self) -> None:
        self._version += 1
        state = json.dumps({"levels": self.levels, "batches": self.batches})
        self.spark.createDataFrame([(state,)], "value string").coalesce(1).write.text(
            f"{self.root}/manifests/{self._version}")

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema("h1 long, h2 long, owner long, shared boolean").parquet(path)

    def runs(self) -> DataFrame | None:
        """All live runs as one frame (h1, h2, owner), or None."""
        paths = [p for level in self.levels for p in level]
        if not paths:
            return None
        out = self._read(paths[0])
        for p in paths[1:]:
            out = out.unionByName(self._read(p))
        return out.select("h1", "h2", "owner")

    def add(self, docs: DataFrame) -> DataFrame:
        """Add a batch; returns its shared hashes (h1, h2, owner): lines that
        an earlier batch or a smaller doc_id of this batch already holds."""
        found = line_keys(docs, self.min_key).groupBy("h1", "h2").agg(
            F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        known = self.runs()
        if known is None:
            merged = found.withColumn("owner", F.lit(None).cast("long"))
        else:
            merged = found.join(known.hint("merge"), ["h1", "h2"], "left")
        merged = merged.select(
            "h1", "h2", F.coalesce("owner", "first").cast("long").alias("owner"),
            (F.col("owner").isNotNull() | (F.col("first") < F.col("last"))).alias("shared"),
            F.col("owner").isNull().alias("fresh"))
        path = f"{self.root}/batches/{scratch_root(self.spark, 'b').rsplit('-', 1)[1]}"
        merged.sortWithinPartitions("fresh", "h1", "h2").write.partitionBy("fresh").parquet(path)
        self.batches.append(path)
        present = {r[0] for r in self.spark.read.schema("fresh boolean").parquet(path)
                   .select("fresh").distinct().collect()}
        if True in present:
            if not self.levels:
                self.levels.append([])
            self.levels[0].append(f"{path}/fresh=true")
            self._compact()
        self._commit()
        return self.shared([path])

    def shared(self, paths: list[str] | None = None) -> DataFrame:
        """The shared hashes of the given (default: all) batches, one owner each."""
        schema = "h1 long, h2 long, owner long, shared boolean, fresh boolean"
        out = self.spark.createDataFrame([], "h1 long, h2 long, owner long")
        paths = self.batches if paths is None else paths
        for k, p in enumerate(paths):
            part = self.spark.read.schema(schema).parquet(p).filter("shared").select("h1", "h2", "owner")
            out = part if k == 0 else out.unionByName(part)
        return out if len(paths) < 2 else out.groupBy("h1", "h2").agg(F.min("owner").alias("owner"))

    def _compact(self) -> None:
        k = 0
        while k < len(self.levels):
            if len(self.levels[k]) >= self.fanout:
                path = f"{self.root}/level{k + 1}/{scratch_root(self.spark, 'r').rsplit('-', 1)[1]}"
                run = self._read(self.levels[k][0])
                for p in self.levels[k][1:]:
                    run = run.unionByName(self._read(p))
                run.repartition("h1", "h2").sortWithinPartitions("h1", "h2").write.parquet(path)
                self.levels[k] = []
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(path)
            k += 1


def remove_lines(docs: DataFrame, shared: DataFrame, min_key: int = MIN_KEY) -> DataFrame:
    """``docs`` without the lines whose hash is in ``shared`` under another owner.

    Every column stays, ``text`` becomes the kept lines joined by newlines
    (empty when none is left; a null text is one empty line), and n_lines,
    n_dropped (long) are added (and replace columns of those names; other names may be any). Repeated
    rows of a doc_id are treated alike. A very long text is one row of one task.
    """
    drops = (
        line_keys(docs, min_key).join(shared.hint("merge"), ["h1", "h2"])
        .filter(F.col("doc_id") != F.col("owner"))
        .groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("__drop"))
        .withColumnsRenamed({"doc_id": "__doc", "text_hash": "__hash"})
    )
    cols = without(docs, "n_lines", "n_dropped").columns
    # The lines are cut before the join, so that they are a column of it and not cut again per element; the
    # other columns travel as one, so that no name of theirs meets one of these.
    rest = F.struct(F.lit(0).alias("__"), *[F.col(f"`{c}`") for c in cols if c != "text"])
    cut = docs.select(rest.alias("__rest"), F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__text_hash"),
                      _lines(F.col("text")).alias("__lines"))
    joined = cut.join(drops, (F.col("__id") == F.col("__doc")) & (F.col("__text_hash") == F.col("__hash")), "left")
    n = F.size("__lines")
    kept = F.array_except(F.sequence(F.lit(0), n - 1), "__drop")
    text = F.array_join(F.when(F.col("__drop").isNull(), F.col("__lines")).otherwise(
        F.transform(kept, lambda i: F.get(F.col("__lines"), i))), "\n")
    return joined.select(
        *[text.alias("text") if c == "text" else F.col("__rest").getField(c).alias(c) for c in cols],
        n.cast("long").alias("n_lines"),
        F.coalesce(F.size("__drop"), F.lit(0)).cast("long").alias("n_dropped"))


def dedup_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT, min_key: int = MIN_KEY,
                root: str | None = None) -> DataFrame:
    """Line dedup of a whole table: the smallest doc_id holding a line keeps it.

    The table goes through ``LineRuns`` in ``batches`` ascending doc_id
    ranges. Rows with a null doc_id, tables without rows and null texts are
    fine (see ``line_keys`` and ``remove_lines``).
    """
    spark = docs.sparkSession
    store = LineRuns(spark, root or scratch_root(spark, "line-runs"), fanout, min_key)
    cuts = docs.approxQuantile("doc_id", [k / batches for k in range(1, batches)], 0.01) if batches > 1 else []
    cuts = sorted({int(c) for c in cuts})
    bounds = [None, *cuts, None]
    for low, high in zip(bounds, bounds[1:]):
        part = docs.select("doc_id", "text")
        if low is not None:
            part = part.filter(F.col("doc_id") > low)
        if high is not None:
            part = part.filter(F.col("doc_id") <= high)
        store.add(part)
    return remove_lines(docs, stage(store.shared(), "shared-lines"), min_key)
