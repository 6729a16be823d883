"""N-gram Jaccard join by a token-group matrix.

Texts with the same shingle set form a class; one row of it goes on. Classes
are partitioned into groups of similar sets: classes that share a MinHash band
are compared with the smallest of the band, and verified links are closed into
groups. The token-group matrix then holds each group's token union, reduced to
the tokens that can witness a link: with every set in one global token order
(rare first), two sets whose overlap is at least ``o`` share at least ``h``
tokens of their first ``n - o + h``, for any h. With ``h`` a twentieth of the
set (``needed_hits``), a set q can link into a group only if its leading tokens
meet the group's union in that many tokens and the group has a member of a
fitting size. Only such groups are opened; their members are bounded once more
and the rest is verified on the whole sets. Links within a group need no further test: the result is the connected
component, which they do not change. Exact: no cap, no missed link.

The order ranks tokens by frequency buckets counted over all documents, which
keeps passages that many documents share out of the leading tokens. (Any order
is exact; this one makes few candidates.)
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import SPACES, UPPER, Stages, small_batches
from ledgerlake.llm.components import components
from ledgerlake.llm.url_filter import keep_listed

BANDS, ROWS = 6, 4
BUCKETS = 1 << 20
LOCAL_TOP = 2048  # frequent buckets that one task reports
MAX_HEAVY = 1 << 16  # frequent buckets that the order knows

_P1, _P2 = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F)
_S = np.uint64(31)


BLOCK = 1 << 18  # bytes of a text hashed at once

_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(SPACES.encode())] = True
_BASE = 0x9E6C63D0876A9A35  # odd, so it has an inverse modulo 2^64
_BYTE = np.random.default_rng(7).integers(0, 2**64, size=256, dtype=np.uint64)
_BYTE[list(UPPER.encode())] = _BYTE[list(UPPER.lower().encode())]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, BLOCK), _powers(pow(_BASE, -1, 1 << 64), BLOCK)


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text, A-Z folded, in order.

    A word's hash is the sum of a random number per byte times powers of an odd base, from
    prefix sums over a block of bytes: no word is cut out. Blocks end at a space (a longer word is a block).
    """
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass") if text else b"", dtype=np.uint8)
    flags = np.ones(len(raw) + 2, dtype=bool)
    flags[1:-1] = _SPACE[raw]
    edge = np.flatnonzero(flags[1:] != flags[:-1])
    starts, ends = edge[::2], edge[1::2]
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        here = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, here + BLOCK, side="right")))
        size = int(ends[to - 1] - here)
        up = _UP[:size] if size <= BLOCK else _powers(_BASE, size)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(_BYTE[raw[here : here + size]] * up, out=sums[1:])
        first = starts[at:to] - here  # below BLOCK: a longer word is alone in its block
        out[at:to] = (sums[ends[at:to] - here] - sums[first]) * _DOWN[first]
        at = to
    out ^= out >> _S
    out *= _P1
    return out


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; one for a shorter text, none without words."""
    h = word_hashes(text)
    n = len(h)
    if n == 0:
        return h
    width = min(k, n)
    acc = np.full(n - width + 1, width, dtype=np.uint64)
    for j in range(width):
        acc ^= h[j : n - width + 1 + j]
        acc *= _P1
        acc ^= acc >> _S
        acc *= _P2
        acc ^= acc >> _S
    acc.sort()
    new = np.ones(len(acc), dtype=bool)
    np.not_equal(acc[1:], acc[:-1], out=new[1:])
    return acc[new]


def min_overlap(n: int, num: int, den: int) -> int:
    """What a set of n shares at least with any set at Jaccard >= num/den."""
    return -(-num * n // den)


def needed_hits(n: int) -> int:
    """Leading tokens that two sets of at least n tokens share if they link."""
    return max(2, -(-n // 20))


def _hits(n: Column) -> Column:
    return F.greatest(F.lit(2), F.ceil(n / 20))


def linked(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return den * both >= num * (len(x) + len(y) - both) and both > 0


def _heavy_counts(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for pdf in batches:
            got = [shingles(t, k) for t in pdf["text"]]
            if got:
                total += np.bincount((np.concatenate(got) % BUCKETS).astype(np.int64), minlength=BUCKETS)
        top = np.argpartition(total, BUCKETS - LOCAL_TOP)[BUCKETS - LOCAL_TOP :]
        top = top[total[top] > max(4, 4 * total.mean())]
        yield pd.DataFrame({"bucket": top, "n": total[top]})

    return run


def frequent_buckets(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, rank) of frequent hash buckets, by bucket; at most ``MAX_HEAVY`` reach the driver."""
    local = docs.select("text").mapInPandas(_heavy_counts(k), "bucket long, n long")
    rows = local.groupBy("bucket").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "bucket").limit(MAX_HEAVY).toPandas()
    rows = rows.sort_values("bucket")
    return rows["bucket"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)


def _describe(k: int, num: int, den: int, heavy: tuple[np.ndarray, np.ndarray]):
    least = -(-den // (den - num)) - 1  # smaller sets link to equal sets only
    factors = np.random.default_rng(11).integers(1, 2**63, size=BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
    rank = np.zeros(BUCKETS, dtype=np.int64)
    rank[heavy[0]] = heavy[1]

    def one(text):
        s = shingles(text, k)
        n = len(s)
        raw = s.tobytes()
        f1, f2 = xxhash.xxh64_intdigest(raw) - 2**63, xxhash.xxh64_intdigest(raw, 1) - 2**63
        if n < least:
            return n, f1, f2, [], []
        mins = (s[None, :] * factors[:, None]).min(axis=1)
        bands = [xxhash.xxh64_intdigest(m.tobytes(), b) - 2**63 for b, m in enumerate(mins.reshape(BANDS, ROWS))]
        order = np.lexsort((s, rank[(s % BUCKETS).astype(np.int64)]))
        lead = s[order[: min(n, n - min_overlap(n, num, den) + needed_hits(n))]]
        return n, f1, f2, bands, lead.view(np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [one(t) for t in pdf["text"]]
            out = pd.DataFrame(rows, columns=["n", "f1", "f2", "bands", "lead"])
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out

    return run


def _verify(k: int, num: int, den: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, np.ndarray] = {}
        for pdf in batches:
            keep = []
            for x, y in zip(pdf["text_a"], pdf["text_b"]):
                if y not in cache:  # rows come sorted by b: its set is made once
                    if len(cache) > 64:
                        cache.clear()
                    cache[y] = shingles(y, k)
                keep.append(linked(shingles(x, k), cache[y], num, den))
            yield pdf.loc[keep, ["a", "b"]]

    return run


def verified(pairs: DataFrame, docs: DataFrame, k: int, num: int, den: int, stages: Stages) -> DataFrame:
    """The (a, b) pairs of documents that link, tested on their whole texts.

    Only texts of a pair are shuffled: a filter of bounded size takes the others out
    first. Stores ``pairs``, ``pair-ids`` and ``pair-texts``.
    """
    pairs = stages.put(pairs.distinct(), "pairs")
    ids = stages.put(pairs.select(F.col("a").alias("__id")).union(pairs.select("b")).distinct(), "pair-ids")
    texts = docs.select(F.col("doc_id").alias("__id"), F.col("text").alias("__t")).filter("__t is not null")
    some = stages.put(keep_listed(texts, "__id", ids), "pair-texts")
    first = pairs.join(some.select(F.col("__id").alias("a"), F.col("__t").alias("text_a")), "a")
    full = first.join(some.select(F.col("__id").alias("b"), F.col("__t").alias("text_b")).hint("merge"), "b")
    return full.select("a", "b", "text_a", "text_b").mapInPandas(_verify(k, num, den), "a long, b long")


def jaccard_components(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id, text).

    Sets link when ``den * |intersection| >= num * |union|``; component_id is
    the smallest doc_id reachable. Texts without words link with nothing.
    Rows of one doc_id are one document with several texts. A row without
    doc_id takes the component of an equal set, else null.
    """
    if not 0 < num < den:
        raise ValueError("the threshold must lie between 0 and 1")
    small_batches(docs.sparkSession)
    stages = Stages(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    heavy = frequent_buckets(docs, k)
    sets = stages.put(docs.mapInPandas(_describe(k, num, den, heavy),
                                  "doc_id long, n long, f1 long, f2 long, bands array<long>, lead array<long>"), "sets")
    same = ["n", "f1", "f2"]
    classes = stages.put(sets.filter("n > 0").groupBy(*same).agg(F.min("doc_id").alias("cls")), "classes")
    reps = sets.filter(F.size("lead") > 0).join(
        classes.withColumnRenamed("cls", "doc_id"), [*same, "doc_id"], "left_semi")

    # Groups of similar sets: links to the smallest class of each shared band.
    banded = reps.select(F.col("doc_id").alias("a"), F.posexplode("bands").alias("band", "key"))
    leaders = stages.put(banded.groupBy("band", "key").agg(F.min("a").alias("b"), F.max("a").alias("z"))
                    .filter("b < z").select("band", "key", "b"), "leaders")
    near = stages.put(verified(banded.join(leaders, ["band", "key"]).filter("a <> b").select("a", "b"),
                          docs, k, num, den, stages), "links")
    groups = components(near)
    stages.drop("leaders", "pairs", "pair-ids", "pair-texts")

    # Token-group matrix over the leading tokens that more than one group holds.
    grouped = stages.put(reps.select("doc_id", "n", "lead").join(groups, F.col("doc_id") == F.col("node"), "left").select(
        F.col("doc_id").alias("cls"), "n", F.coalesce("component", "doc_id").alias("grp"), "lead"), "grouped")
    tokens = grouped.select("cls", "n", "grp", F.explode("lead").alias("tok"))
    shared = stages.put(tokens.groupBy("tok").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi"))
                   .filter("lo < hi").select("tok"), "shared-tokens")
    member = stages.put(tokens.join(shared, "tok").distinct(), "matrix-members")
    matrix = stages.put(member.groupBy("tok", F.col("grp").alias("g")).agg(
        F.min("n").alias("n_min"), F.max("n").alias("n_max")), "matrix")
    fits = (F.col("n") * num <= F.col("n_max") * den) & (F.col("n_min") * num <= F.col("n") * den)
    # The overlap of q and the union of group g, bounded over the leading tokens; the smallest
    # fitting member has num/den of q's tokens.
    opened = stages.put(member.join(matrix, "tok").filter((F.col("grp") > F.col("g")) & fits)
                   .groupBy("cls", "n", "g").agg(F.count("*").alias("hits"))
                   .filter(F.col("hits") >= _hits(F.ceil(F.col("n") * num / den)))
                   .select("cls", "g"), "opened")
    stages.drop("shared-tokens", "matrix-members", "matrix")
    # Opened groups: a member stays if the common leading tokens and all later ones could reach the
    # overlap that Jaccard num/den asks for. (What is common beyond the shorter lead lies after it.)
    lead = grouped.select("cls", "n", "grp", "lead")
    openers = stages.put(opened.select("cls").distinct(), "openers")
    q = stages.put(keep_listed(lead, "cls", openers).join(opened, "cls").select(
        F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("lead").alias("lead_a"), "g"), "open-queries")
    inside = lead.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("lead").alias("lead_b"),
                         F.col("grp").alias("g"))
    common = F.size(F.array_intersect("lead_a", "lead_b"))
    later = F.greatest(F.col("n_a") - F.size("lead_a"), F.col("n_b") - F.size("lead_b"))
    pairs = (q.join(inside.hint("merge"), "g")
             .filter((F.col("n_a") * num <= F.col("n_b") * den) & (F.col("n_b") * num <= F.col("n_a") * den)
                     & (common >= _hits(F.least("n_a", "n_b")))
                     & ((common + later) * (num + den) >= (F.col("n_a") + F.col("n_b")) * num))
             .select("a", "b"))
    far = stages.put(verified(pairs, docs, k, num, den, stages), "links")
    found = components(far.unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b"))))

    known = sets.select("doc_id", *same).join(classes, same, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("cls", "doc_id").alias("cls"))
    return known.join(found, F.col("cls") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "cls").alias("component_id"))
