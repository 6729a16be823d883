"""URL filter: longest-prefix host rules, then a listed-URL test by blocked Bloom filter.

``BlockedBloom`` is a frame of 256-bit blocks (four longs), built by a
distributed bit_or per block. Its size has a fixed upper bound (``MAX_BLOCKS``
rows), so it may be broadcast whatever the list's length: a list too long for
it only lets more rows through to the exact join, never changes a result.
Rows that the filter passes meet the list in a hash join on the canonical URL
itself, which removes every false positive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import fold, stage, without

# Fixed by the contract: (verdict, host, path) of the rules.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
# The listed URLs of the registered query: all pages on a host with one of these labels.
LISTED_LABELS = ["ads-track", "casino-win", "spam-farm", "adult-x", "cheap-pills", "free-bets"]
# Query parameters that do not change the page.
TRACKING = "utm_[a-z]+|ref|gclid|fbclid"
MAX_BLOCKS = 1 << 17  # 4 MB of bits
BITS_PER_KEY = 16
PROBES = 8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z folded; else empty."""
    return fold(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without www. and default port, path without trailing slashes and
    ``.html``, query without tracking parameters and in sorted order; no
    scheme, no fragment. A URL without a host has none (null)."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"/+$", ""), r"\.html?$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    params = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^({TRACKING})(=|$)")))
    return F.when(host != "", F.concat(host, path, F.when(F.size(params) > 0, F.concat(
        F.lit("?"), F.array_join(params, "&"))).otherwise("")))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule fitting the host (or a parent domain) and path; nulls if none."""
    rule = verdict = F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _mask(key: Column, probes: int) -> list[Column]:
    """The bits of a key within its block, as four longs."""
    h = F.xxhash64(F.lit(7), key)
    masks = [F.lit(0).cast("long")] * 4
    for k in range(probes):
        bit = F.shiftrightunsigned(h, 8 * k).bitwiseAND(F.lit(255))
        word, one = F.shiftright(bit, 6), F.call_function("shiftleft", F.lit(1).cast("long"),
                                                          bit.bitwiseAND(F.lit(63)).cast("int"))
        masks = [m.bitwiseOR(F.when(word == w, one).otherwise(F.lit(0).cast("long"))) for w, m in enumerate(masks)]
    return masks


def build_bloom(listed: DataFrame, key: str, n_keys: int, max_blocks: int = MAX_BLOCKS,
                bits_per_key: int = BITS_PER_KEY, probes: int = PROBES) -> tuple[DataFrame, int]:
    """(blocks frame, number of blocks): at most ``max_blocks`` rows of four longs."""
    blocks = max(1, min(max_blocks, math.ceil(n_keys * bits_per_key / 256)))
    masks = {f"__m{w}": m for w, m in enumerate(_mask(F.col(key), probes))}
    out = listed.select(_block(F.col(key), blocks).alias("__block"), *[m.alias(n) for n, m in masks.items()])
    return out.groupBy("__block").agg(*[F.bit_or(n).alias(f"__w{n[-1]}") for n in masks]), blocks


def mark_listed(df: DataFrame, key: str, listed: DataFrame, max_blocks: int = MAX_BLOCKS,
                probes: int = PROBES) -> DataFrame:
    """``df`` with booleans ``maybe_listed`` (the filter's answer) and ``listed`` (exact).

    ``listed`` is a frame with a column ``key``; repeats and nulls in it are
    dropped. A null key in ``df`` is not listed.
    """
    clean = stage(listed.select(F.col(key).alias("__key")).filter(F.col("__key").isNotNull()).distinct(), "url-list")
    bloom, blocks = build_bloom(clean, "__key", clean.count(), max_blocks, probes=probes)
    bloom = stage(bloom, "url-bloom")  # bounded: max_blocks rows
    masks = _mask(F.col(key), probes)
    hit = F.lit(True)
    for w, m in enumerate(masks):
        hit = hit & (F.col(f"__w{w}").bitwiseAND(m) == m)
    passed = without(df, "maybe_listed", "listed").withColumn("__b", _block(F.col(key), blocks)).join(
        F.broadcast(bloom), (F.col("__b") == F.col("__block")) & F.col(key).isNotNull(), "left").withColumn(
        "maybe_listed", F.coalesce(hit, F.lit(False)))
    passed = passed.drop("__b", "__block", *[f"__w{w}" for w in range(4)])
    # A row the filter rejects carries a null join key: it cannot match and needs no exact test.
    exact = passed.withColumn("__k", F.when(F.col("maybe_listed"), F.col(key))).filter("__k is not null")
    found = exact.join(clean.hint("shuffle_hash"), F.col("__k") == F.col("__key"), "left").withColumn(
        "listed", F.col("__key").isNotNull()).drop("__k", "__key")
    return found.unionByName(passed.filter(~F.col("maybe_listed")).withColumn("listed", F.lit(False)))


def keep_listed(df: DataFrame, key: str, listed: DataFrame, probes: int = PROBES) -> DataFrame:
    """The rows of ``df`` whose ``key`` is one of the stored, distinct keys of ``listed``.

    The bounded filter takes most other rows out before anything is shuffled; a
    merge join with the list removes the rest.
    """
    bloom, blocks = build_bloom(listed, key, listed.count(), probes=probes)
    hit = F.lit(True)
    for w, m in enumerate(_mask(F.col(key), probes)):
        hit = hit & (F.col(f"__w{w}").bitwiseAND(m) == m)
    passed = df.withColumn("__b", _block(F.col(key), blocks)).join(
        F.broadcast(bloom), (F.col("__b") == F.col("__block")) & hit).select(*[F.col(f"`{c}`") for c in df.columns])
    # An inner join (the keys are distinct): a semi-join would be moved below the filter by the optimizer.
    return passed.join(listed.select(key).hint("merge"), key).select(*[F.col(f"`{c}`") for c in df.columns])


def listed_urls(pages: DataFrame, labels: list[str] = LISTED_LABELS, tracked_only: bool = True) -> DataFrame:
    """Canonical URLs of the pages on a host with one of the listed labels.

    With ``tracked_only``, those whose URL carries a tracking parameter: then neither the host nor a page's own
    URL tells whether it is listed (other URLs of a listed page are, other pages of its host need not be).
    """
    listed = F.arrays_overlap(F.split(host_of(F.col("url")), r"\."), F.array(*map(F.lit, labels)))
    if tracked_only:
        listed = listed & F.col("url").rlike(f"[?&]({TRACKING})=")
    return pages.filter(listed).select(canonical(F.col("url")).alias("canonical_url"))


def judge_urls(pages: DataFrame, listed: DataFrame, rules=RULES, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``pages`` with host, path, canonical_url, rule, maybe_listed, listed and verdict.

    The longest fitting rule decides; without one a listed URL is blocked and
    any other allowed. A null or odd URL has empty host and path: allowed.
    """
    new = ("host", "path", "canonical_url", "rule", "verdict")
    df = without(pages, *new).withColumns({
        "host": host_of(F.col("url")), "path": path_of(F.col("url")), "canonical_url": canonical(F.col("url"))})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    marked = mark_listed(df.withColumns({"rule": rule, "__v": verdict}), "canonical_url", listed, max_blocks)
    method = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return marked.withColumn("verdict", F.coalesce("__v", method)).drop("__v")
