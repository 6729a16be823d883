"""Quality rules: statistics of a text and a learned decision list over them.

Statistics come from one pass over each whole text (a pandas UDF; the
eight-word windows are compared exactly by rank doubling in numpy). The list
is learned by sequential covering on a bounded sample of labelled documents:
a rule is grown as a conjunction of thresholds on two thirds of the sample,
pruned on the rest, kept while it is precise there, and what it covers is
removed. The result is an ordered Spark conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import SPACES, UPPER, label_sample, sampled_texts, small_batches, without

# Fixed by the contract.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# The bound of the labelled sample, in documents (expected size).
MAX_LABELLED = 20_000

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_chars_all", "n_upper", "n_lower", "n_digits", "n_marks", "n_distinct"]
SCHEMA = ", ".join(f"{c} long" for c in COUNTS)


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words in ``window``-word windows that occur twice or more (window: a power of two)."""
    n = len(ids)
    if n <= window:
        return 0
    rank, length = ids, 1
    while length < window:
        pair = rank[: len(rank) - length] * (int(rank.max()) + 1) + rank[length:]
        _, rank, count = np.unique(pair, return_inverse=True, return_counts=True)
        if count.max() == 1:
            return 0
        length *= 2
    hit = np.flatnonzero(count[rank] > 1)
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + window, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def text_stats(text: str | None) -> tuple:
    """The ``COUNTS`` of a text; null and empty: no words, one line."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    parts = raw.split()
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in parts), dtype=np.int64, count=len(parts))
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if line in seen:
            dup += bool(line.strip(SPACES))
        else:
            seen.add(line)
    blanks = sum(raw.count(c.encode()) for c in SPACES)
    upper = len(raw) - len(raw.translate(None, UPPER.encode()))
    lower = len(raw) - len(raw.translate(None, UPPER.lower().encode()))
    digits = len(raw) - len(raw.translate(None, b"0123456789"))
    marks = len(raw) - len(raw.translate(None, b"!?.,;:"))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS.encode()))
    return (len(parts), len(text) - blanks, symbols, dup, repeated_words(ids), len(lines), len(text),
            upper, lower, digits, marks, len(index))


def _stats(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_stats(t) for t in texts], columns=COUNTS, dtype=np.int64)


def with_stats(docs: DataFrame) -> DataFrame:
    """``docs`` with the struct column ``__stats`` of its text's ``COUNTS``."""
    small_batches(docs.sparkSession)
    return without(docs, "__stats").withColumn("__stats", F.pandas_udf(_stats, SCHEMA)(F.col("text")))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def features(stats: str = "__stats") -> dict[str, Column]:
    """The statistics that rules may test, as columns over the counts."""
    c = {n: F.col(f"{stats}.{n}").cast("double") for n in COUNTS}
    return {
        "n_words": c["n_words"],
        "mean_word_chars": _ratio(c["word_chars"], c["n_words"]),
        "symbols_per_word": _ratio(c["n_symbols"], c["n_words"]),
        "marks_per_word": _ratio(c["n_marks"], c["n_words"]),
        "dup_line_share": _ratio(c["n_dup_lines"], c["n_lines"]),
        "repeat_word_share": _ratio(c["n_repeat_words"], c["n_words"]),
        "upper_share": _ratio(c["n_upper"], c["n_upper"] + c["n_lower"]),
        "digit_share": _ratio(c["n_digits"], c["word_chars"]),
        "distinct_per_word": _ratio(c["n_distinct"], c["n_words"]),
        "words_per_line": _ratio(c["n_words"], c["n_lines"]),
    }


@dataclass(frozen=True)
class Rule:
    """All of ``tests`` (feature, "<=" or ">=", threshold) hold -> reject."""

    tests: tuple[tuple[str, str, float], ...]

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), dtype=bool)
        for f, op, t in self.tests:
            out &= x[f] <= t if op == "<=" else x[f] >= t
        return out

    def column(self, feats: dict[str, Column]) -> Column:
        out = F.lit(True)
        for f, op, t in self.tests:
            out = out & (feats[f] <= F.lit(t) if op == "<=" else feats[f] >= F.lit(t))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{f} {op} {t:.6g}" for f, op, t in self.tests)


def _grow(x, bad, names, cuts, max_tests):
    """Add the threshold of highest information gain until no good row is covered."""
    tests: list = []
    inside = np.ones(len(bad), dtype=bool)
    while len(tests) < max_tests:
        p, n = (bad & inside).sum(), (~bad & inside).sum()
        if n == 0 or p == 0:
            break
        best, base = (1e-9, None, None), np.log2(p / (p + n))
        for f in names:
            v, order = x[f][inside], cuts[f]
            good_in, bad_in = np.sort(v[~bad[inside]]), np.sort(v[bad[inside]])
            for op, pp, nn in (
                ("<=", np.searchsorted(bad_in, order, "right"), np.searchsorted(good_in, order, "right")),
                (">=", p - np.searchsorted(bad_in, order, "left"), n - np.searchsorted(good_in, order, "left")),
            ):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pp > 0, pp * (np.log2(pp / (pp + nn)) - base), -1.0)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), (f, op, float(order[k])), None)
        if best[1] is None:
            break
        tests.append(best[1])
        inside &= Rule((best[1],)).covers(x)
    return tests


def learn(x: dict[str, np.ndarray], bad: np.ndarray, max_rules: int = 12, max_tests: int = 3,
          min_precision: float = 0.9, min_cover: int = 3, seed: int = 7) -> list[Rule]:
    """Sequential covering of the ``bad`` rows; empty when nothing precise is found."""
    rules: list[Rule] = []
    rng = np.random.default_rng(seed)
    left = np.ones(len(bad), dtype=bool)
    misses = 0  # a rule that fails its test is grown again on other splits before the list ends
    cuts = {f: np.unique(np.quantile(v, np.linspace(0, 1, 201))) if len(v) else v for f, v in x.items()}
    while len(rules) < max_rules and (bad & left).sum() >= min_cover and misses < 4:
        rows = np.flatnonzero(left)
        to_grow = np.zeros(len(bad), dtype=bool)
        to_grow[rng.permutation(rows)[: 2 * len(rows) // 3]] = True
        part = lambda m: ({f: v[m] for f, v in x.items()}, bad[m])
        gx, gy = part(to_grow)
        px, py = part(left & ~to_grow)
        tests = _grow(gx, gy, list(x), cuts, max_tests)
        if not tests:
            misses += 1
            continue

        def worth(t):
            c = Rule(tuple(t)).covers(px)
            p, n = (py & c).sum(), (~py & c).sum()
            return (p - n) / (p + n) if p + n else -1.0

        while len(tests) > 1 and worth(tests[:-1]) >= worth(tests):  # drop final tests that the held part does not need
            tests.pop()
        rule = Rule(tuple(tests))
        c = rule.covers(x) & left
        p, n = (bad & c).sum(), (~bad & c).sum()
        if p < min_cover or p < min_precision * (p + n) or worth(tests) < 2 * min_precision - 1:
            misses += 1
            continue
        rules.append(rule)
        left &= ~c
    return rules


def fit_rules(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> list[Rule]:
    """Learn the list from labelled documents (labels: doc_id, quality 0/1).

    Labels without a doc_id or quality are ignored; a document labelled both ways is bad, and one with
    several texts counts with the smallest. About ``max_labelled`` documents are
    taken, at most twice as many, so the broadcast side and what reaches the driver are
    bounded. Without labels there are no rules.
    """
    sample = label_sample(labels, F.min("quality"), max_labelled)
    rows = with_stats(sampled_texts(docs, sample))
    got = rows.select((F.col("__label") == 0).alias("__bad"), *[c.alias(f) for f, c in features().items()]).toPandas()
    if got.empty:
        return []
    return learn({f: got[f].to_numpy(float) for f in features()}, got["__bad"].to_numpy(bool))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``docs`` with ``__stats``, rule (text of the first rule that rejects, or null), base_failed and kept.

    The ordered list is one CASE expression; a text that fails the base rule
    is not kept whatever the list says.
    """
    s = lambda n: F.col(f"__stats.{n}")
    feats = features()
    rule = F.lit(None).cast("string")
    for r in reversed(rules):
        rule = F.when(r.column(feats), F.lit(str(r))).otherwise(rule)
    failed = (s("n_words") < MIN_WORDS) | (100 * s("n_repeat_words") > MAX_REPEAT_PERCENT * s("n_words"))
    out = with_stats(without(docs, "rule", "base_failed", "kept")).withColumns({"rule": rule, "base_failed": failed})
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
