"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

``P(grade <= k) = sigmoid(theta_k - w.x)`` with one weight vector for all
ordered thresholds; the score is the expected grade ``sum_k P(grade > k)``.
Features are the words of a text (A-Z folded, ASCII punctuation and digits cut
off), as ``log(1 + count)``, kept if labelled documents show a clear
association. Fitting uses a bounded sample of labelled documents; scoring
covers every word of every document.
"""

from __future__ import annotations

import string
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import UPPER, label_sample, sampled_texts, small_batches, stage, without

# The bound of the labelled sample, in documents (expected size).
MAX_LABELLED = 12_000
MIN_DOCS = 4
MIN_Z = 4.0
MAX_FEATURES = 5_000

_CUT = bytes.maketrans((UPPER + string.punctuation + string.digits).encode(),
                       (UPPER.lower() + " " * len(string.punctuation + string.digits)).encode())


def word_counts(text: str | None) -> Counter:
    return Counter(text.encode("utf-8", "surrogatepass").translate(_CUT).split()) if text else Counter()


@dataclass
class OrdinalModel:
    """weights by feature id (crc32 of the word) and ascending thresholds."""

    weights: dict[int, float]
    thresholds: np.ndarray

    def linear(self, counts: Counter) -> float:
        get = self.weights.get
        return float(sum(w * np.log1p(c) for word, c in counts.items()
                         if (w := get(zlib.crc32(word))) is not None))

    def above(self, s: float) -> np.ndarray:
        """P(grade > k) for each threshold k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - s, -500, 500)))


def fit_ordinal(row: np.ndarray, col: np.ndarray, value: np.ndarray, grade: np.ndarray, n_features: int,
                steps: int = 400, rate: float = 0.05, l2: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by Adam on the mean negative log-likelihood of sparse rows."""
    n, k = len(grade), int(grade.max()) if len(grade) else 0
    share = np.array([(grade <= j).mean() for j in range(k)]) if k else np.empty(0)
    share = np.clip(share, 1e-3, 1 - 1e-3)
    theta = np.maximum.accumulate(np.log(share / (1 - share)) + np.arange(k) * 1e-3)
    # thresholds as first value and log gaps, so that they stay ordered
    params = np.concatenate([np.zeros(n_features), theta[:1], np.log(np.diff(theta) + 1e-3)])
    m = v = np.zeros_like(params)
    rows = np.arange(n)
    for t in range(1, steps + 1 if k else 1):
        w, first, gaps = params[:n_features], params[n_features], np.exp(params[n_features + 1 :])
        theta = first + np.concatenate([[0.0], np.cumsum(gaps)])
        s = np.bincount(row, weights=value * w[col], minlength=n)
        below = np.zeros((n, k + 2))
        below[:, k + 1] = 1
        below[:, 1 : k + 1] = 1 / (1 + np.exp(np.clip(s[:, None] - theta[None, :], -500, 500)))
        slope = below * (1 - below)
        p = np.maximum(below[rows, grade + 1] - below[rows, grade], 1e-12)
        ds = (slope[rows, grade + 1] - slope[rows, grade]) / p / n
        dtheta = np.zeros(k)
        for j in range(k):
            here = slope[:, j + 1] / p / n
            dtheta[j] = here[grade == j + 1].sum() - here[grade == j].sum()
        tail = np.cumsum(dtheta[::-1])[::-1]
        g = np.concatenate([np.bincount(col, weights=value * ds[row], minlength=n_features) + l2 * w,
                            tail[:1], tail[1:] * gaps])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        params = params - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    gaps = np.exp(params[n_features + 1 :])
    return params[:n_features], params[n_features] + np.concatenate([[0.0], np.cumsum(gaps)]) if k else theta


def _sample_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for toxic, text in zip(pdf["toxic"], pdf["text"]):
            c = word_counts(text)
            rows.append((int(toxic > 0), [zlib.crc32(w) for w in c], list(c.values())))
        yield pd.DataFrame(rows, columns=["toxic", "ids", "counts"])


def _chosen_only(chosen: np.ndarray):
    """Rows of the sample reduced to the chosen words, with the count of all words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for toxic, ids, counts in zip(pdf["toxic"], pdf["ids"], pdf["counts"]):
                col = np.searchsorted(chosen, ids)
                here = chosen[np.minimum(col, len(chosen) - 1)] == ids
                rows.append((toxic, col[here], counts[here], int(counts.sum())))
            yield pd.DataFrame(rows, columns=["toxic", "cols", "counts", "total"])

    return run


def associated_words(sample: DataFrame, n1: int, n0: int) -> pd.DataFrame:
    """(id, z) of the words that labelled documents associate most with a label, by id.

    ``sample``: toxic 0/1 and ids, one row a document, ``n1`` toxic and ``n0``
    clean ones. Documents are counted per word in Spark; at most
    ``MAX_FEATURES`` rows reach the driver.
    """
    count = sample.select("toxic", F.explode("ids").alias("id")).groupBy("id").agg(
        F.sum("toxic").alias("d1"), F.count("*").alias("d"))
    p = (F.col("d") + 1) / F.lit(n1 + n0 + 2)
    gap = (F.col("d1") + 0.5) / F.lit(n1 + 1) - (F.col("d") - F.col("d1") + 0.5) / F.lit(n0 + 1)
    z = gap / F.sqrt(p * (1 - p) * F.lit(1 / n1 + 1 / n0))
    strong = count.filter(F.col("d") >= MIN_DOCS).select("id", z.alias("z")).filter(F.abs("z") >= MIN_Z)
    return strong.orderBy(F.desc(F.abs("z")), "id").limit(MAX_FEATURES).toPandas().sort_values("id")


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> OrdinalModel | None:
    """Fit on labelled documents (labels: doc_id, toxic 0/1), or None without toxic and clean ones.

    Grades: 0 for clean documents; toxic ones are 1, and 2 where the share of
    associated words is above the median of the toxic ones. Null labels are
    ignored; a document labelled both ways is toxic, and one with several texts counts with the
    smallest. About ``max_labelled`` documents are taken, at most twice as many;
    their counts of chosen words reach the driver, their texts do not.
    """
    small_batches(docs.sparkSession)
    picked = label_sample(labels, F.max("toxic"), max_labelled)
    joined = sampled_texts(docs, picked).select(F.col("__label").cast("int").alias("toxic"), "text")
    sample = stage(joined.mapInPandas(
        _sample_features, "toxic int, ids array<long>, counts array<int>"), "toxicity-sample")
    size = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("n1")).first()
    n1, n0 = size["n1"], size["n"] - size["n1"]
    if not n1 or not n0:
        return None
    words = associated_words(sample, n1, n0)
    if words.empty:
        return None
    got = sample.mapInPandas(_chosen_only(words["id"].to_numpy(np.int64)),
                             "toxic int, cols array<int>, counts array<int>, total long").toPandas()
    return fit_sample(got, words["id"].to_numpy(), words["z"].to_numpy())


def fit_sample(rows: pd.DataFrame, ids: np.ndarray, z: np.ndarray) -> OrdinalModel:
    """Fit on documents given as toxic 0/1, cols (places in ``ids``), counts and total words."""
    toxic = rows["toxic"].to_numpy() > 0
    row = np.repeat(np.arange(len(rows)), [len(x) for x in rows["cols"]])
    col = np.concatenate([np.asarray(x, dtype=np.int64) for x in rows["cols"]])
    tf = np.concatenate([np.asarray(x, dtype=np.float64) for x in rows["counts"]])
    hit = z[col] > 0
    density = np.bincount(row[hit], weights=tf[hit], minlength=len(rows)) / np.maximum(1, rows["total"].to_numpy())
    grade = toxic.astype(int)
    grade[toxic & (density > np.median(density[toxic]))] = 2
    w, theta = fit_ordinal(row, col, np.log1p(tf), grade, len(ids))
    return OrdinalModel({int(f): float(x) for f, x in zip(ids, w)}, theta)


def score_toxicity(docs: DataFrame, model: OrdinalModel | None) -> DataFrame:
    """``docs`` with severity (expected grade), p_toxic (P(grade > 0)), grade (most
    likely) and toxic (p_toxic >= 0.5). Null and empty texts have no features;
    without a model every document has severity 0."""
    small_batches(docs.sparkSession)

    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            above = model.above(model.linear(word_counts(text))) if model else np.zeros(1)
            cells = -np.diff(np.concatenate([[1.0], above, [0.0]]))
            rows.append((float(above.sum()), float(above[0]), int(np.argmax(cells)), bool(above[0] >= 0.5)))
        return pd.DataFrame(rows, columns=["severity", "p_toxic", "grade", "toxic"])

    new = ("severity", "p_toxic", "grade", "toxic")
    found = F.pandas_udf(run, "severity double, p_toxic double, grade int, toxic boolean")(F.col("text"))
    base = without(docs, "__tox", *new)
    out = base.withColumn("__tox", found)
    return out.select(*[F.col(f"`{c}`") for c in base.columns], *[F.col(f"__tox.{c}").alias(c) for c in new])
