"""Toxicity by a linear model over character n-grams scaled by naive Bayes ratios.

Features are the n-grams of ``SIZES`` bytes of the lower-cased text with runs of white
space as one space, hashed to ``BUCKETS``; a feature is present or not. From a bounded
sample (``PER_CLASS`` documents of either label) every feature gets the logarithm of
the ratio of its shares in toxic and other documents. Features whose shares do not
differ by more than chance (``LEAST_Z`` standard errors) get a ratio of 0, so that a long
text does not gather weight from common n-grams. A ridge-penalised logistic model over
the scaled features follows, weighted so that the classes keep their shares.

Null and empty texts have no n-gram and score the model's base rate. Texts are scored
whole, row by row, so repeated rows and null ids need no special care. Without labelled
documents of both classes every text scores the share of toxic labels, or 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sentiseries.llm.common import labelled_sample, mixed, utf8
from sentiseries.sources.storage import stored

SIZES = (4, 5, 6, 7)
BUCKETS = 1 << 20
PER_CLASS = 4000
LEAST_Z = 6.0
PENALTY, ROUNDS, STEP = 0.1, 1500, 0.05
#: Bytes that are hashed at once, to bound memory; a longer text is taken in overlapping pieces.
PIECE = 1 << 20


def plain(text: str | None) -> bytes:
    """Lower case, white space as single spaces, one in front and one behind."""
    return b" " + utf8(" ".join((text or "").lower().split())) + b" " if text else b""


def grams(data: bytes) -> Iterator[np.ndarray]:
    """Buckets of the n-grams, piece by piece, with repeats."""
    overlap = max(SIZES) - 1
    for start in range(0, max(len(data) - overlap, 1), PIECE):
        codes = np.frombuffer(data[start : start + PIECE + overlap], np.uint8).astype(np.uint64) + np.uint64(1)
        packed = np.zeros(len(codes), np.uint64)
        for n in range(1, max(SIZES) + 1):
            if len(codes) < n:
                break
            packed = (packed[: len(codes) - n + 1] << np.uint64(9)) | codes[n - 1 :]
            if n in SIZES:
                yield (mixed(packed) >> np.uint64(44)).astype(np.int64)


def present(text: str | None, chosen: np.ndarray) -> np.ndarray:
    """Buckets that occur in the text and are ``chosen`` (a mask)."""
    found = [g[chosen[g]] for g in grams(plain(text))]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def tallies(sample: DataFrame) -> DataFrame:
    """bucket, and how many sampled documents of either label have it."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, BUCKETS), np.int64)
        every = np.ones(BUCKETS, bool)
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"]):
                sums[label, present(text, every)] += 1
        bucket = np.flatnonzero(sums.any(axis=0))
        yield pd.DataFrame({"bucket": bucket, "clean": sums[0, bucket], "toxic": sums[1, bucket]})

    return (
        sample.select("text", "label").mapInPandas(count, "bucket long, clean long, toxic long")
        .groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )


def ratios(counts: DataFrame, n_clean: int, n_toxic: int) -> DataFrame:
    """bucket and log-count ratio, without buckets whose shares differ by chance."""
    p, q = (F.col("toxic") + 1) / (n_toxic + 2), (F.col("clean") + 1) / (n_clean + 2)
    pooled = (F.col("toxic") + F.col("clean") + 1) / (n_toxic + n_clean + 2)
    z = (p - q) / F.sqrt(pooled * (1 - pooled) * (1 / n_toxic + 1 / n_clean))
    return counts.filter(F.abs(z) > LEAST_Z).select("bucket", F.log(p / q).alias("ratio"))


def fit_linear(rows: list[np.ndarray], values: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge-penalised logistic weights over features of the given values, and a constant (Adam)."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    theta, first, second = (np.zeros(len(values) + 1) for _ in range(3))
    theta[:-1] = 0.1
    scale = weights.sum()
    for i in range(1, ROUNDS + 1):
        margin = theta[-1] + np.bincount(owner, (theta[:-1] * values)[column], len(rows))
        error = weights * (1 / (1 + np.exp(-np.clip(margin, -700, 700))) - labels)
        slope = np.append(np.bincount(column, error[owner], len(values)) * values + PENALTY * theta[:-1], error.sum()) / scale
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta = theta - STEP * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.999**i)) + 1e-8)
    return theta[:-1] * values, float(theta[-1])


class Model:
    """A weight for each kept bucket, and a constant."""

    def __init__(self, buckets: np.ndarray, weights: np.ndarray, constant: float):
        self.buckets, self.weights, self.constant = buckets, weights, constant

    def scores(self, texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        chosen, weight = np.zeros(BUCKETS, bool), np.zeros(BUCKETS)
        chosen[self.buckets], weight[self.buckets] = True, self.weights
        for batch in texts:
            margins = np.array([self.constant + weight[present(t, chosen)].sum() for t in batch])
            yield pd.Series(1 / (1 + np.exp(-np.clip(margins, -700, 700))))


def train(documents: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic", per_class: int = PER_CLASS) -> Model:
    sample = stored(labelled_sample(documents, labels, label, usable, per_class), "toxicity_sample")
    totals = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    none = np.zeros(0, np.int64)
    if len(totals) < 2:
        share = float(next(iter(totals), 0.5))
        return Model(none, np.zeros(0), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    kept_ratios = sorted(map(tuple, ratios(tallies(sample), totals[0], totals[1]).collect()))
    buckets, ratio = np.array([b for b, _ in kept_ratios], np.int64), np.array([r for _, r in kept_ratios])

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def kept(texts: pd.Series) -> pd.Series:
        mask = np.zeros(BUCKETS, bool)
        mask[buckets] = True
        return texts.map(lambda t: np.searchsorted(buckets, present(t, mask)))

    rows = sample.select(kept("text").alias("f"), "label", "weight").collect()
    rows.sort(key=lambda r: (r["label"], r["f"]))
    weights, constant = fit_linear(
        [np.array(r["f"], np.int64) for r in rows], ratio,
        np.array([r["label"] for r in rows], float), np.array([r["weight"] for r in rows]),
    )
    return Model(buckets, weights, constant)


def score(text: Column | str, model: Model) -> Column:
    """0 to 1, higher is likelier toxic."""
    buckets, weights, constant = model.buckets, model.weights, model.constant

    @F.pandas_udf(T.DoubleType())
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from Model(buckets, weights, constant).scores(texts)

    return scored(text)
