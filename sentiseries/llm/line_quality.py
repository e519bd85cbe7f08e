"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are yes-or-no measures of the line itself and of
the lines before and after it; the chain adds weights for neighbouring labels. Lines of
a labelled document take its label; the weights are fitted to a bounded sample
(``PER_CLASS`` documents of either class) by gradient ascent on the penalised
likelihood. Texts of more than ``SPAN`` lines are learnt from in pieces of so many, all of
them: only the label pairs across the cuts are not counted, so that one long text neither
pads the others nor takes a step of Python for each of its lines. A document's score is the mean of its lines' marginal probabilities of good
(forward-backward), weighted by length in characters.

Null and empty texts and texts of white space have no line with a word: score 0. Texts
are scored whole, row by row, so repeated rows and null ids need no special care.
Without labelled documents of both classes every other text scores the share of good
labels, or 0.5 without any.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sentiseries.llm.common import SPACES, labelled_sample, utf8

PER_CLASS = 3000
PENALTY, ROUNDS, STEP = 2.0, 250, 0.1
#: Features of a line that its neighbours see too.
SHARED = 12
CELLS = 1 << 18
SPAN = 256


def counts(lines: list[str]) -> np.ndarray:
    """One row of raw counts per line: characters, words, and what ``features`` divides."""
    rows = []
    seen: set[str] = set()
    for line in lines:
        codes = np.frombuffer(utf8(line), np.uint8)
        tokens = line.split()
        kinds = np.bincount(codes, minlength=256)
        letters = kinds[97:123].sum() + kinds[0xC2:].sum()
        capitals = kinds[65:91].sum()
        rows.append((
            len(line), len(tokens), len(set(tokens)), capitals, letters + capitals, kinds[48:58].sum(),
            kinds[list(b"#*$%&<>@^~_=+\\")].sum(), kinds[ord("!")], kinds[ord("|")], kinds[list(b".,;:?")].sum(),
            sum(a == b for a, b in zip(tokens, tokens[1:])), line in seen,
            line.rstrip(SPACES)[-1:] in ".!?:;\"'", sum(len(t) > 20 for t in tokens),
        ))
        seen.add(line)
    return np.array(rows, float).reshape(len(rows), 14)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the lines with a word, and their yes-or-no features."""
    lines = [x for x in (text or "").split("\n") if x.strip(SPACES)]
    if not lines:
        return np.zeros(0), np.zeros((0, width()), np.uint8)
    c = counts(lines).T
    chars, n, distinct, capitals, letters, digits, symbols, shouts, bars, stops, echoes, again, ended, huge = c
    per_word = lambda x: x / np.maximum(n, 1)
    own = np.stack([
        per_word(symbols) > 0.1, per_word(symbols) > 0.5, per_word(shouts) > 0.3, per_word(bars) > 0.2,
        (capitals > 0.5 * letters) & (letters > 10), (per_word(distinct) < 0.7) & (n >= 20), (per_word(distinct) < 0.35) & (n >= 10),
        per_word(echoes) > 0.2, again > 0, n < 4, per_word(digits) > 1, letters < 0.5 * chars,
        n < 10, n >= 30, per_word(chars) < 3, per_word(chars) > 12, ended > 0, (stops == 0) & (n > 8),
        per_word(huge) > 0.1, capitals > 0.2 * letters, np.ones(len(lines)),
    ], axis=1).astype(np.uint8)
    before, after = np.zeros((2, len(lines), SHARED), np.uint8)
    before[1:], after[:-1] = own[:-1, :SHARED], own[1:, :SHARED]
    return chars, np.concatenate([own, before, after], axis=1)


def width() -> int:
    return 21 + 2 * SHARED


class Chain:
    """Weights of a two-label chain: a line's score for good, and of label pairs (bad 0, good 1)."""

    def __init__(self, weights: np.ndarray, pairs: np.ndarray):
        self.weights, self.pairs = weights, pairs

    def marginals(self, lines: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Of every sequence: P(good) by line; log of the summed scores; expected label pairs."""
        sizes = np.array([len(x) for x in lines])
        order = np.argsort(-sizes, kind="stable")
        sizes, longest = sizes[order], int(sizes.max(initial=0))
        emit = np.zeros((longest, len(lines), 2))
        for j, i in enumerate(order):
            emit[: sizes[j], j, 1] = lines[i] @ self.weights
        alive = np.array([(sizes > t).sum() for t in range(longest + 1)])
        forward, backward = np.zeros_like(emit), np.zeros_like(emit)
        pair_sums = np.zeros((len(lines), 2, 2))
        forward[:1] = emit[:1]
        for t in range(1, longest):
            k = alive[t]
            forward[t, :k] = emit[t, :k] + np.logaddexp.reduce(forward[t - 1, :k, :, None] + self.pairs, axis=1)
        total = np.zeros(len(lines))
        ends = np.flatnonzero(sizes)
        total[ends] = np.logaddexp.reduce(forward[sizes[ends] - 1, ends], axis=1)
        for t in range(longest - 2, -1, -1):
            k = alive[t + 1]
            reach = self.pairs + (emit[t + 1, :k] + backward[t + 1, :k])[:, None, :]
            backward[t, :k] = np.logaddexp.reduce(reach, axis=2)
            pair_sums[:k] += np.exp(forward[t, :k, :, None] + reach - total[:k, None, None])
        good = np.exp(np.minimum(forward[:, :, 1] + backward[:, :, 1] - total, 0))
        out: list[np.ndarray] = [np.zeros(0)] * len(lines)
        for j, i in enumerate(order):
            out[i] = good[: sizes[j], j]
        back = np.empty(len(lines), int)
        back[order] = np.arange(len(lines))
        return out, total[back], pair_sums[back]

    @classmethod
    def fit(cls, lines: list[np.ndarray], labels: np.ndarray, weights: np.ndarray) -> Chain:
        """Adam on the penalised log-likelihood, all sequences in every step, long ones in pieces."""
        scale = weights.sum()
        parts = [-(-len(x) // SPAN) for x in lines]
        lines = [x[a : a + SPAN] for x in lines for a in range(0, len(x), SPAN)]
        labels, weights = np.repeat(labels, parts), np.repeat(weights, parts)
        model = cls(np.zeros(width()), np.zeros((2, 2)))
        flat = np.concatenate(lines).astype(float)
        owner = np.repeat(np.arange(len(lines)), [len(x) for x in lines])
        seen = flat.T @ (weights * labels)[owner]
        steps = np.maximum(np.array([len(x) for x in lines]) - 1, 0) * weights
        seen_pairs = np.diag([(steps * (1 - labels)).sum(), (steps * labels).sum()])
        theta, first, second = np.zeros(width() + 4), np.zeros(width() + 4), np.zeros(width() + 4)
        for i in range(1, ROUNDS + 1):
            good, _, pairs = model.marginals(lines)
            slope = np.concatenate([
                seen - flat.T @ (weights[owner] * np.concatenate(good)),
                (seen_pairs - np.einsum("n,nij->ij", weights, pairs)).ravel(),
            ]) / scale - PENALTY * theta / scale
            first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
            theta = theta + STEP * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.999**i)) + 1e-8)
            model = cls(theta[:-4], theta[-4:].reshape(2, 2))
        return model


class Level:
    """What stands in for a chain where the labels do not show two classes."""

    def __init__(self, value: float):
        self.value = value

    def marginals(self, lines: list[np.ndarray]) -> tuple[list[np.ndarray], None, None]:
        return [np.full(len(x), self.value) for x in lines], None, None


@F.pandas_udf(T.BinaryType())
def _line_features(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: features(t)[1].tobytes())


def train(documents: DataFrame, labels: DataFrame, usable: Column, label: str = "quality", per_class: int = PER_CLASS) -> Chain | Level:
    sample = labelled_sample(documents, labels, label, usable, per_class)
    rows = sample.select(_line_features("text").alias("f"), "label", "weight").collect()
    rows = [(np.frombuffer(r["f"], np.uint8).reshape(-1, width()), r["label"], r["weight"]) for r in rows]
    rows = sorted((r for r in rows if len(r[0])), key=lambda r: (r[1], r[0].tobytes()))
    known = {y for _, y, _ in rows}
    if len(known) < 2:
        return Level(0.5 if not known else float(*known))
    return Chain.fit([r[0] for r in rows], np.array([r[1] for r in rows], float), np.array([r[2] for r in rows]))


def quality(model: Chain | Level, texts: list[str | None]) -> np.ndarray:
    """Scores of texts, those with about as many lines together, at most ``CELLS`` lines at once."""
    out = np.zeros(len(texts))
    measured = [(i, *features(t)) for i, t in enumerate(texts)]
    waiting = sorted((x for x in measured if len(x[1])), key=lambda x: -len(x[1]))
    while waiting:
        some = max(1, CELLS // len(waiting[0][1]))
        taken, waiting = waiting[:some], waiting[some:]
        for (i, sizes, _), good in zip(taken, model.marginals([x[2] for x in taken])[0]):
            out[i] = np.average(good, weights=sizes)
    return out


def score(text: Column | str, model: Chain | Level) -> Column:
    """0 to 1, higher is better."""
    packed = pickle.dumps(model)

    @F.pandas_udf(T.DoubleType())
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = pickle.loads(packed)
        for batch in texts:
            yield pd.Series(quality(known, list(batch)))

    return scored(text)
