"""Quality rules that vote or abstain, weighed by expectation-maximisation.

Every text is measured once (Python, one row at a time, no shuffle) and the measures
are stored. Rules are column expressions over the measures: 1 for good, 0 for bad,
2 to abstain. The number of documents of each pattern of votes, over all documents, is
all that the fit needs; there are at most 3 to the number of rules of them. The fit
gives each rule its probability of each vote in good and in bad documents, and the
posterior is a sum of logarithms, evaluated as a column expression.

Null and empty texts have no words: every measure is 0, the length rule votes bad.
Repeated rows are measured and returned as often as they occur, a null id like any other.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sentiseries.llm.common import SPACES, utf8, words
from sentiseries.sources.storage import stored

SYMBOLS = "#*$%&|<>"
WINDOW = 5
_MARKED = re.compile(r"(?:(?<=\s)|^)[^\s#*$%&|<>]*[#*$%&|<>]")
GOOD, BAD, ABSTAIN = 1, 0, 2
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_text_lines", "n_letters", "n_capitals", "n_exclaimed", "n_marked",
)


def repeated_words(tokens: list[bytes], window: int = WINDOW) -> int:
    """Words covered by windows that occur twice or more, the first occurrence included."""
    if len(tokens) <= window:
        return 0
    windows = list(zip(*(tokens[k:] for k in range(window))))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple, int] = {}
    again = bytearray(len(windows))
    for i, w in enumerate(windows):
        j = first.setdefault(w, i)
        if j != i:
            again[i] = again[j] = 1
    starts = np.frombuffer(again, np.uint8)
    edges = np.zeros(len(tokens) + 1, np.int64)
    edges[: len(starts)] += starts
    edges[window : window + len(starts)] -= starts
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def measure(text: str | None) -> tuple[int, ...]:
    """The values of ``MEASURES`` of one text."""
    text = text or ""
    tokens = words(text)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    codes = np.frombuffer(utf8(text), np.uint8)
    capitals = int(np.count_nonzero((codes >= 65) & (codes <= 90)))
    return (
        len(tokens),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(tokens),
        len(lines),
        capitals + int(np.count_nonzero(((codes >= 97) & (codes <= 122)) | (codes >= 0xC2))),
        capitals,
        text.count("!"),
        len(_MARKED.findall(text)),
    )


@F.pandas_udf(T.StructType([T.StructField(name, T.LongType()) for name in MEASURES]))
def measures(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([measure(t) for t in batch], columns=list(MEASURES))


def share(part: str, whole: str) -> Column:
    return F.col(part) / F.when(F.col(whole) > 0, F.col(whole))


def rule(bad: Column, good: Column) -> Column:
    return F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)


def fault(value: Column, bad: float, good: float) -> Column:
    """Bad above one bound, good below the other, else (or without a measure) no vote."""
    return rule(value > bad, value < good)


def rules() -> dict[str, Column]:
    """Each rule's vote.

    The fit learns from rules that agree, so every fault is measured in more than one way.
    """
    n = F.col("n_words")
    length = share("word_chars", "n_words")
    return {
        "length": rule(n < 10, n >= 30),
        "word_length": rule((length < 2) | (length > 14), (length >= 3) & (length <= 10)),
        "symbols_by_word": fault(share("n_symbols", "n_words"), 0.15, 0.03),
        "symbols_by_character": fault(share("n_symbols", "word_chars"), 0.03, 0.006),
        "words_with_symbols": fault(share("n_marked", "n_words"), 0.1, 0.03),
        "repeated_lines": fault(share("n_dup_lines", "n_text_lines"), 0.3, 0.01),
        "repeated_windows": fault(share("n_repeat_words", "n_words"), 0.2, 0.05),
        "capitals": fault(share("n_capitals", "n_letters"), 0.5, 0.2),
        "exclamations": fault(share("n_exclaimed", "n_words"), 0.3, 0.05),
    }


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 1000, tolerance: float = 1e-9) -> tuple[float, np.ndarray]:
    """Log odds of good before any vote, and for each rule and vote what the vote adds.

    ``patterns`` are (votes, number of documents). Starts from all-must-pass: bad where a
    rule says so. From the majority instead, a fault that few rules see would end in the
    good class.
    """
    if not patterns:
        return 0.0, np.zeros((0, 3))
    votes = np.array([p for p, _ in patterns])
    counts = np.array([n for _, n in patterns], float)
    cast = np.stack([votes == v for v in range(3)], axis=2).astype(float)
    posterior = np.where((votes == BAD).any(axis=1), 0.05, 0.95)
    for _ in range(rounds):
        sides = []
        for weight in (counts * posterior, counts * (1 - posterior)):
            sides.append(((weight @ cast.reshape(len(votes), -1)).reshape(-1, 3) + 1) / (weight.sum() + 3))
        prior = (counts @ posterior + 1) / (counts.sum() + 2)
        odds, adds = math.log(prior / (1 - prior)), np.log(sides[0]) - np.log(sides[1])
        before = posterior
        posterior = 1 / (1 + np.exp(-np.clip(odds + np.einsum("prv,rv->p", cast, adds), -700, 700)))
        if np.abs(posterior - before).max() < tolerance:
            break
    return odds, adds


def weigh(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, the measures, and ``quality``, the posterior of good."""
    measured = stored(documents.select(key, measures(text).alias("m")).select(key, "m.*"), "measures")
    votes = rules()
    patterns = measured.groupBy(*(v.alias(name) for name, v in votes.items())).agg(F.count("*").alias("n")).collect()
    odds, adds = fit([(tuple(r[name] for name in votes), r["n"]) for r in patterns])
    score = F.lit(float(odds))
    for j, vote in enumerate(votes.values()) if len(adds) else ():
        score += F.element_at(F.array(*(F.lit(float(x)) for x in adds[j])), (vote + 1).cast("int"))
    return measured.withColumn("quality", 1 / (1 + F.exp(-score)))


def base_failed() -> Column:
    """The two rules that no posterior overrules."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def kept(least: float = 0.5) -> Column:
    return ~base_failed() & (F.col("quality") >= least)
