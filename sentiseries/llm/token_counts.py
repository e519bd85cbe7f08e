"""Token counts of texts; huge texts are encoded in overlapping chunks and spliced.

A text of up to ``CHUNK`` characters is encoded whole, by itself. A longer one is cut
every ``CHUNK`` characters, and each chunk also takes the first ``OVERLAP`` characters of
the next one. Chunks are dealt over all tasks and encoded with offsets. A chunk's first
tokens may be wrong, as it may begin inside a word, and so may its last ones. But where a
pre-tokenizer looks at nothing behind it, all tokens from a word's true start on depend
only on what follows; and whether a place is a word's start is settled once the next few
characters are seen. So the words that a chunk starts between its own true beginning and
``margin`` characters before its end are those of the text, and a place in the overlap
where both chunks start a word is a proven boundary: the left chunk counts up to it, the
right one from it. Over the chunks of a text, the tokens before and after the boundaries
add up to the text's. A text with an overlap without such a place, as inside a very long
run of letters, is cut again with wider overlaps, and larger chunks below them, until it
fits; at last it is one chunk.

Chunks of equal texts are encoded once. Only chunks are shuffled, not shorter texts.

This holds for byte-level pre-tokenizers with the usual pattern (``spliceable``); with
any other tokenizer every text is encoded whole. For the same tokenizers a shorter text
is also split at single spaces between two characters that are no white space, which are
always words' starts, and equal pieces are encoded once.

Counts are those of the tokenizer's library by its defaults, without special tokens
added; a special token's string inside a text is one token where the library makes it
one. Null and empty texts have no bytes and no tokens. Repeated rows and null keys are
counted like any other; an empty table gives an empty one. Columns of the table that are
called ``n_bytes`` or ``n_tokens`` are replaced, other names play no part.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sentiseries.llm.common import free_name
from sentiseries.sources.storage import stored

CHUNK = 32_768
OVERLAP = 512
#: An overlap grows by this factor where two chunks did not meet.
WIDER = 8
VOCABULARY = "byte_bpe_50k.json"
_KEPT = 300_000
_LONGEST_KEPT = 48
#: Single spaces between two characters that are no white space by any version of Unicode.
_SPACE = re.compile("(?<=[!-~\\u00a1-\\u167f\\u3001-\\ud7ff]) (?=[!-~\\u00a1-\\u167f\\u3001-\\ud7ff])")


def vocabulary() -> str:
    """The default vocabulary's place on this machine."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class Encoder:
    """A tokenizer file: ``.json`` by the tokenizers library, ``.model`` by sentencepiece."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.spliceable, self.margin, self._known = False, 0, {}
        if path.endswith(".model"):
            import sentencepiece

            self._pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            return
        from tokenizers import Tokenizer

        self._pieces = None
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        added = made.get("added_tokens") or []
        before = made.get("pre_tokenizer") or {}
        self.spliceable = (
            made.get("normalizer") is None and before.get("type") == "ByteLevel"
            and before.get("use_regex", True) and not before.get("add_prefix_space", True)
            and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in added)
            # strings that can overlap would be found one way or another by where a chunk begins
            and not any(b["content"].startswith(a["content"][k:]) for a in added for b in added for k in range(1, len(a["content"])))
        )
        # the pattern looks at most two characters past a word; a special string must be seen whole
        self.margin = max((len(t["content"]) for t in added), default=0) + 3

    def sizes(self, texts: list[str]) -> list[int]:
        """Tokens of each text, encoded whole."""
        if self._pieces is not None:
            return [len(ids) for ids in self._pieces.encode(texts, num_threads=1)]
        return [len(e) for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        """``sizes``, with equal pieces between single spaces encoded once."""
        if not self.spliceable:
            return self.sizes(texts)
        split = []
        for text in texts:
            pieces = _SPACE.split(text)
            pieces[1:] = [" " + p for p in pieces[1:]]
            split.append(pieces)
        known = self._known
        if len(known) > _KEPT:
            known.clear()
        fresh = list(set().union(*split).difference(known))
        known.update(zip(fresh, self.sizes(fresh)))
        counts = [sum(map(known.__getitem__, pieces)) for pieces in split]
        for piece in fresh:
            if len(piece) > _LONGEST_KEPT:
                del known[piece]
        return counts

    def words(self, text: str) -> tuple[np.ndarray, np.ndarray, int]:
        """Where words start (characters), the tokens before each, and the number of tokens."""
        encoded = self._tokenizer.encode(text, add_special_tokens=False)
        word = np.array(encoded.word_ids, np.int64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        starts = np.fromiter((a for a, _ in encoded.offsets), np.int64, len(word))
        return starts[first], first, len(word)


@functools.lru_cache(maxsize=4)
def encoder(path: str | None) -> Encoder:
    return Encoder(path or vocabulary())


def _counted(text: Column, path: str | None) -> Column:
    @F.pandas_udf(T.LongType())
    def counts(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(encoder(path).counts([t or "" for t in texts]), dtype="int64")

    return counts(text)


def pieces(text: str, chunk: int, overlap: int) -> Iterator[tuple[int, bool, str]]:
    """(number, whether it is the last one, text) of each chunk."""
    starts = range(0, max(1, len(text) - overlap), chunk)
    for k, start in enumerate(starts):
        last = k + 1 == len(starts)
        yield k, last, text[start:] if last else text[start : start + chunk + overlap]


def edges(text: str, k: int, last: bool, chunk: int, overlap: int, path: str | None = None) -> Iterator[tuple]:
    """What a chunk says: (edge, at, left, right, tokens).

    For the edge in front of it, and the one at its end, the words' starts in the overlap
    with the chunk's tokens before them, as ``right`` or ``left``; of the last chunk,
    one row more with all its tokens.
    """
    own = encoder(path)
    starts, before, total = own.words(text)
    if k:
        for at, n in zip(*(x[starts <= overlap].tolist() for x in (starts, before))):
            yield k, at, None, n, None
    if last:
        yield None, None, None, None, total
    else:
        near = (starts >= chunk) & (starts <= len(text) - own.margin)
        for at, n in zip(*(x[near].tolist() for x in (starts, before))):
            yield k + 1, at - chunk, n, None, None


def _cut(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in parts:
            for digest, text in zip(rows["digest"], rows["text"]):
                yield pd.DataFrame([(digest, *piece) for piece in pieces(text, chunk, overlap)], columns=["digest", "k", "last", "piece"])

    return long.mapInPandas(cut, "digest string, k long, last boolean, piece string").dropDuplicates(["digest", "k"])


def _said(chunks: DataFrame, chunk: int, overlap: int, path: str | None) -> DataFrame:
    names = ["edge", "at", "left", "right", "tokens"]

    def say(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in parts:
            for row in rows.itertuples():
                found = pd.DataFrame(list(edges(row.piece, row.k, row.last, chunk, overlap, path)), columns=names, dtype="Int64")
                found.insert(0, "digest", row.digest)
                found["need"] = found["tokens"].notna() * row.k
                if len(found):
                    yield found

    return chunks.mapInPandas(say, "digest string, edge long, at long, left long, right long, tokens long, need long")


def spliced(long: DataFrame, path: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(digest, n_tokens): one row for each different text of ``long`` (digest, text), counted by chunks."""
    done = None
    while True:
        said = stored(_said(_cut(long, chunk, overlap), chunk, overlap, path), "chunks")
        met = said.filter("edge is not null").groupBy("digest", "edge", "at").agg(F.max("left").alias("left"), F.max("right").alias("right"))
        met = met.filter("left is not null and right is not null").groupBy("digest", "edge").agg(F.min_by(F.col("left") - F.col("right"), "at").alias("tokens"))
        parts = met.select("digest", F.lit(1).cast("long").alias("met"), F.lit(0).cast("long").alias("need"), "tokens").union(
            said.filter("tokens is not null").select("digest", F.lit(0).cast("long"), "need", "tokens")
        )
        texts = stored(parts.groupBy("digest").agg(F.sum("met").alias("met"), F.sum("need").alias("need"), F.sum("tokens").alias("n_tokens")), "texts")
        fits = texts.filter("met = need").select("digest", "n_tokens")
        done = fits if done is None else done.union(fits)
        failed = texts.filter("met < need").select("digest")
        if failed.isEmpty():
            return done
        long = long.join(failed, "digest", "left_semi")
        overlap *= WIDER
        chunk = max(chunk, 4 * overlap)


def count(df: DataFrame, text: str = "text", path: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``df`` with n_bytes and n_tokens of ``text``.

    ``path`` is the tokenizer's file, the same on every machine; None takes ``vocabulary()`` there.
    """
    if overlap < 1 or chunk < 2 * overlap:
        raise ValueError("a chunk must be at least two overlaps long")
    if text in ("n_bytes", "n_tokens"):
        raise ValueError(f"the text must not be called {text}")
    df = df.drop("n_bytes", "n_tokens")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes")
    if not encoder(path).spliceable:
        return df.select("*", size, _counted(F.col(text), path).alias("n_tokens"))
    digest, huge = free_name(df, "digest"), F.length(text) > chunk
    short = df.filter(F.coalesce(~huge, F.lit(True))).select("*", size, _counted(F.col(text), path).alias("n_tokens"))
    long = df.filter(huge).withColumn(digest, F.sha2(F.col(text), 256))
    found = spliced(long.select(F.col(digest).alias("digest"), F.col(text).alias("text")), path, chunk, overlap)
    counted = long.join(found.withColumnRenamed("digest", digest), digest).select(*(F.col(c) for c in df.columns), size, "n_tokens")
    return short.unionByName(counted)
