"""Benchmark items inside documents: size-partitioned MinHash containment search.

Items and documents are five-word shingles (as in ``near_duplicates``). An item is
contained in a document if at least ``CONTAINED`` per cent of its distinct shingles are
among the document's.

Items are partitioned by size: an item belongs to the smallest block length (a power of
two) that is no less than its number of shingles. A document's shingles are cut into
blocks of each length in use; any item inside the document lies in two neighbouring
blocks, so its Jaccard similarity to that window stays above a sixth however long the
document is. An item and a window that share any of ``HASHES`` minima are a candidate;
missing all of them has a probability of about 1 in 10^5. Items so small that every
shingle must be there (three or fewer) would be missed more often; they are looked up by
their least shingle instead, which misses none. Candidates are checked by exact
containment in the document.

The documents are read once for every block of up to ``ITEMS`` benchmark items or
``CHARACTERS`` characters, whose index is broadcast; a larger benchmark is taken in more
such blocks. Texts are never shuffled.

Null and empty texts and items have no shingles and are in no pair; a text or an item of
fewer than five words is one shingle. Rows are pairs of a document row and an item row:
repeated rows repeat them, null ids are returned as null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from sentiseries.llm.common import mixed, seeds, shingle_hashes
from sentiseries.sources.storage import stored

CONTAINED = 75
HASHES = 64
ITEMS, CHARACTERS = 50_000, 1 << 26
LEAST = 8
_PIECE = 1 << 15
_SIEVE = 1 << 22
_MULTIPLIERS = seeds(HASHES, 7)


def _tags(values: np.ndarray, length: int) -> np.ndarray:
    """Minima (one row per hash function) with the function and the block length mixed in."""
    salt = np.arange(1, HASHES + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(length)
    return mixed(values ^ salt)


class Index:
    """The items of one block: their shingles, and items by the tags of their minima."""

    def __init__(self, texts: list[str | None]):
        self.items: list[np.ndarray] = [np.unique(shingle_hashes(t)) for t in texts]
        self.lengths: list[int] = []
        self.sieve = np.zeros(_SIEVE, bool)
        tags: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        small: list[tuple[int, int]] = []
        for i, item in enumerate(self.items):
            if len(item) and (100 - CONTAINED) * len(item) < 100:
                small.append((int(item[0]), i))
            elif len(item):
                length = max(LEAST, 1 << (len(item) - 1).bit_length())
                if length not in self.lengths:
                    self.lengths.append(length)
                low = (_MULTIPLIERS[:, None] * item[None, :]).min(axis=1, keepdims=True)
                tags.append(_tags(low, length)[:, 0])
                owners.append(np.full(HASHES, i, np.int32))
        self.lengths.sort()
        every = np.concatenate(tags) if tags else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.tags = every[order]
        self.owners = np.concatenate(owners)[order] if owners else np.zeros(0, np.int32)
        self.sieve[(every % np.uint64(_SIEVE)).astype(np.int64)] = True
        small.sort()
        self.least = np.array([s for s, _ in small], np.uint64)
        self.small = np.array([i for _, i in small], np.int32)

    def windows(self, hashes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, start, end) of windows of ``hashes`` that share a minimum with an item."""
        longest = self.lengths[-1] if self.lengths else 0
        piece = max(_PIECE, 4 * longest)
        for start in range(0, len(hashes) if longest else 0, piece):
            # pieces overlap by two blocks, so that no window is cut
            part = hashes[start : start + piece + 2 * longest]
            low = np.stack([np.minimum.reduceat(m * part, np.arange(0, len(part), LEAST)) for m in _MULTIPLIERS])
            length = LEAST
            while True:
                if length in self.lengths:
                    pairs = np.minimum(low[:, :-1], low[:, 1:]) if low.shape[1] > 1 else low
                    tags = _tags(pairs, length)
                    h, w = np.nonzero(self.sieve[(tags % np.uint64(_SIEVE)).astype(np.int64)])
                    first = np.searchsorted(self.tags, tags[h, w], side="left")
                    after = np.searchsorted(self.tags, tags[h, w], side="right")
                    for j in np.flatnonzero(first < after):
                        for i in self.owners[first[j] : after[j]].tolist():
                            yield i, start + int(w[j]) * length, start + int(w[j] + 2) * length
                if length >= longest:
                    break
                length *= 2
                low = np.minimum.reduceat(low, np.arange(0, low.shape[1], 2), axis=1)

    def places(self, hashes: np.ndarray) -> Iterator[tuple[int, int]]:
        """(item, place) of the least shingles of small items in ``hashes``."""
        if len(self.least):
            first = np.searchsorted(self.least, hashes, side="left")
            after = np.searchsorted(self.least, hashes, side="right")
            for j in np.flatnonzero(first < after).tolist():
                for i in self.small[first[j] : after[j]].tolist():
                    yield i, j

    def search(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, shared shingles, shingles of the item) of all containments."""
        hashes = [shingle_hashes(t) for t in texts]
        ends = np.cumsum([len(h) for h in hashes])
        joined = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        candidates = set()
        for i, start, end in self.windows(joined):
            first, last = np.searchsorted(ends, [start, min(end, len(joined)) - 1], side="right")
            candidates.update((t, i) for t in range(first, last + 1))
        candidates.update((int(np.searchsorted(ends, j, side="right")), i) for i, j in self.places(joined))
        known: tuple[int, np.ndarray] | None = None
        for t, i in sorted(candidates):
            if known is None or known[0] != t:
                known = t, np.unique(hashes[t])
            item = self.items[i]
            shared = int(np.isin(item, known[1], assume_unique=True).sum())
            if 100 * shared >= CONTAINED * len(item):
                yield t, i, shared, len(item)


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[list]:
    rows = items.select(F.col(key).alias("k"), F.col(text).alias("t")).toLocalIterator()
    block: list = []
    size = 0
    for row in rows:
        if len(block) == ITEMS or size + len(row["t"] or "") > CHARACTERS and block:
            yield block
            block, size = [], 0
        block.append(row)
        size += len(row["t"] or "")
    if block:
        yield block


def contained(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Pairs: key, item_key, n_shared, n_item (distinct shingles)."""
    spark = documents.sparkSession
    kinds = [documents.schema[key].dataType, items.schema[item_key].dataType]
    schema = T.StructType([
        T.StructField(key, kinds[0]), T.StructField(item_key, kinds[1]), T.StructField("n_shared", T.LongType()), T.StructField("n_item", T.LongType()),
    ])
    hit = T.ArrayType(T.StructType([T.StructField("place", T.IntegerType()), T.StructField("shared", T.LongType()), T.StructField("total", T.LongType())]))
    found = spark.createDataFrame([], schema)
    for block in _blocks(items, item_key, item_text):
        shared = spark.sparkContext.broadcast(Index([r["t"] for r in block]))

        @F.pandas_udf(hit)
        def search(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in texts:
                hits: list[list[dict]] = [[] for _ in batch]
                for t, i, n, total in shared.value.search(list(batch)):
                    hits[t].append({"place": i, "shared": n, "total": total})
                yield pd.Series(hits, dtype=object)

        ids = spark.createDataFrame([(i, r["k"]) for i, r in enumerate(block)], T.StructType([T.StructField("place", T.IntegerType()), T.StructField("item", kinds[1])]))
        pairs = documents.select(F.col(key).alias("k"), F.explode(search(text)).alias("h")).select("k", "h.*")
        pairs = pairs.join(F.broadcast(ids), "place").select(F.col("k").alias(key), F.col("item").alias(item_key), F.col("shared").alias("n_shared"), F.col("total").alias("n_item"))
        found = found.union(stored(pairs, "containment"))
        shared.destroy()
    return found
