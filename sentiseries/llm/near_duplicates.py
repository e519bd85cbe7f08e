"""Near-duplicate documents: MinHash, banding, verification, connected components.

A document's set is its distinct five-word shingles (words: runs other than space and
x09-x0D, A-Z lower-cased); with fewer words, the whole sequence. Documents are linked
with a Jaccard similarity of ``SIMILAR`` or more.

1. One pass over the texts gives each a digest of its words, the size of its set,
   ``BANDS`` x ``ROWS`` minima, kept as one key per band and one byte per minimum.
2. Equal digests are one class; only classes go on, so copies cost one row each. Classes
   are made in the pass itself; a second pass makes no more than the digests, to tell
   every row its class, so that no table of all rows is written.
3. Per band key, every class is compared with the key's centre, the class that shares
   keys with the most others. Pairs whose sizes exclude a link or whose bytes agree too
   rarely (``LIKELY``) are dropped; the rest is confirmed on the full sets.
4. Components by large-star and small-star. Inside a component nothing needs comparing.
5. Where a key still holds classes of different components, pairs across components are
   compared too. Shingles that at most ``RARE`` of these classes have tell most such pairs
   apart without comparing them: two classes either share a rare shingle, and are found
   by it, or their shared shingles are among the others, which bounds their similarity
   exactly. What the bound allows is confirmed on the full sets, and the components are
   made anew. A large group of near copies so costs about its size, not its square.

A pair at the least similarity shares no band key with probability (1-0.75^4)^32, about
5 in a million; the byte filter adds less than 1 in a million.

Null texts and texts without words have an empty set and are linked with nothing. Each
row is a document: repeated rows fall in one group, and a group's id is its smallest
doc_id that is not null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sentiseries.llm.common import folded_words, mixed, seeds, shingle_hashes
from sentiseries.llm.components import components
from sentiseries.sources.storage import stored

SIMILAR = 75
BANDS, ROWS = 32, 4
LIKELY = 0.55
RARE = 4
_PIECE = 2048
_MULTIPLIERS = seeds(BANDS * ROWS, 10)
_SIGNATURE = T.StructType([
    T.StructField("digest", T.BinaryType()), T.StructField("n_shingles", T.LongType()),
    T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("bytes", T.ArrayType(T.ByteType())),
])


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of every universal hash function over a set."""
    low = np.full(len(_MULTIPLIERS), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), _PIECE):
        np.minimum(low, (_MULTIPLIERS[:, None] * hashes[None, start : start + _PIECE]).min(axis=1), out=low)
    return low


def digest(text: str | None) -> bytes | None:
    """Digest of the words; none without words."""
    import xxhash

    tokens = folded_words(text)
    return xxhash.xxh3_128_digest(b" ".join(tokens)) if tokens else None


def signature(text: str | None) -> tuple[bytes | None, int, np.ndarray, np.ndarray]:
    """Digest of the words, set size, band keys, a byte of every minimum."""
    words = digest(text)
    if words is None:
        return None, 0, np.zeros(0, np.int64), np.zeros(0, np.int8)
    hashes = np.unique(shingle_hashes(text))
    low = minima(hashes)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in low.reshape(BANDS, ROWS).T:
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + row)
    return words, len(hashes), keys.view(np.int64), (mixed(low) & np.uint64(255)).astype(np.uint8).view(np.int8)


@F.pandas_udf(_SIGNATURE)
def signatures(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([signature(t) for t in batch], columns=_SIGNATURE.names)


@F.pandas_udf(T.BinaryType())
def digests(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([digest(t) for t in batch], dtype=object)


@F.pandas_udf(T.ArrayType(T.LongType()))
def shingle_sets(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([np.unique(shingle_hashes(t)).view(np.int64) for t in batch])


def _sizes_allow(n: Column, m: Column) -> Column:
    return 100 * F.least(n, m) >= SIMILAR * F.greatest(n, m)


def _likely(x: Column, y: Column) -> Column:
    """Enough bytes agree: of minima that differ, one in 256 bytes agrees anyway."""
    same = F.size(F.filter(F.zip_with(x, y, lambda a, b: a == b), lambda e: e))
    return same >= int(BANDS * ROWS * LIKELY)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes that are linked by their full sets."""
    left = pairs.join(sets.select(F.col("digest").alias("a"), F.col("shingles").alias("x")), "a")
    both = left.join(sets.select(F.col("digest").alias("b"), F.col("shingles").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    sized = both.select("a", "b", shared.alias("shared"), (F.size("x") + F.size("y")).alias("total"))
    return sized.filter(100 * F.col("shared") >= SIMILAR * (F.col("total") - F.col("shared"))).select("a", "b")


def _with_sketches(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose sizes and bytes leave a link likely."""
    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("digest").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("bytes").alias(f"bytes_{side}")), side)
    return pairs.filter(_sizes_allow(F.col("n_a"), F.col("n_b")) & _likely(F.col("bytes_a"), F.col("bytes_b"))).select("a", "b")


def _sets(documents: DataFrame, classes: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """(digest, shingles) of the ``wanted`` classes, read from one document of each."""
    holders = classes.join(wanted, "digest").select("row", "digest")
    texts = documents.select(_row(documents, key, text), F.col(text).alias("t")).join(holders, "row").dropDuplicates(["digest"])
    return stored(texts.select("digest", shingle_sets("t").alias("shingles")), "shingle_sets")


def _several_roots(rows: DataFrame) -> DataFrame:
    """Rows (k, root, ...) of the keys with classes of different components."""
    split = rows.groupBy("k").agg(F.min("root").alias("first"), F.max("root").alias("last")).filter("first <> last").select("k")
    return rows.join(split, "k")


def _across(shared: DataFrame, classes: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) off the stars that may be linked, of different components."""
    rooted = shared.filter("n > 2").select("k", "digest").join(roots.select(F.col("node").alias("digest"), "root"), "digest", "left")
    open_rows = stored(_several_roots(rooted.withColumn("root", F.coalesce("root", "digest"))), "open_rows")
    open_classes = open_rows.select("digest", "root").distinct()
    shingles = sets.join(open_classes, "digest").select("digest", "root", F.explode("shingles").alias("shingle"))
    scarce = shingles.groupBy("shingle").agg(F.count("*").alias("holders")).filter(F.col("holders") <= RARE)
    rare = stored(shingles.join(scarce, "shingle"), "rare_shingles")
    x, y = rare.filter("holders > 1").alias("x"), rare.filter("holders > 1").alias("y")
    by_rare = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.digest") < F.col("y.digest")) & (F.col("x.root") != F.col("y.root")))
    by_rare = _with_sketches(by_rare.select(F.col("x.digest").alias("a"), F.col("y.digest").alias("b")).distinct(), classes)

    # Without a common rare shingle two classes share at most what they have of the others.
    held = rare.groupBy("digest").agg(F.count("*").alias("r"))
    sized = open_rows.join(classes.select("digest", F.col("n_shingles").alias("m"), "bytes", "keys"), "digest").join(held, "digest", "left")
    sized = sized.withColumn("rest", F.col("m") - F.coalesce("r", F.lit(0)))
    least = sized.groupBy("k").agg(F.min("m").alias("least"))
    able = 100 * F.col("rest") >= SIMILAR * F.greatest("m", F.col("least") + F.col("m") - F.col("rest"))
    left = stored(_several_roots(sized.join(least, "k").filter(able).select("k", "digest", "root", "m", "rest", "bytes", "keys")), "open_keys")
    x, y = left.alias("x"), left.alias("y")
    most = F.least("x.rest", "y.rest")
    # a pair is made under the least key it shares only; both sides are under all keys they may meet at
    once = F.array_min(F.array_intersect("x.keys", "y.keys")) == F.col("x.k")
    bounded = x.join(
        y,
        (F.col("x.k") == F.col("y.k")) & (F.col("x.digest") < F.col("y.digest")) & (F.col("x.root") != F.col("y.root"))
        & (100 * most >= SIMILAR * (F.col("x.m") + F.col("y.m") - most)) & _likely(F.col("x.bytes"), F.col("y.bytes")) & once,
    )
    return by_rare.union(bounded.select(F.col("x.digest").alias("a"), F.col("y.digest").alias("b"))).distinct()


def _row(documents: DataFrame, key: str, text: str) -> Column:
    """Tells rows apart: the same for rows with equal id and text only."""
    return F.xxhash64(F.col(key), F.col(text)).alias("row")


def group(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_shingles, component_id, kept."""
    signed = documents.select(F.col(key).alias("id"), _row(documents, key, text), signatures(text).alias("s")).select("id", "row", "s.*")
    # texts without words are dropped by a total: a condition on the digest would be put before the pass, which then ran twice
    classes = stored(
        signed.groupBy("digest").agg(
            F.min("id").alias("least"), F.min("row").alias("row"), F.any_value("n_shingles").alias("n_shingles"),
            F.any_value("keys").alias("keys"), F.any_value("bytes").alias("bytes"),
        ).filter("n_shingles > 0"), "classes",
    )
    keyed = classes.select("digest", F.explode("keys").alias("k"))
    several = keyed.groupBy("k").agg(F.count("*").alias("n")).filter("n > 1")
    shared = stored(keyed.join(several, "k"), "shared")
    sets = _sets(documents, classes, shared.select("digest").distinct(), key, text)
    known = shared.groupBy("digest").agg(F.sum("n").alias("known"))
    centres = shared.join(known, "digest").groupBy("k").agg(F.max_by("digest", F.struct("known", "digest")).alias("centre"))
    star = shared.join(centres, "k").filter("digest <> centre")
    star = star.select(F.least("centre", "digest").alias("a"), F.greatest("centre", "digest").alias("b")).distinct()
    roots = components(_confirmed(_with_sketches(star, classes), sets))
    more = stored(_across(shared, classes, sets, roots), "open_pairs")
    # nodes linked to their roots have the components of the links
    joined = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    final = roots if more.isEmpty() else components(joined.union(_confirmed(more, sets)))
    members = classes.select("digest", "least").join(final, classes["digest"] == final["node"])
    ids = members.groupBy("root").agg(F.min("least").alias("component_id"))
    named = members.join(ids, "root").select("digest", "component_id")
    named = classes.join(named, "digest", "left").select("digest", "n_shingles", F.coalesce("component_id", "least").alias("component_id"))
    out = documents.select(F.col(key).alias("id"), digests(text).alias("digest")).join(named, "digest", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(key), F.coalesce("n_shingles", F.lit(0)).cast("long").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )
