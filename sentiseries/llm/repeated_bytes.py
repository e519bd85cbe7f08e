"""Long byte strings that occur more than once in a corpus: hash-compared suffix sort.

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else, in any
text, is removed. Sorting the suffixes of every position would move many times the
corpus, so only suffixes at chosen positions are sorted, which loses nothing:

1. Anchors. A string of ``LENGTH`` bytes has ``WINDOW`` starts of ``GRAM``-byte grams; the
   gram with the least hash (prefix polynomial hashes, leftmost of equals) is its anchor.
   Equal strings have the same anchor at the same place, so strings that repeat are found
   among anchors whose grams repeat. About one position in a hundred is an anchor.
2. Surroundings. An anchor's surroundings reach as far as strings around it can. Equal
   surroundings are one class. A class with more than one place is covered whole.
3. Suffix sort. Grams with more than one class are dealt out; a task sorts the suffixes
   that start at the anchors, by mergesort whose comparisons find the common extension
   of two suffixes by binary search over prefix hashes. Common prefixes of neighbours are
   then read from the bytes, which verifies the order. For each number d of bytes before
   the anchor, suffixes that share LENGTH - d bytes (neighbours in the order) and the d
   bytes in front hold the same string. The first and last such d give what is covered;
   the two strings are compared byte by byte with their partners'.
4. A gram with more than ``CLASSES`` classes is not sorted in one task: its strings are
   counted one by one by 128-bit hashes, with partial sums before the shuffle.

Texts are the same if 64-bit hash and length are; a text that occurs in several rows is
covered whole. Texts move once, candidates' texts twice more. Null and empty texts have
no bytes: 0, 0, 0 and the digest of nothing. Texts under ``LENGTH`` bytes stay as they
are. Long texts are cut into overlapping pieces for hashing only. Null ids and repeated
rows are returned as they come.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sentiseries.llm.common import mixed
from sentiseries.sources.storage import stored

LENGTH = 400
GRAM = 200
WINDOW = LENGTH - GRAM + 1
CLASSES = 8192
_PIECE = 1 << 19
_PLACE = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}
_CODES = [mixed(np.arange(256, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(s)) | np.uint64(1) for s in (1, 2)]


def _powers(base: int, count: int) -> np.ndarray:
    """1, base, base squared and so on, modulo 2 to the 64."""
    if len(_POWERS.get(base, ())) < count:
        steps = np.full(max(count, 2 * _PIECE), base, np.uint64)
        steps[0] = 1
        _POWERS[base] = np.cumprod(steps)
    return _POWERS[base][:count]


class Hashes:
    """Prefix polynomial hashes of a byte string; any substring's hash in one step."""

    def __init__(self, data: np.ndarray, table: int = 0):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_CODES[table][data] * _powers(_BASE, len(data)), out=self.sums[1:])

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * _powers(_INVERSE, len(self.sums))[start]

    def every(self, length: int) -> np.ndarray:
        """Hashes of all substrings of one length."""
        count = len(self.sums) - length
        return (self.sums[length:] - self.sums[:count]) * _powers(_INVERSE, count)

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common extension at a and b, up to ``most``, by binary search."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = self.of(a, middle) == self.of(b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` values in a row, by running minima from both ends of blocks."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes of several texts, or of a part of one: with text, offset in it and end in the piece, by start."""
    group: list[tuple[int, int, bytes]] = []
    size = 0

    def joined():
        data = np.frombuffer(b"".join(g[2] for g in group), np.uint8)
        lengths = np.array([len(g[2]) for g in group])
        return data, np.array([g[0] for g in group]), np.array([g[1] for g in group]), np.cumsum(lengths)

    for i, text in enumerate(texts):
        for start in range(0, max(len(text) - LENGTH + 1, 0), _PIECE - LENGTH + 1):
            part = text[start : start + _PIECE]
            if size + len(part) > _PIECE and group:
                yield joined()
                group, size = [], 0
            group.append((i, start, part))
            size += len(part)
    if group:
        yield joined()


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, hash of the gram there) of all anchors."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for data, owner, offset, ends in pieces(texts):
        grams = mixed(Hashes(data).every(GRAM))
        ranked = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        least = sliding_least(ranked, WINDOW)
        begins = np.concatenate([[0], ends[:-1]])
        # only strings inside one text
        inside = np.concatenate([np.arange(b, e - LENGTH + 1) for b, e in zip(begins, ends)])
        place = np.unique((least[inside] & _PLACE).astype(np.int64))
        which = np.searchsorted(ends, place, side="right")
        found.append((owner[which], place - begins[which] + offset[which], grams[place].view(np.int64)))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    who, where, gram = (np.concatenate(x) for x in zip(*found))
    # pieces of a long text overlap
    _, first = np.unique(np.stack([who, where]), axis=1, return_index=True)
    return who[first], where[first], gram[first]


_ANCHOR = T.ArrayType(T.StructType([T.StructField("at", T.LongType()), T.StructField("gram", T.LongType())]))


@F.pandas_udf(_ANCHOR)
def _anchor_lists(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        who, where, gram = anchors([t or b"" for t in batch])
        lists: list[list[dict]] = [[] for _ in batch]
        for i, at, g in zip(who.tolist(), where.tolist(), gram.tolist()):
            lists[i].append({"at": at, "gram": g})
        yield pd.Series(lists, dtype=object)


def around(text: bytes, at: int) -> tuple[int, bytes]:
    """Bytes before an anchor that strings around it can have, and its surroundings."""
    at = int(at)
    before = min(at, WINDOW - 1)
    return before, text[at - before : at + LENGTH]


@F.pandas_udf(T.ArrayType(T.LongType()))
def _surrounding_hashes(texts: pd.Series, places: pd.Series) -> pd.Series:
    import xxhash

    out = []
    for text, ats in zip(texts, places):
        found = (around(text, at) for at in ats)
        out.append([xxhash.xxh3_64_intdigest(s, seed=b) - (1 << 63) for b, s in found])
    return pd.Series(out, dtype=object)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("before", T.IntegerType()), T.StructField("bytes", T.BinaryType())])))
def _surroundings(texts: pd.Series, places: pd.Series) -> pd.Series:
    return pd.Series([[dict(zip(("before", "bytes"), around(text, at))) for at in ats] for text, ats in zip(texts, places)], dtype=object)


def suffix_order(hashes: Hashes, data: np.ndarray, start: np.ndarray, length: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Suffixes (of bounded length) sorted inside their groups, which are adjacent: a mergesort.

    Runs double in every round. A suffix's place in the merged run is its place in its
    own run and the number of the sibling's suffixes before it, found by binary search;
    all searches of a round go on together, each comparison by one common extension.
    """
    order = np.arange(len(start))
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(first, len(group)))
    base, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
    run = 1
    while run < size.max(initial=0):
        place = np.arange(len(order)) - base
        mine = place // run
        other = mine ^ 1
        low, high = np.minimum(other * run, size), np.minimum((other + 1) * run, size)
        begin = low.copy()
        while (busy := np.flatnonzero(low < high)).size:
            middle = (low[busy] + high[busy]) >> 1
            x, y = order[busy], order[base[busy] + middle]
            most = np.minimum(length[x], length[y])
            common = hashes.common(start[x], start[y], most)
            inner = common < most
            last = len(data) - 1
            px, py = data[np.minimum(start[x] + common, last)].astype(int), data[np.minimum(start[y] + common, last)].astype(int)
            # equal suffixes keep their order: those of the left run come first
            before = np.where(inner, py < px, np.where(length[x] != length[y], length[y] < length[x], mine[busy] % 2 == 1))
            low[busy] = np.where(before, middle + 1, low[busy])
            high[busy] = np.where(before, high[busy], middle)
        target = base + (mine // 2) * 2 * run + place % run + (low - begin)
        merged = np.empty_like(order)
        merged[target] = order
        order, run = merged, 2 * run
    return order


def _rows(data: np.ndarray, start: np.ndarray, length: np.ndarray, most: int, step: int = 1) -> np.ndarray:
    """The bytes after each start (or before it, with step -1) as rows; -1 past the end."""
    places = start[:, None] + step * np.arange(most)[None, :]
    return np.where(np.arange(most)[None, :] < length[:, None], data[np.clip(places, 0, len(data) - 1)].astype(np.int16), np.int16(-1))


def reaches(group: np.ndarray, before: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For surroundings, adjacent by gram: most and fewest bytes before the anchor in strings that others share; -1 if none."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    start = np.cumsum(sizes) - sizes + before
    after = sizes - before
    hashes = Hashes(data)
    order = suffix_order(hashes, data, start, after, group)
    right = _rows(data, start, after, LENGTH)
    ahead, here = right[order[:-1]], right[order[1:]]
    differ = ahead != here
    same_group = group[order[1:]] == group[order[:-1]]
    at = np.where(differ.any(axis=1), differ.argmax(axis=1), LENGTH)
    lines = np.arange(len(at))
    if (same_group & (at < LENGTH) & (ahead[lines, np.minimum(at, LENGTH - 1)] > here[lines, np.minimum(at, LENGTH - 1)])).any():
        # two hashes were equal by chance: order by the bytes themselves
        order = np.array(sorted(range(len(texts)), key=lambda i: (np.searchsorted(np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])), i, side="right"), right[i].tobytes())))
        ahead, here = right[order[:-1]], right[order[1:]]
        differ = ahead != here
        same_group = group[order[1:]] == group[order[:-1]]
        at = np.where(differ.any(axis=1), differ.argmax(axis=1), LENGTH)
    common = np.where(same_group, np.minimum(at, np.minimum(after[order[1:]], after[order[:-1]])), -1)
    most, fewest = np.full(len(texts), -1), np.full(len(texts), -1)
    for d in range(WINDOW):
        run = np.concatenate([[0], np.cumsum(common < LENGTH - d)]).astype(np.uint64)
        fits = np.flatnonzero((before[order] >= d) & (after[order] >= LENGTH - d))
        if len(fits) < 2:
            continue
        own = order[fits]
        key = mixed(run[fits] * np.uint64(_BASE) + hashes.of(start[own] - d, d))
        ranked = np.argsort(key, kind="stable")
        twin = key[ranked[1:]] == key[ranked[:-1]]
        if not twin.any():
            continue
        x, y = own[ranked[1:][twin]], own[ranked[:-1][twin]]
        if d:  # equal hashes of the bytes in front are compared byte by byte
            depth = np.full(len(x), d)
            true = (_rows(data, start[x] - 1, depth, d, -1) == _rows(data, start[y] - 1, depth, d, -1)).all(axis=1)
            x, y = x[true], y[true]
        shared = np.concatenate([x, y])
        most[shared] = d
        fewest[shared] = np.where(fewest[shared] < 0, d, fewest[shared])
    return most, fewest


_REACH = "gram long, class long, most int, fewest int"
_CHUNK = 4000


def _sorted_reaches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by gram; whole grams are taken together, a few thousand rows at once."""

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        most, fewest = reaches(rows["gram"].to_numpy(), rows["before"].to_numpy(np.int64), list(rows["bytes"]))
        return pd.DataFrame({"gram": rows["gram"], "class": rows["class"], "most": most, "fewest": fewest})[most >= 0]

    held: list[pd.DataFrame] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= _CHUNK:
            rows = pd.concat(held, ignore_index=True)
            cut = int(np.searchsorted(rows["gram"].to_numpy(), rows["gram"].iloc[-1]))
            held = [rows.iloc[cut:]]
            if cut:
                yield solve(rows.iloc[:cut].reset_index(drop=True))
    if held and sum(map(len, held)):
        yield solve(pd.concat(held, ignore_index=True))


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("d", T.IntegerType()), T.StructField("x", T.LongType()), T.StructField("y", T.LongType())])))
def _strings(before: pd.Series, surroundings: pd.Series) -> pd.Series:
    """Every string around an anchor: bytes before the anchor and a 128-bit hash."""
    out = []
    for b, text in zip(before, surroundings):
        data = np.frombuffer(text, np.uint8)
        if len(data) < LENGTH:
            out.append([])
            continue
        x, y = (mixed(Hashes(data, k).every(LENGTH)).view(np.int64).tolist() for k in (0, 1))
        out.append([{"d": b - p, "x": x[p], "y": y[p]} for p in range(min(len(x), b + 1))])
    return pd.Series(out, dtype=object)


@F.pandas_udf(T.StructType([T.StructField("removed", T.LongType()), T.StructField("spans", T.LongType()), T.StructField("sha", T.StringType())]))
def _cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    out = []
    for text, found in zip(texts, spans):
        merged = union((s["lo"], s["hi"]) for s in found)
        kept, done = hashlib.sha256(), 0
        for lo, hi in merged:
            kept.update(text[done:lo])
            done = hi
        kept.update(text[done:])
        out.append((sum(hi - lo for lo, hi in merged), len(merged), kept.hexdigest()))
    return pd.DataFrame(out, columns=["removed", "spans", "sha"])


def union(spans) -> list[tuple[int, int]]:
    """Overlapping or touching spans made one."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], hi)
        else:
            out.append((lo, hi))
    return out


def _key(text: Column) -> Column:
    return F.xxhash64(text)


def spans(documents: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(k, n, lists of (lo, hi)) of texts with repeated strings, and the texts (k, n, data) they may be in.

    Texts that are the same as another row's are not looked at here for that reason alone.
    """
    data = documents.select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias("data"))
    data = data.select(_key(F.col("data")).alias("k"), F.octet_length("data").cast("long").alias("n"), "data")
    anchored = data.filter(F.col("n") >= LENGTH).select("k", "n", F.explode(_anchor_lists("data")).alias("a")).select("k", "n", "a.*")
    anchored = stored(anchored, "anchors")
    # grams at more than one place of different texts, or of one text
    place = F.xxhash64("k", "n", "at")
    often = anchored.groupBy("gram").agg(F.min(place).alias("p"), F.max(place).alias("q")).filter("p <> q").select("gram")
    repeated = anchored.join(often, "gram").groupBy("k", "n").agg(F.sort_array(F.collect_set(F.struct("at", "gram"))).alias("at"))
    candidates = stored(data.join(repeated, ["k", "n"]).dropDuplicates(["k", "n"]), "candidates")
    classed = candidates.select("k", "n", F.explode(F.arrays_zip(F.col("at.at").alias("at"), F.col("at.gram").alias("gram"), _surrounding_hashes("data", "at.at").alias("class"))).alias("c"))
    classed = stored(classed.select("k", "n", "c.*"), "classes")
    place = F.xxhash64("k", "n", "at")
    classes = classed.groupBy("gram", "class").agg(F.min_by(F.struct("k", "n", "at"), place).alias("one"), F.min(place).alias("p"), F.max(place).alias("q"))
    classes = stored(classes.select("gram", "class", "one.*", (F.col("p") != F.col("q")).alias("again")), "class_places")
    counts = classes.groupBy("gram").agg(F.count("*").alias("classes")).filter("classes > 1")
    open_places = classes.join(counts, "gram").groupBy("k", "n").agg(F.collect_list(F.struct("at", "gram", "class", "classes")).alias("o"))
    shown = candidates.select("k", "n", "data").join(open_places, ["k", "n"])
    shown = shown.select(F.explode(F.arrays_zip("o", _surroundings("data", "o.at").alias("s"))).alias("z")).select("z.o.gram", "z.o.class", "z.o.classes", "z.s.before", "z.s.bytes")
    shown = stored(shown, "surroundings")
    dealt = shown.filter(F.col("classes") <= CLASSES).select("gram", "class", "before", "bytes").repartition("gram").sortWithinPartitions("gram", "class")
    few = dealt.mapInPandas(_sorted_reaches, _REACH)
    strings = shown.filter(F.col("classes") > CLASSES).select("gram", "class", F.explode(_strings("before", "bytes")).alias("s")).select("gram", "class", "s.*")
    # the class is hashed with its surroundings, so it tells the strings' places apart
    twice = strings.groupBy("gram", "d", "x", "y").agg(F.min("class").alias("p"), F.max("class").alias("q")).filter("p <> q").drop("p", "q")
    many = strings.join(twice, ["gram", "d", "x", "y"]).groupBy("gram", "class").agg(F.max("d").alias("most"), F.min("d").alias("fewest"))
    found = few.union(many.select("gram", "class", "most", "fewest"))
    judged = classed.join(found, ["gram", "class"], "left").join(classes.filter("again").select("gram", "class", "again"), ["gram", "class"], "left")
    before, after = F.least("at", F.lit(WINDOW - 1)), F.least(F.col("n") - F.col("at"), F.lit(LENGTH))
    whole = F.col("again") & (before + after >= LENGTH)
    lo, hi = F.col("at") - F.when(whole, before).otherwise(F.col("most")), F.col("at") + F.when(whole, after).otherwise(LENGTH - F.col("fewest"))
    covered = judged.select("k", "n", lo.cast("long").alias("lo"), hi.cast("long").alias("hi")).filter("lo is not null and hi is not null")
    return covered.groupBy("k", "n").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")), candidates.select("k", "n", "data")


def remove(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_bytes, n_removed, n_spans, kept_sha256."""
    found, texts = spans(documents, text)
    cut = stored(texts.join(found, ["k", "n"]).select("k", "n", _cut("data", "spans").alias("c")).select("k", "n", "c.*"), "cut")
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = stored(documents.select(F.col(key).alias("id"), _key(data).alias("k"), F.octet_length(data).cast("long").alias("n"), F.sha2(data, 256).alias("whole")), "rows")
    copies = rows.groupBy("k", "n").agg(F.count("*").alias("rows")).filter((F.col("rows") > 1) & (F.col("n") >= LENGTH)).select("k", "n", F.lit(True).alias("copied"))
    out = rows.join(cut, ["k", "n"], "left").join(copies, ["k", "n"], "left")
    copied = F.col("copied").isNotNull()
    return out.select(
        F.col("id").alias(key), F.col("n").alias("n_bytes"),
        F.when(copied, F.col("n")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, 1).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, hashlib.sha256().hexdigest()).otherwise(F.coalesce("sha", "whole")).alias("kept_sha256"),
    )
