"""How far the sources of each language are from each other, by the terms they use.

Each group (language, source) gives each term that its language keeps a smoothed share p
of a thousand million, and so does the whole language. The distance of p from q is
floor((p - q)^2 / q), summed over the terms. It depends on the two counts of a term
only, so it is not priced term by term: for two groups a and b, a table J of how many
terms have count x in a and y in b is enough, and the language's J of all pairs of groups
are one product. Every term is a row with a one in the column (group, count) of each
group that has it. The rows of a language are taken in blocks, each block's transpose is
multiplied by the block, in blocks of columns, and the products are added up. Numbers in a
block's product are below 2^24, so single precision is exact. The diagonal holds the
terms at each count of a group. Counts of 0 have no columns, as most terms are missing
from most groups: what they add is

    sum J[x,y] (f(x,y) - f(0,y) - f(x,0) + f(0,0)) + sum m_a[x] (f(x,0) - f(0,0)) + sum m_b[y] (f(0,y) - f(0,0)) + V f(0,0)

with the terms m at each count and the number V of terms kept; all in whole numbers.

Texts are read once and counted in map tasks; what is shuffled are counts by (language,
source, term), then J. Only a term's counts in the sources that have it are brought
together. A hot source, language or term is one row for each task that met it.

A null text has no terms; null languages and sources are the empty string, a group like
any other. Repeated rows count as often as they occur. Long texts are counted in parts.
Terms with equal values are ranked by their bytes. A language that keeps no terms has
distances of 0 and no ranked terms; a group alone in its language has no pairs. An empty
table gives an empty result. Only the named columns are read, whatever else there is.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from sentiseries.llm.common import utf8
from sentiseries.sources.storage import stored

SHARES = 1_000_000_000
LEAST_DOCUMENTS = 3
TOP = 200
#: Bytes of terms: letters, A-Z lower-cased, and all bytes of other alphabets.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_PART = 1 << 20
#: Different (language, source, term) that a task counts before it hands them on.
_HELD = 300_000
#: Rows and columns of a block.
_ROWS, _COLUMNS = 4096, 1024


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, in parts of about a million bytes."""
    data, start = utf8(text).translate(_TERMS), 0
    while start < len(data):
        end = data.find(b" ", start + _PART)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def _tally(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def held() -> Iterator[pd.DataFrame]:
        for (lang, source), (n, docs) in counts.items():
            if n:
                yield pd.DataFrame({"lang": lang, "source": source, "term": [t.decode() for t in n], "n": list(n.values()), "docs": [docs[t] for t in n]})
        counts.clear()

    for rows in parts:
        for lang, source, text in zip(rows["lang"], rows["source"], rows["text"]):
            n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
            own: set[bytes] = set()
            for some in terms(text):
                n.update(some)
                own.update(some)
            docs.update(own)
        if sum(len(n) for n, _ in counts.values()) > _HELD:
            yield from held()
    yield from held()


def term_vectors(documents: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term, total, entries): kept terms with their (source, n) in each source that has them."""
    counted = documents.mapInPandas(_tally, "lang string, source string, term string, n long, docs long")
    cells = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    entries = F.collect_list(F.struct("source", "n"))
    vectors = cells.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"), entries.alias("entries"))
    return vectors.filter(F.col("docs") >= least).drop("docs")


def block_product(rows: np.ndarray, groups: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, ...]:
    """(a, x, b, y, n) of one block: ``rows`` numbers the terms, with a group and a count in each entry; a <= b.

    The block's indicator columns, ordered by group, times each other.
    """
    top = int(levels.max()) + 1
    columns, column = np.unique(groups * top + levels, return_inverse=True)
    height, width, found = int(rows.max()) + 1, len(columns), []
    for left in range(0, width, _COLUMNS):
        for right in range(left, width, _COLUMNS):
            sides = []
            for first in (left, right):
                here = (column >= first) & (column < first + _COLUMNS)
                side = np.zeros((height, min(_COLUMNS, width - first)), np.float32)
                side[rows[here], column[here] - first] = 1
                sides.append(side)
            product = sides[0].T @ sides[1]
            i, j = np.nonzero(np.triu(product) if left == right else product)
            found.append((i + left, j + right, product[i, j].astype(np.int64)))
    i, j, n = (np.concatenate(x) for x in zip(*found))
    return *divmod(columns[i], top), *divmod(columns[j], top), n


def blocks(terms_of: np.ndarray, groups: np.ndarray, levels: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """``block_product`` of the entries, halved by terms while a block has too many columns."""
    if not len(terms_of):
        return
    width = len(np.unique(groups * (int(levels.max()) + 1) + levels))
    middle = int(terms_of[0] + terms_of[-1] + 1) // 2
    upper = terms_of >= middle
    if width > _COLUMNS and upper.any() and not upper.all():
        for half in (~upper, upper):
            yield from blocks(terms_of[half], groups[half], levels[half])
    else:
        yield block_product(terms_of - terms_of[0], groups, levels)


def _multiply(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, list] = {}

    def product(lang: str) -> Iterator[pd.DataFrame]:
        # terms of like totals have like counts, so that their blocks have few columns
        vectors = [v for _, v in sorted(held.pop(lang), key=lambda m: m[0])]
        names = sorted({s["source"] for v in vectors for s in v})
        number = {s: i for i, s in enumerate(names)}
        entries = [(t, number[s["source"]], s["n"]) for t, v in enumerate(vectors) for s in v]
        for a, x, b, y, n in blocks(*np.array(entries, np.int64).T):
            yield pd.DataFrame({"lang": lang, "a": np.array(names, object)[a], "x": x, "b": np.array(names, object)[b], "y": y, "n": n})

    waiting = 0
    for rows in parts:
        for lang, total, entries in zip(rows["lang"], rows["total"], rows["entries"]):
            held.setdefault(lang, []).append((total, entries))
            waiting += 1
            if len(held[lang]) == _ROWS or waiting == 4 * _ROWS:
                lang = max(held, key=lambda name: len(held[name]))
                waiting -= len(held[lang])
                yield from product(lang)
    for lang in list(held):
        yield from product(lang)


def joint_tables(vectors: DataFrame) -> DataFrame:
    """(lang, a, x, b, y, n): n terms have count x in source a and y in b, for a < b; for a = b, x = y, n terms have count x in a."""
    products = vectors.select("lang", "total", "entries").mapInPandas(_multiply, "lang string, a string, x long, b string, y long, n long")
    return products.groupBy("lang", "a", "x", "b", "y").agg(F.sum("n").alias("n"))


def _quotient(a: Column, b: Column) -> Column:
    """Whole part of a / b, both above zero."""
    return F.call_function("div", a, b)


def share(count: Column, of: Column) -> Column:
    """1 + floor(SHARES (count + 1) / of), also where the product is past a long."""
    past = F.lit(SHARES).cast("decimal(10, 0)") * (count.cast("decimal(20, 0)") + 1)
    return F.when(count < 9_000_000_000, _quotient(F.lit(SHARES).cast("long") * (count + 1), of)).otherwise(_quotient(past, of.cast("decimal(20, 0)"))) + 1


def distance(p: Column, q: Column) -> Column:
    return _quotient((p - q) * (p - q), q)


def _sum(value: Column) -> Column:
    return F.sum(value.cast("decimal(28, 0)"))


def pair_distances(joint: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): each source's distance from each other source of its language.

    ``groups`` has (lang, source, of, kept): the group's occurrences plus the number of
    terms its language keeps, and that number.
    """
    zero = groups.filter("kept > 0").withColumn("p0", share(F.lit(0).cast("long"), F.col("of")))
    left = zero.select("lang", F.col("source").alias("a"), F.col("of").alias("of_a"), F.col("p0").alias("a0"), "kept")
    right = zero.select("lang", F.col("source").alias("b"), F.col("of").alias("of_b"), F.col("p0").alias("b0"))
    both = joint.filter("a <> b")
    both = both.union(both.select("lang", F.col("b").alias("a"), F.col("y").alias("x"), F.col("a").alias("b"), F.col("x").alias("y"), "n"))
    a, b, a0, b0 = share(F.col("x"), F.col("of_a")), share(F.col("y"), F.col("of_b")), F.col("a0"), F.col("b0")
    both = both.join(left, ["lang", "a"]).join(right, ["lang", "b"]).withColumn("pa", a).withColumn("pb", b)
    shared = both.select("lang", "a", "b", (
        F.col("n") * (distance(F.col("pa"), F.col("pb")) - distance(a0, F.col("pb")) - distance(F.col("pa"), b0) + distance(a0, b0))
    ).alias("value"))
    single = joint.filter("a = b")
    first = single.select("lang", "a", "x", "n").join(left, ["lang", "a"]).join(right, "lang").filter("a <> b")
    first = first.select("lang", "a", "b", (F.col("n") * (distance(a, b0) - distance(a0, b0))).alias("value"))
    second = single.select("lang", "b", "y", "n").join(right, ["lang", "b"]).join(left, "lang").filter("a <> b")
    second = second.select("lang", "a", "b", (F.col("n") * (distance(a0, b) - distance(a0, b0))).alias("value"))
    none = left.join(right, "lang").filter("a <> b").select("lang", "a", "b", (F.col("kept") * distance(a0, b0)).alias("value"))
    unkept = groups.filter("kept = 0").select("lang", F.col("source").alias("a"))
    nothing = unkept.join(unkept.withColumnRenamed("a", "b"), "lang").filter("a <> b").select("lang", "a", "b", F.lit(0).cast("long").alias("value"))
    parts = shared.union(first).union(second).union(none).union(nothing)
    return parts.groupBy("lang", "a", "b").agg(_sum(F.col("value")).cast("long").alias("value")).withColumnsRenamed({"a": "source", "b": "item"})


def term_distances(vectors: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """(lang, source, item, value): the terms that a source has and uses more than its language."""
    cells = vectors.select("lang", "term", "total", F.explode("entries").alias("e")).select("lang", "term", "total", "e.source", "e.n")
    priced = cells.join(groups.select("lang", "source", "of"), ["lang", "source"]).join(langs.select("lang", F.col("of").alias("of_all")), "lang")
    priced = priced.withColumn("p", share(F.col("n"), F.col("of"))).withColumn("q", share(F.col("total"), F.col("of_all")))
    return priced.filter("p > q").select("lang", "source", F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))


def audit(documents: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): all pairs of sources (``pair``) and each source's ``top`` terms (``term``)."""
    rows = documents.select(*(F.coalesce(F.col(c), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"))), F.col(text).alias("text"))
    vectors = stored(term_vectors(rows, least), "vectors")
    langs = vectors.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("all"))
    langs = stored(langs.select("lang", "kept", (F.col("all") + F.col("kept")).alias("of")), "langs")
    used = vectors.select("lang", F.explode("entries").alias("e")).groupBy("lang", "e.source").agg(F.sum("e.n").alias("used"))
    groups = rows.select("lang", "source").distinct().join(used, ["lang", "source"], "left").join(langs.select("lang", "kept"), "lang", "left")
    groups = groups.withColumn("kept", F.coalesce("kept", F.lit(0).cast("long")))
    groups = stored(groups.select("lang", "source", (F.coalesce("used", F.lit(0).cast("long")) + F.col("kept")).alias("of"), "kept"), "groups")
    pairs = pair_distances(stored(joint_tables(vectors), "joint"), groups).withColumn("part", F.lit("pair"))
    found = term_distances(vectors, groups, langs).withColumn("part", F.lit("term"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    columns = ("lang", "source", "part", "item", "value", "rank")
    return pairs.withColumn("rank", F.row_number().over(order)).select(*columns).union(best.select(*columns))
