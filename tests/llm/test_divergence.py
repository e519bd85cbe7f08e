"""The audit of sources against a plain version that prices every term by itself."""

import random

import numpy as np
import pytest

import __spark_entry__ as contract
from sentiseries.llm import divergence
from tests.llm import brute
from tests.oracle_check import connect, difference

SF = "/root/testdata/sf0.001"
SCHEMA = "lang string, source string, text string, term string, n long, a int, value int, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, 2, 3, "r") for r in rows], SCHEMA)


def same(spark, rows, **more):
    got = sorted(map(tuple, divergence.audit(frame(spark, rows), **more).collect()))
    assert got == sorted(brute.divergence(rows, **more))
    return got


def test_op13_equals_brute_force(spark):
    rows = [(r["lang"], r["source"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = contract.queries()["op13_source_divergence"](spark, SF)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == sorted(brute.divergence(rows))


def test_op13_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert difference(contract.queries()["op13_source_divergence"](spark, sf), connect(sf), contract.oracle_sql()["op13_source_divergence"]) is None


def test_nulls_ties_repeats_and_lone_groups(spark):
    rows = [
        (None, None, "a b c"), (None, "", "a b d"), ("", None, "a x"), (None, "s", None), ("en", "s", "Wörter wörter WÖRTER É é x1y"), ("en", "t", "wörter x y é"),
        ("en", "t", "wörter x y é"), ("en", "t", "wörter x y é"), ("en", "u", ""), ("en", "u", "... 123 _"), ("de", "only", "ja ja ja"), ("de", "only", "ja"), ("de", "only", "ja"),
        ("xx", "a", "eins"), ("xx", "b", "zwei"), ("en", "long", "x " * 400_000 + "lang " * 300_000),
    ]
    got = same(spark, rows)
    assert [r for r in got if r[0] == "xx"] == [("xx", "a", "pair", "b", 0, 1), ("xx", "b", "pair", "a", 0, 1)]
    assert divergence.audit(frame(spark, [])).count() == 0


def test_ranks_end_at_the_top_terms_but_pairs_do_not(spark):
    pick = random.Random(4)
    words = ["w" + "".join(pick.choices("abcdef", k=4)) for _ in range(60)]
    rows = [("en", f"s{i % 9}", " ".join(pick.choices(words, [1 / (k + 1) for k in range(60)], k=40))) for i in range(200)]
    got = same(spark, rows, top=5)
    assert max(r[5] for r in got if r[2] == "term") == 5 and max(r[5] for r in got if r[2] == "pair") == 8


@pytest.mark.parametrize("rows, columns", [(4096, 1024), (7, 5), (50, 3), (1, 1)])
def test_blocked_products_equal_counting(monkeypatch, rows, columns):
    monkeypatch.setattr(divergence, "_COLUMNS", columns)
    pick = np.random.default_rng(2)
    terms = np.repeat(np.arange(120), 6)
    groups = np.concatenate([pick.permutation(9)[:6] for _ in range(120)])
    levels = pick.geometric(0.3, 720)
    got = {}
    for first in range(0, 120, rows):
        part = (terms >= first) & (terms < first + rows)
        for block in divergence.blocks(terms[part], groups[part], levels[part]):
            for a, x, b, y, n in zip(*(v.tolist() for v in block)):
                got[a, x, b, y] = got.get((a, x, b, y), 0) + n
    want = {}
    for t in range(120):
        own = sorted(zip(groups[terms == t].tolist(), levels[terms == t].tolist()))
        for i, (a, x) in enumerate(own):
            for b, y in own[i:]:
                want[a, x, b, y] = want.get((a, x, b, y), 0) + 1
    assert got == want


def test_shares_past_a_long(spark):
    from pyspark.sql import functions as F

    rows = [(c, d) for c in (0, 8_999_999_999, 9_000_000_000, 10**13) for d in (1, 7, 10**13 + 3) if c <= d]
    got = spark.createDataFrame(rows, "c long, d long").select("c", "d", divergence.share(F.col("c"), F.col("d"))).collect()
    assert [r[2] for r in got] == [1 + 10**9 * (c + 1) // d for c, d in rows]
