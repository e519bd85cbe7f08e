"""The Merkle manifest against a plain version."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from sentiseries.llm import merkle
from tests.llm import brute
from tests.oracle_check import connect, difference

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, grp int, at int, total string, digest string, kept int, proof string, part int, tie int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "t", "d", 3, "p", 4, 5) for r in rows], SCHEMA)


def key(row):
    return tuple((v is not None, str(v)) for v in row)


def judged(docs, arity=2, every=8):
    more = (F.col("n_chars").cast("decimal(20, 0)") + 1).cast("string")
    forged = merkle.leaf_of(*(more if c == "n_chars" else F.col(c) for c in COLUMNS))
    kept = {"forged": F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, forged)}
    found = merkle.proofs(merkle.manifest(docs, "doc_id", "lang", COLUMNS, kept, arity, every))
    folded = merkle.fold(F.coalesce("kept.forged", "leaf"), F.col("proof"))
    return found.select("key", "leaf", "subroot", "root", merkle.hashed(merkle.siblings(F.col("proof"))), folded, folded == F.col("root"))


def test_op11_equals_brute_force(spark):
    rows = [tuple(r[c] for c in COLUMNS) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = contract.queries()["op11_merkle_manifest"](spark, SF)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = brute.merkle(rows)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert {w[-1] for w in want} == {True, False}


def test_op11_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert difference(contract.queries()["op11_merkle_manifest"](spark, sf), connect(sf), contract.oracle_sql()["op11_merkle_manifest"]) is None


ODD = [
    (None, "a", "x", 3, "null id"), (None, "a", "x", 3, "null id"), (7, None, None, None, None), (8, "", "", 0, ""), (8, "", "", 0, ""),
    (8, "", "", 1, ""), (9, "é", "é", 2**63 - 1, "ü" * 10), (10, "a", "Z", 5, "-"), (11, "1:-", "Z", 5, "4:text"), (12, "a", "x", 9, "long " * 200_000),
]


@pytest.mark.parametrize("arity, every", [(2, 8), (2, 2), (3, 2)])
def test_nulls_ties_repeats_and_all_sizes(spark, arity, every):
    rows = ODD + [(i * 13 % 101, "s", f"size{n}", i, f"text {i}") for n in (1, 2, 3, 4, 5, 8, 9, 16, 17, 31) for i in range(n)]
    got = sorted(map(tuple, judged(frame(spark, rows), arity, every).collect()), key=key)
    assert got == sorted(brute.merkle(rows, arity), key=key)


def test_one_key_in_many_rows(spark):
    rows = [(5, "s", "en", i % 3, "same") for i in range(300)]
    got = sorted(map(tuple, judged(frame(spark, rows), 2, 6).collect()), key=key)
    assert got == sorted(brute.merkle(rows), key=key)


def test_one_row_and_no_row(spark):
    (row,) = judged(frame(spark, ODD[2:3])).collect()
    assert row["leaf"] == row["subroot"] == row["root"]
    assert judged(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        merkle.manifest(frame(spark, []), "doc_id", "lang", COLUMNS, arity=1)


def test_only_some_levels_are_stored(spark):
    docs = frame(spark, [(i, "s", "en", i, str(i)) for i in range(600)])
    made = merkle.manifest(docs, "doc_id", "lang", COLUMNS, every=4)
    assert [level.count() for level in made.levels] == [600, 38, 3]
    assert made.top.subroots.count() == 1


def test_a_proof_of_another_row_does_not_verify(spark):
    docs = frame(spark, [(i, "s", "en", i, str(i)) for i in range(40)])
    found = merkle.proofs(merkle.manifest(docs, "doc_id", "lang", COLUMNS)).select("key", "leaf", "root", "proof")
    other = found.select((F.col("key") - 1).alias("key"), F.col("leaf").alias("other"))
    pairs = found.join(other, "key").withColumn("folded", merkle.fold(F.col("other"), F.col("proof")))
    assert pairs.filter("folded = root").count() == 0 and pairs.count() == 39
