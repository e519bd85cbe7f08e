"""Token counts against the library's own, whole texts at a time."""

import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
from sentiseries.llm import token_counts

SF = "/root/testdata/sf0.01"
LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
SCHEMA = "doc_id long, text string, n_bytes string, digest string, k int, n_tokens int, piece string, need int"


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "b", "d", 1, 2, "p", 3) for i, t in enumerate(texts)], SCHEMA)


def mess(seed, size):
    """Words, runs of white space, numbers, signs, other alphabets and special strings, cut anywhere."""
    pick = random.Random(seed)
    parts = ["word", " the", "  ", "\n", "\n\n ", "\t", "'re", "'", "r", "e", "12", " 7", "é", "日本", "🙂", "e\u0301", "<|endoftext|>", "<|endof", "|>", "...", "\u00a0", "\u2003", "\u200b", "\x1c", "\x85", "ſ", "\u180e", "Ⅷ", "²"]
    text = ""
    while len(text) < size:
        text += "".join(pick.choices(parts, k=50))
    return text[:size]


def test_op12_equals_the_library(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = contract.queries()["op12_token_counts"](spark, SF).collect()
    want = sorted((i, len((t or "").encode()), library(t)) for i, t in texts.items())
    assert sorted(tuple(r)[:3] for r in rows) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in rows)


EDGES = [None, "", " ", "a", "<|endoftext|>", "x <|endoftext|> y", "a  b", "a b", " a", "a ", "é la  été", "a\u00a0b c", "a \u2003 b", "a \x1c b \x85 c"]


@pytest.mark.parametrize("chunk, overlap", [(32_768, 512), (80, 40), (64, 20)])
def test_odd_texts(spark, chunk, overlap):
    texts = EDGES + [mess(i, n) for i, n in enumerate((50, 79, 80, 81, 119, 120, 121, 200, 1000, 3000))]
    texts += [mess(9, 3000), mess(9, 3000), "x" * 2000, "y" * 300 + " ab" * 50, "ab " * 700 + "q" * 900 + " ab" * 300, " " * 1500, "\n" * 500 + "a", "<|endoftext|>" * 100, "é" * 700]
    got = token_counts.count(frame(spark, texts), chunk=chunk, overlap=overlap)
    assert sorted(got.columns) == sorted(["doc_id", "text", "n_bytes", "digest", "k", "n_tokens", "piece", "need"])
    rows = {r["doc_id"]: (r["text"], r["n_bytes"], r["n_tokens"]) for r in got.collect()}
    assert rows == {i: (t, len((t or "").encode()), library(t)) for i, t in enumerate(texts)}


def test_a_very_long_text_with_a_long_word(spark):
    pick = random.Random(7)
    plain = " ".join("".join(pick.choices("abcdefgh", k=pick.randint(1, 9))) for _ in range(60_000))
    texts = [plain[:100_000] + "z" * 9_000 + plain[100_000:], plain, plain, None]
    rows = {r["doc_id"]: r["n_tokens"] for r in token_counts.count(frame(spark, texts)).collect()}
    assert rows == {i: library(t) for i, t in enumerate(texts)}


def test_boundaries_are_those_of_the_whole_text():
    """Every place where two chunks meet is a word's start of the text."""
    text = mess(3, 20_000)
    own = token_counts.encoder(None)
    starts = set(own.words(text)[0].tolist())
    seen = {}
    for k, last, piece in token_counts.pieces(text, 400, 100):
        for edge, at, left, right, _ in token_counts.edges(piece, k, last, 400, 100):
            if edge is not None:
                seen.setdefault((edge, at), []).append(left is not None)
    met = [edge * 400 + at for (edge, at), sides in seen.items() if len(sides) == 2]
    assert len(met) > 500 and set(met) <= starts


def test_overlaps_are_widened(spark):
    """A run without a boundary longer than the overlap is cut again."""
    text = "some words first " * 10 + "k" * 3_000 + " and some more words" * 20
    long = spark.createDataFrame([("one", text)], "digest string, text string")
    assert [tuple(r) for r in token_counts.spliced(long, None, 100, 40).collect()] == [("one", library(text))]
    said = [(e, left is None) for k, last, p in token_counts.pieces(text, 100, 40) for e, _, left, _, _ in token_counts.edges(p, k, last, 100, 40)]
    assert (5, True) in said and (5, False) not in said


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(spark, name):
    path = public_tokenizers.path(name)
    texts = [t for t in EDGES if t != "x <|endoftext|> y"] + [mess(4, 500)]
    if name.endswith(".model"):
        own = sentencepiece.SentencePieceProcessor(model_file=path)
        want = [len(own.encode(t or "")) for t in texts]
    else:
        own = Tokenizer.from_file(path)
        want = [len(own.encode(t or "", add_special_tokens=False).ids) for t in texts]
    rows = {r["doc_id"]: r["n_tokens"] for r in token_counts.count(frame(spark, texts), path=path).collect()}
    assert rows == dict(enumerate(want))


def test_empty_table_and_wrong_sizes(spark):
    assert token_counts.count(frame(spark, ["a"]).limit(0)).count() == 0
    for chunk, overlap in ((100, 0), (100, 51)):
        with pytest.raises(ValueError):
            token_counts.count(frame(spark, ["a"]), chunk=chunk, overlap=overlap)
    assert token_counts.count(frame(spark, ["a b"]).withColumn("body", F.col("text")), "body").select("n_tokens").first()[0] == 2
