"""Rules of the sentiment score, on texts worked out by hand."""

import math

import pytest
from pyspark.sql import functions as F

from sentiseries.operators import sentiment as S
from sentiseries.operators.rules import Rules

LEXICON = {"good": 1.9, "great": 3.1, "bad": -2.5, "worst": -3.1, "right": 0.5, "kind": 2.4, ":d": 2.3}


def compound(total):
    return round(total / math.sqrt(total * total + 15), 4)


CASES = [
    ("good", compound(1.9)),
    ("Good, good: good!", compound(1.9 * 3 + 0.292)),
    ("nothing here", 0.0),
    ("", 0.0),
    ("g good", compound(1.9)),
    ("very good", compound(1.9 + 0.293)),
    ("so very good", compound(((1.9 + 0.293) + 0.293 * 0.95))),
    ("slightly bad", compound(-2.5 + 0.293)),
    ("not good", compound(1.9 * -0.74)),
    ("isn't it good", compound(1.9 * -0.74)),
    ("not at all good", compound(1.9 * -0.74)),
    ("it was GREAT", compound(3.1 + 0.733)),
    ("GREAT GOOD", compound(3.1 + 1.9)),
    ("a VERY good", compound(1.9 + 0.293 + 0.733)),
    ("VERY bad day", compound(-2.5 - 0.293 - 0.733)),
    ("good but bad", compound(1.9 * 0.5 - 2.5 * 1.5)),
    ("never so good", compound((1.9 + 0.293) * 1.5)),
    ("least good", compound(1.9 * -0.74)),
    ("at least good", compound(1.9)),
    ("oh well yeah right", compound(-2.0)),
    ("it was kind of good", compound(1.9 * 1 - 0.293)),
    ("good bad great", compound(1.9 - 2.5 + 3.1)),
    ("good !!!!!!", compound(1.9 + 4 * 0.292)),
    ("good!!!!!!", 0.0),
    ("bad ??", compound(-2.5 - 2 * 0.18)),
    ("bad ????", compound(-2.5 - 0.96)),
    (":D yes", compound(2.3 + 0.733)),
    ("(good) good", compound(1.9)),
    ("not good. good", compound(1.9 * -0.74 * 2)),
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "id int, title string")


@pytest.mark.parametrize("id_column", ["id", None])
def test_scores(spark, texts, id_column):
    scored = S.score_sentiment(texts, S.lexicon_frame(spark, LEXICON), id_column=id_column)
    got = {r["id"]: r["sentiment_score"] for r in scored.collect()}
    wrong = {CASES[i][0]: (got[i], want) for i, (_, want) in enumerate(CASES) if abs(got[i] - want) > 1e-9}
    assert not wrong


def test_lexicon_is_bounded(spark, texts, monkeypatch):
    monkeypatch.setattr(S, "MOST_ENTRIES", 2)
    with pytest.raises(ValueError):
        S.score_sentiment(texts, S.lexicon_frame(spark, LEXICON))


def test_null_and_repeated_ids_are_scored_apart(spark):
    rows = [(None, "a good day"), (2, "a good day"), (2, "a bad day"), (None, "a bad day"), (None, "a bad day")]
    df = spark.createDataFrame(rows, "id int, title string")
    scored = S.score_sentiment(df, S.lexicon_frame(spark, LEXICON), id_column="id").collect()
    assert sorted((r["title"], r["sentiment_score"]) for r in scored) == sorted(
        (t, compound(1.9 if "good" in t else -2.5)) for _, t in rows
    )


def test_scoring_moves_no_texts(spark, texts):
    plan = S.score_sentiment(texts, S.lexicon_frame(spark, LEXICON))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_null_text_has_neither_score_nor_label(spark):
    df = spark.createDataFrame([(1, None), (2, "good")], "id int, title string")
    rows = {r["id"]: r for r in S.score_sentiment(df, S.lexicon_frame(spark, LEXICON)).collect()}
    assert rows[1]["sentiment_score"] is None and rows[1]["sentiment"] is None
    assert rows[2]["sentiment"] == "Positive"


def test_copies_of_a_text_are_each_scored_once(spark):
    df = spark.range(2000).select(F.lit("a good day").alias("title"), (F.col("id") % 2).alias("score"))
    rows = S.score_sentiment(df, S.lexicon_frame(spark, LEXICON)).groupBy("sentiment_score").count().collect()
    assert [(r[0], r[1]) for r in rows] == [(compound(1.9), 2000)]


def test_scores_stay_in_range(spark):
    words = list(LEXICON) + ["not", "very", "but"]
    df = spark.range(300).select(
        "id", F.concat_ws(" ", *(F.get(F.array(*map(F.lit, words)), F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(words))).cast("int")) for k in range(40))).alias("title")
    )
    ends = S.score_sentiment(df, S.lexicon_frame(spark, LEXICON), id_column="id").agg(
        F.min("sentiment_score"), F.max("sentiment_score"), F.count("sentiment_score")
    ).first()
    assert -1 <= ends[0] <= ends[1] <= 1 and ends[2] == 300


def test_lexicon_file_with_extra_columns(spark, tmp_path):
    path = tmp_path / "lexicon.txt"
    path.write_text("good\t1.9\t0.9\t[2, 1]\n:D\t2.3\t0.4\t[2, 3]\n\"(\t-1.0\t0.1\t[1]\n")
    rows = {r["token"]: r["valence"] for r in S.read_lexicon(spark, str(path)).collect()}
    assert rows == {"good": 1.9, ":D": 2.3, '"(': -1.0}


def test_custom_rules(spark):
    df = spark.createDataFrame([(1, "muy good"), (2, "kein good")], "id int, title string")
    rules = Rules(boosters={"muy": 0.5}, negations=("kein",))
    rows = {r["id"]: r["sentiment_score"] for r in S.score_sentiment(df, S.lexicon_frame(spark, LEXICON), rules=rules).collect()}
    assert rows == {1: compound(2.4), 2: compound(1.9 * -0.74)}


def test_words_with_quotes_and_signs(spark):
    lexicon = {"it's": 1.0, "\\o/": 2.0, "x\"y": -1.0, "für": 1.5, ":-)": 2.2}
    texts = ["it's fine", "yes \\o/", "an x\"y", "das für uns", "ok :-)", "FÜR uns und MICH"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, title string")
    rows = {r["id"]: r["sentiment_score"] for r in S.score_sentiment(df, S.lexicon_frame(spark, lexicon)).collect()}
    assert rows == {0: compound(1.0), 1: compound(2.0), 2: compound(-1.0), 3: compound(1.5), 4: compound(2.2), 5: compound(1.5 + 0.733)}


def test_a_large_lexicon_and_a_long_text(spark):
    lexicon = {f"w{i}": (i % 9 - 4) / 2 for i in range(6000)}
    text = " ".join(f"w{i * 7 % 9000}" for i in range(20_000))
    total = sum(lexicon.get(f"w{i * 7 % 9000}", 0.0) for i in range(20_000))
    df = spark.createDataFrame([(1, text)], "id int, title string")
    assert abs(S.score_sentiment(df, S.lexicon_frame(spark, lexicon)).first()["sentiment_score"] - compound(total)) < 1e-4


def test_no_python_runs(spark, texts):
    plan = S.score_sentiment(texts, S.lexicon_frame(spark, LEXICON))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
