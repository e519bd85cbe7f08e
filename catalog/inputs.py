"""The given tables seen as posts, and the parameters the registered queries use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sentiseries.functions.scalars import sentiment_label
from sentiseries.operators.rules import BOOST, IDIOMS, INTENSIFIERS, DAMPENERS, NEGATIONS, Rules

CUT = "1998-03-01"
EVENT_CUT = "2024-01-16"
TOP_K = 10
BIN_WIDTH = 0.05
SUBSET_COMMUNITIES = ("1-URGENT", "3-MEDIUM", "5-LOW")
SUBSET_YEARS = (1997, 1998, 1999)

# Words that occur in the given documents, so every rule has something to act on.
LEXICON = {
    "the": 0.4, "and": -0.6, "with": 1.3, "that": -1.1, "est": 2.1, "und": -1.7, "les": 0.9,
    "this": 1.6, "worthless": -1.9, "ouen": 2.4, "erst": -2.2, "thin": 1.1, "then": -0.8,
    "nicht": -2.6, "onan": 3.1, "thly": -3.3, "best": 3.2, "are": 0.7,
}
EXTRA_BOOSTERS = {"of": BOOST, "la": BOOST, "der": BOOST, "in": -BOOST, "que": -BOOST}
EXTRA_NEGATIONS = ("on", "is", "le", "die")
EXTRA_IDIOMS = {"in the": 1.2, "of the": -0.7, "to be the": 2.5, "that the": -1.4}
CONTRAST = "for"

RULES = Rules(
    boosters=dict.fromkeys(INTENSIFIERS, BOOST) | dict.fromkeys(DAMPENERS, -BOOST) | EXTRA_BOOSTERS,
    negations=tuple(NEGATIONS) + EXTRA_NEGATIONS,
    idioms=IDIOMS | EXTRA_IDIOMS,
    contrast=CONTRAST,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as submissions: the priority is the community, the price the score."""
    key = F.col("o_orderkey")
    has_title = key % 97 != 0
    return table(spark, sf_dir, "orders").select(
        key.alias("id"),
        (F.col("o_orderstatus") == "F").alias("archived"),
        F.concat(F.lit("user "), F.col("o_custkey").cast("string")).alias("author"),
        (F.unix_date(F.col("o_orderdate").cast("date")).cast("long") * 86400).alias("created"),
        (key % 7).alias("downs"),
        (key % 3).alias("gilded"),
        F.concat(F.lit("t3_"), key.cast("string")).alias("name"),
        (F.col("o_custkey") % 50).alias("num_comments"),
        F.floor("o_totalprice").cast("long").alias("score"),
        F.when(key % 5 != 0, F.col("o_orderstatus")).alias("selftext"),
        F.col("o_orderpriority").alias("subreddit"),
        F.when(has_title, F.concat(F.lit("post "), key.cast("string"))).alias("title"),
        (F.floor("o_totalprice") + key % 7).cast("long").alias("ups"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.when(has_title, ((key * 7919) % 2001 - 1000).cast("double") / 1000).alias("sentiment_score"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored and labelled posts with their id."""
    scored = wide_posts(spark, sf_dir).select(
        "id", "subreddit", "year", "month", "score", "title", "sentiment_score"
    )
    return scored.withColumn("sentiment", sentiment_label(F.col("sentiment_score")))
