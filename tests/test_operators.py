"""Edge rows and cross-checks of the series operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sentiseries.functions.bins import with_bins
from sentiseries.functions.scalars import month_date, relative_change, sentiment_label
from sentiseries.operators import change, monthly, ranking, significant
from sentiseries.sources import submissions

POST = "id long, subreddit string, year int, month int, score long, title string, sentiment_score double"


def scored(spark, rows):
    return spark.createDataFrame(rows, POST).withColumn("sentiment", sentiment_label(F.col("sentiment_score")))


def test_label_thresholds_are_inclusive(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.049,), (None,)], "s double")
    labels = [r[0] for r in df.select(sentiment_label(F.col("s"))).collect()]
    assert labels == ["Positive", "Negative", "Neutral", None]


def test_significance_is_strict_and_missing_sides_are_null(spark):
    df = scored(spark, [
        (1, "a", 2020, 1, 10, "t", 0.5), (2, "a", 2020, 1, 20, "t", -0.5),
        (3, "a", 2020, 2, 30, "t", 0.9), (4, "a", 2020, 2, 40, None, None),
    ])
    rows = {r["date"].month: r for r in significant.significant_overall(monthly.with_month_date(df)).collect()}
    assert rows[1]["num_pos_submissions"] is None and rows[1]["neg_sum_score"] is None
    assert rows[2]["num_pos_submissions"] == 1 and rows[2]["num_neg_submissions"] is None
    assert rows[2]["overall_num_submissions"] == 1 and rows[2]["overall_sum_score"] == 70


def test_null_title_is_out_of_averages(spark):
    df = scored(spark, [(1, "a", 2020, 1, 5, "t", 0.4), (2, "a", 2020, 1, 9, None, None)])
    row = monthly.community_month(df).collect()[0]
    assert row["avg_sentiment_score"] == row["top40_avg_sentiment_score"] == 0.4


def test_ties_at_rank_k_keep_the_lower_id_and_null_scores_come_last(spark):
    df = scored(spark, [
        (3, "a", 2020, 1, 7, "t", 0.1), (1, "a", 2020, 1, 7, "t", 0.1), (2, "a", 2020, 1, None, "t", 0.1),
    ])
    assert [r["id"] for r in monthly.top_posts(df, 1).collect()] == [1]
    assert {r["id"] for r in monthly.top_posts(df, 2).collect()} == {1, 3}


def test_salted_top_k_equals_plain(spark):
    df = spark.range(5000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("g"), (F.col("id") % 91).alias("score")
    )
    plain = ranking.top_k_per_group(df, ["g"], ranking.by_score(), 50, salts=1)
    salted = ranking.top_k_per_group(df, ["g"], ranking.by_score(), 50, salts=7)
    assert sorted(plain.collect()) == sorted(salted.select(plain.columns).collect())


def test_group_limit_runs_before_the_shuffle(spark):
    df = spark.range(100).select("id", (F.col("id") % 5).alias("g"), F.col("id").alias("score"))
    top = ranking.top_k_per_group(df, ["g"], ranking.by_score(), 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_tied_labels_give_the_first_in_the_alphabet(spark):
    rows = [(i, "a", 2020, 1, 1, "t", s) for i, s in enumerate([0.9, -0.9, 0.0])]
    assert ranking.modal_label(scored(spark, rows), ["subreddit"]).collect()[0][1] == "Negative"
    only_null = scored(spark, [(1, "a", 2020, 1, 1, "t", None)])
    assert ranking.modal_label(only_null, ["subreddit"]).collect()[0][1] is None


def test_overall_label_counts_each_community_once(spark):
    rows = [(i, "big", 2020, 1, 1, "t", 0.9) for i in range(50)]
    rows += [(100, "b", 2020, 1, 1, "t", -0.9), (101, "c", 2020, 1, 1, "t", -0.9)]
    overall = monthly.overall_month(monthly.community_month(scored(spark, rows))).collect()[0]
    assert overall["overall_sentiment"] == "Negative" and overall["top40_sentiment"] == "Negative"
    assert overall["overall_sentiment_score"] == pytest.approx((0.9 - 0.9 - 0.9) / 3)


def test_month_date_of_bad_parts_is_null(spark):
    df = spark.createDataFrame([(2020, 3), (None, 3), (2020, None), (2020, 13)], "year int, month int")
    assert [r[0] for r in df.select(month_date()).collect()] == [dt.date(2020, 3, 1), None, None, None]


def test_quarantine_and_valid_rows_partition_the_input(spark):
    df = scored(spark, [
        (1, "a", 2020, 1, 1, "t", 0.0), (2, None, 2020, 1, 1, "t", 0.0), (3, "a", None, 1, 1, "t", 0.0),
    ])
    assert [r["id"] for r in submissions.valid_keys(df).collect()] == [1]
    assert sorted(r["id"] for r in submissions.quarantine(df).collect()) == [2, 3]


def test_one_sided_communities_stay_and_zero_base_has_no_relative_change(spark):
    df = spark.createDataFrame(
        [("a", "2020-01-01", 0.0, 0.1), ("a", "2020-04-01", 0.2, 0.3), ("b", "2020-04-01", 0.5, 0.6)],
        "subreddit string, date string, avg_sentiment_score double, top40_avg_sentiment_score double",
    ).withColumn("date", F.col("date").cast("date"))
    one_pass = change.before_after(df, "2020-03-01")
    joined = change.before_after_outer(df, "2020-03-01").select(one_pass.columns)
    assert sorted(one_pass.collect()) == sorted(joined.collect())
    table = {r["subreddit"]: r for r in change.change_table(one_pass, "median").collect()}
    assert table["a"]["absolute_change"] == 0.2 and table["a"]["relative_change"] is None
    assert table["b"]["before_median"] is None and table["b"]["after_median"] == 0.5


def test_period_splits_agree(spark):
    df = spark.createDataFrame([(y, m) for y in (2019, 2020, 2021) for m in range(1, 13)], "year int, month int")
    both = change.split_before_after_ym(monthly.with_month_date(df), "2020-03-01").withColumnRenamed("period", "ym")
    assert change.split_before_after(both, "2020-03-01").filter("period <> ym OR period IS NULL").count() == 0


def test_relative_change_uses_the_size_of_the_old_value(spark):
    df = spark.createDataFrame([(-0.2, 0.1)], "b double, a double")
    assert df.select(relative_change(F.col("b"), F.col("a"))).collect()[0][0] == pytest.approx(150.0)


def test_bins_equal_pandas_cut(spark):
    import numpy as np
    import pandas as pd

    values = np.round(np.random.default_rng(1).uniform(-1, 1, 5000), 2)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = {r["v"]: r["bin"] for r in with_bins(df, "v").collect()}
    low, high = values.min(), values.max()
    edges = np.arange(low, high + 0.05, 0.05)
    expected = pd.cut(pd.Series(values), bins=edges, labels=False)
    for value, index in zip(values, expected):
        assert got[float(value)] == (None if np.isnan(index) else int(index))
    assert got[float(low)] is None
    lowest = with_bins(df, "v", include_lowest=True).filter(F.col("v") == float(low)).first()
    assert lowest["bin"] == 0


def test_sorted_write_splits_a_hot_key_and_keeps_global_order(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("subreddit"),
        F.lit(2020).alias("year"), F.lit(1).alias("month"), "id",
    )
    placed = submissions.sorted_for_write(df).withColumn("part", F.spark_partition_id())
    rows = placed.select("part", "subreddit").collect()
    by_part = [[r[1] for r in rows if r[0] == p] for p in sorted({r[0] for r in rows})]
    assert [s for part in by_part for s in part] == sorted(r[1] for r in rows)


def test_union_fills_missing_columns(spark):
    a, b = spark.range(1).withColumn("t", F.lit("x")), spark.range(1)
    assert submissions.union_by_name([a, b], missing=True).filter("t IS NULL").count() == 1


def test_nan_is_in_no_bin_and_moves_none(spark):
    values = [None, 1.0, 4.0, 5.0]
    plain = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    odd = plain.union(spark.createDataFrame([(9, float("nan"))], "i int, v double"))
    want = {r["i"]: r["bin"] for r in with_bins(plain, "v", width=1.0).collect()}
    got = {r["i"]: r["bin"] for r in with_bins(odd, "v", width=1.0).collect()}
    assert got == want | {9: None} and want[3] == 3


def test_heap_of_the_top_k_equals_the_ranked_one(spark):
    """Null and tied scores and ids, null labels, in whole and in fractional scores; one shuffle, one scan."""
    rows = spark.range(4000).selectExpr(
        "cast(2020 + id % 2 as int) year", "cast(1 + id % 3 as int) month",
        "if(id % 3 = 0, 'hot', concat('c', id % 17)) subreddit", "'t' title",
        "if(id % 11 = 0, null, cast(id * 7919 % 23 as int)) score", "if(id % 13 = 0, null, concat('i', id)) id",
        "if(id % 5 = 0, null, element_at(array('Negative', 'Neutral', 'Positive'), cast(1 + id % 3 as int))) sentiment",
        "if(id % 7 = 0, null, cast(id % 19 as double) / 16) sentiment_score",
    ).filter("id is not null or score > 20")

    def as_rows(df):
        return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)

    for scores in (rows, rows.withColumn("score", F.col("score").cast("double"))):
        heaped, ranked = monthly.community_month(scores, 6), monthly.community_month(scores, 6, salts=3)
        assert heaped.schema.simpleString() == ranked.select(*heaped.columns).schema.simpleString()
        assert as_rows(heaped) == as_rows(ranked)
    plan = heaped._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Range (") == 1
    assert monthly.community_month(rows.limit(0)).count() == 0
