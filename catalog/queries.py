"""One Spark query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from catalog.inputs import (
    BIN_WIDTH, CUT, EVENT_CUT, LEXICON, RULES, SUBSET_COMMUNITIES, SUBSET_YEARS, TOP_K, posts,
    table, wide_posts,
)
from sentiseries import schemas
from sentiseries.functions.bins import with_bins
from sentiseries.functions.scalars import format_month, month_date
from sentiseries.operators import change, density, monthly, ranking, series, significant, sketches
from sentiseries.operators.sentiment import lexicon_frame, score_sentiment
from sentiseries.plans import batteries, jobs
from sentiseries.plans.settings import Settings
from sentiseries.sources import submissions
from sentiseries.sources.storage import delete_folder, fresh_path, stored, write_json, write_partitions
from sentiseries.stats.chi2 import chi2_independence, crosstab, crosstab_wide
from sentiseries.stats.levene import levene
from sentiseries.stats.moments import (
    anova_oneway, cohens_d, dagostino_k2, ttest_student, ttest_welch,
)
from sentiseries.stats.ranks import kruskal_wallis, mann_whitney
from sentiseries.stats.shapiro import shapiro_wilk

Query = Callable[[SparkSession, str], DataFrame]
KEYS = batteries.KEYS
QUERIES: dict[str, Query] = {}

SENTIMENT_DIGITS = 10
# Statistics of means, taken from means that were not rounded before.
SERIES_DIGITS = 12
SCORE_DIGITS = 4
TEST_DIGITS = 6


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def rounded_results(df: DataFrame) -> DataFrame:
    return rounded(df, TEST_DIGITS, "statistic", "df1", "df2", "p_value")


# Monthly tables. What is published as a mean of means starts from the exact ones; the
# tests start from means kept to ten places, so that equal ones tie whatever order they
# were summed in, written once per query.

def exact_community(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.community_month(posts(spark, sf_dir), TOP_K)


def exact_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.overall_month(exact_community(spark, sf_dir))


def community(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(exact_community(spark, sf_dir), SENTIMENT_DIGITS, *batteries.COMMUNITY)


def overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = monthly.overall_month(community(spark, sf_dir))
    return rounded(exact, SERIES_DIGITS, *batteries.OVERALL)


def stored_community(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(community(spark, sf_dir), "community_month")


def stored_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(overall(spark, sf_dir), "overall_month")


def dated_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.with_month_date(posts(spark, sf_dir))


def stored_significant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(significant.significant_overall(dated_posts(spark, sf_dir)), "significant")


# Sources and sinks.

@query
def scan_submissions(spark, sf_dir):
    path = fresh_path(spark, "submissions")
    write_json(wide_posts(spark, sf_dir).select(*schemas.SUBMISSIONS_WIDE.fieldNames()), path)
    return submissions.scan_submissions(spark, path)


@query
def scan_multi_dir(spark, sf_dir):
    path = fresh_path(spark, "directories")
    narrow = wide_posts(spark, sf_dir).select("id", *schemas.SUBMISSIONS.fieldNames())
    write_json(narrow.filter("id % 2 = 0").drop("id"), f"{path}/even")
    write_json(narrow.filter("id % 2 = 1").drop("id", "title"), f"{path}/odd")
    return submissions.scan_multi_dir(spark, path)


def _partitioned(spark, sf_dir):
    path = fresh_path(spark, "partitioned")
    write_json(wide_posts(spark, sf_dir).select(*schemas.SUBMISSIONS_WIDE.fieldNames()), path, ("year", "month"))
    return submissions.scan_submissions(spark, path)


@query
def scan_partitioned(spark, sf_dir):
    return _partitioned(spark, sf_dir)


@query
def extract_partitioned(spark, sf_dir):
    return submissions.extract_subset(_partitioned(spark, sf_dir), SUBSET_COMMUNITIES, SUBSET_YEARS)


@query
def scan_gz_json(spark, sf_dir):
    path = fresh_path(spark, "series")
    write_json(community(spark, sf_dir), path)
    return submissions.read_json(spark, path, schemas.COMMUNITY_MONTH)


@query
def json_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "round_trip")
    write_json(wide_posts(spark, sf_dir), path)
    return submissions.scan_submissions(spark, path)


@query
def clean_submissions(spark, sf_dir):
    cleaned = submissions.clean(submissions.valid_keys(wide_posts(spark, sf_dir)))
    return submissions.sorted_for_write(cleaned)


@query
def extract_subset(spark, sf_dir):
    subset = submissions.extract_subset(posts(spark, sf_dir), SUBSET_COMMUNITIES, SUBSET_YEARS)
    return subset.select("id", "subreddit", "year", "month", "title", "score")


@query
def quarantine_rows(spark, sf_dir):
    broken = posts(spark, sf_dir).withColumns({
        "month": F.when(F.col("id") % 53 != 0, F.col("month")).otherwise(13),
        "subreddit": F.when(F.col("id") % 59 != 0, F.col("subreddit")),
    })
    return submissions.quarantine(broken).select("id", "year", "month", "subreddit")


def _broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts as JSON lines; some cut off, with a word for the score, a 13th month or no community."""
    community = F.when(F.col("id") % 67 != 0, F.concat(F.lit('"subreddit":"'), "subreddit", F.lit('",'))).otherwise("")
    score = F.when(F.col("id") % 59 != 0, F.col("score").cast("string")).otherwise('"many"')
    month = F.when(F.col("id") % 61 != 0, F.col("month")).otherwise(13).cast("string")
    line = F.concat(
        F.lit("{"), community, F.lit('"year":'), F.col("year").cast("string"), F.lit(',"month":'), month,
        F.lit(',"title":"post '), F.col("id").cast("string"), F.lit('","score":'), score, F.lit("}"),
    )
    cut = F.when(F.col("id") % 53 == 0, F.substring(line, 1, 40)).otherwise(line)
    return posts(spark, sf_dir).select("id", cut.alias("value"))


def _marked_lines(spark, sf_dir):
    path = fresh_path(spark, "broken")
    lines = _broken_lines(spark, sf_dir)
    lines.filter("id % 2 = 0").select("value").write.option("compression", "gzip").text(f"{path}/even")
    lines.filter("id % 2 = 1").select("value").write.text(f"{path}/odd")
    return submissions.clean_marked(submissions.scan_multi_dir(spark, path, unread=True))


@query
def unread_records(spark, sf_dir):
    apart = _marked_lines(spark, sf_dir).filter("NOT has_keys")
    return apart.select("reason", "unread", F.when(F.col("unread").isNull(), F.col("title")).alias("title"))


@query
def quarantine_counts(spark, sf_dir):
    return submissions.quarantine_counts(_marked_lines(spark, sf_dir))


@query
def month_update(spark, sf_dir):
    """Community series after a second run of the job, one month's files changed and one month's gone."""
    root = fresh_path(spark, "monthly")
    toned = wide_posts(spark, sf_dir).withColumn("title", F.element_at(F.array(F.lit("a good day"), F.lit("a bad day"), F.lit("a day")), (F.col("id") % 3 + 1).cast("int")))
    rows = toned.select("id", *schemas.SUBMISSIONS.fieldNames())
    write_json(rows.repartition("year", "month"), f"{root}/input", ("year", "month"))
    settings = Settings(input_dir=f"{root}/input", output_dir=f"{root}/output", top_k=TOP_K)
    jobs.process(spark, settings)
    write_partitions(rows.filter("year = 1997 AND month = 5").withColumn("title", F.lit("a good day")).coalesce(1), f"{root}/input", "json", ("year", "month"))
    delete_folder(spark, f"{root}/input/year=1995/month=2")
    jobs.process(spark, settings)
    series = submissions.read_table(spark, settings.table(jobs.COMMUNITY), schemas.COMMUNITY_MONTH)
    return rounded(series.select("subreddit", "year", "month", "avg_sentiment_score", "sentiment_most"), SENTIMENT_DIGITS, "avg_sentiment_score")


@query
def union_by_name(spark, sf_dir):
    narrow = posts(spark, sf_dir).select("id", "subreddit", "year", "month")
    early, late = narrow.filter("year < 1998"), narrow.filter("year >= 1998")
    return submissions.union_by_name([early, late.select("month", "year", "subreddit", "id")])


@query
def union_missing_cols(spark, sf_dir):
    narrow = posts(spark, sf_dir).select("id", "year", "title")
    early, late = narrow.filter("year < 1998"), narrow.filter("year >= 1998").drop("title")
    return submissions.union_by_name([early, late], missing=True)


# Scalar columns.

def _month_date(spark, sf_dir):
    return posts(spark, sf_dir).select("id", format_month().alias("format_month"), month_date().alias("date"))


QUERIES["month_date"] = _month_date


@query
def sentiment_label(spark, sf_dir):
    return posts(spark, sf_dir).select("id", "sentiment_score", "sentiment")


@query
def split_before_after(spark, sf_dir):
    return change.split_before_after(dated_posts(spark, sf_dir), CUT).select("id", "date", "period")


@query
def split_before_after_ym(spark, sf_dir):
    return change.split_before_after_ym(posts(spark, sf_dir), CUT).select("id", "year", "month", "period")


@query
def distinct_groups(spark, sf_dir):
    return posts(spark, sf_dir).select("subreddit").distinct()


@query
def bin_scores(spark, sf_dir):
    binned = with_bins(posts(spark, sf_dir), "sentiment_score", "bin", BIN_WIDTH)
    return binned.select("id", "sentiment_score", "bin")


# Monthly series.

@query
def community_month_avg(spark, sf_dir):
    means = monthly.community_month_avg(posts(spark, sf_dir))
    return rounded(means, SENTIMENT_DIGITS, "avg_sentiment_score")


@query
def topk_per_group(spark, sf_dir):
    top = monthly.top_posts(posts(spark, sf_dir), TOP_K)
    return top.select("id", "year", "month", "subreddit", "score", "upvote_rank")


@query
def topk_per_group_salted(spark, sf_dir):
    top = ranking.top_k_per_group(
        monthly.titled(posts(spark, sf_dir)), ["subreddit"], ranking.by_score(), 1500, salt_on=["id"]
    )
    return top.select("id", "subreddit", "score", "upvote_rank")


@query
def topk_avg(spark, sf_dir):
    means = monthly.top_posts_avg(posts(spark, sf_dir), TOP_K)
    return rounded(means, SENTIMENT_DIGITS, "top40_avg_sentiment_score")


@query
def label_frequency(spark, sf_dir):
    return ranking.label_frequency(monthly.titled(posts(spark, sf_dir)), monthly.MONTH_KEYS)


@query
def topk_label_frequency(spark, sf_dir):
    top = monthly.top_posts(posts(spark, sf_dir), TOP_K)
    return ranking.label_frequency(top, monthly.MONTH_KEYS, out="frequency_40")


@query
def modal_label(spark, sf_dir):
    return ranking.modal_label(monthly.titled(posts(spark, sf_dir)), monthly.MONTH_KEYS)


@query
def topk_modal_label(spark, sf_dir):
    top = monthly.top_posts(posts(spark, sf_dir), TOP_K)
    return ranking.modal_label(top, monthly.MONTH_KEYS, out="top40_sentiment_most")


@query
def community_month(spark, sf_dir):
    return community(spark, sf_dir).orderBy("subreddit", "date")


@query
def overall_month(spark, sf_dir):
    return rounded(exact_overall(spark, sf_dir), SERIES_DIGITS, *batteries.OVERALL).orderBy("date")


@query
def overall_by_posts(spark, sf_dir):
    return rounded(monthly.overall_by_posts(posts(spark, sf_dir)), SENTIMENT_DIGITS, "mean_sentiment_score")


@query
def overall_modal_label(spark, sf_dir):
    return monthly.overall_modal_label(community(spark, sf_dir)).drop("format_month")


# Strongly positive and negative posts.

def _significant_rounded(df: DataFrame) -> DataFrame:
    return rounded(df, SCORE_DIGITS, *batteries.AVERAGES)


@query
def significant_overall(spark, sf_dir):
    return _significant_rounded(significant.significant_overall(dated_posts(spark, sf_dir)))


@query
def significant_by_group(spark, sf_dir):
    return _significant_rounded(significant.significant_by_group(dated_posts(spark, sf_dir)))


@query
def significant_overall_from_counts(spark, sf_dir):
    counts = stored(significant.significant_counts(dated_posts(spark, sf_dir)), "significant_counts")
    return _significant_rounded(significant.from_counts(counts))


@query
def significant_by_group_from_counts(spark, sf_dir):
    counts = stored(significant.significant_counts(dated_posts(spark, sf_dir)), "significant_counts")
    return _significant_rounded(significant.from_counts(counts, ("date", "subreddit"), significant.GROUP_TOTALS))


@query
def outer_join_chain(spark, sf_dir):
    return _significant_rounded(significant.significant_by_joins(dated_posts(spark, sf_dir)))


@query
def outer_join_chain_by_group(spark, sf_dir):
    joined = significant.significant_by_joins(
        dated_posts(spark, sf_dir), ("date", "subreddit"), significant.GROUP_TOTALS
    )
    return _significant_rounded(joined)


# Before and after.

@query
def group_median_mean(spark, sf_dir):
    statistics = change.group_median_mean(exact_community(spark, sf_dir))
    return rounded(statistics, SERIES_DIGITS, "median_sentiment", "mean_top40_sentiment")


def _ranked(spark, sf_dir, by):
    statistics = change.group_median_mean(exact_community(spark, sf_dir))
    return rounded(series.ranked_groups(statistics, by), SERIES_DIGITS, by)


@query
def group_rank_median(spark, sf_dir):
    return _ranked(spark, sf_dir, "median_sentiment")


@query
def group_rank_topk_mean(spark, sf_dir):
    return _ranked(spark, sf_dir, "mean_top40_sentiment")


def _both_sides(df: DataFrame) -> DataFrame:
    sides = ("before_median", "before_mean", "after_median", "after_mean")
    return rounded(df, SERIES_DIGITS, *sides)


@query
def before_after_table(spark, sf_dir):
    return _both_sides(change.before_after(exact_community(spark, sf_dir), CUT))


@query
def before_after_outer(spark, sf_dir):
    return _both_sides(change.before_after_outer(stored(exact_community(spark, sf_dir), "community_month"), CUT))


def _change(spark, sf_dir, statistic):
    return change.change_table(change.before_after(exact_community(spark, sf_dir), CUT), statistic)


def _change_rounded(spark, sf_dir, statistic):
    exact = _change(spark, sf_dir, statistic)
    close = rounded(
        exact, SERIES_DIGITS, f"before_{statistic}", f"after_{statistic}", "absolute_change"
    )
    return rounded(close, TEST_DIGITS, "relative_change")


@query
def change_median(spark, sf_dir):
    return _change_rounded(spark, sf_dir, "median")


@query
def change_mean(spark, sf_dir):
    return _change_rounded(spark, sf_dir, "mean")


def _melted(spark, sf_dir, statistic):
    long = change.melt_change(_change(spark, sf_dir, statistic), statistic)
    return rounded(long, SERIES_DIGITS, "average")


@query
def unpivot_change_median(spark, sf_dir):
    return _melted(spark, sf_dir, "median")


@query
def unpivot_change_mean(spark, sf_dir):
    return _melted(spark, sf_dir, "mean")


def overall_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batteries.period_samples(stored_overall(spark, sf_dir), batteries.OVERALL, CUT)


def significant_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = batteries.AVERAGES + batteries.COUNTS
    return batteries.period_samples(stored_significant(spark, sf_dir), values, CUT)


def community_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = change.split_before_after(stored_community(spark, sf_dir), CUT)
    return change.long_samples(dated, ["period", "subreddit"], batteries.COMMUNITY)


def event_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("date", F.col("ts").cast("date"))
    marked = change.split_before_after(events, EVENT_CUT)
    return change.long_samples(marked, ["period", "event_type"], ["value"])


def whole(samples: DataFrame) -> DataFrame:
    return samples.withColumn("slice", F.lit("all"))


def sliced(samples: DataFrame, by: str | Column) -> DataFrame:
    return samples.withColumn("slice", F.col(by) if isinstance(by, str) else by)


@query
def period_mean_std(spark, sf_dir):
    return rounded(change.period_mean_std(batteries.period_samples(stored(exact_overall(spark, sf_dir), "overall_month"), batteries.OVERALL, CUT)), SERIES_DIGITS, "mean", "std")


@query
def period_mean_diff(spark, sf_dir):
    differences = change.period_mean_diff(significant_samples(spark, sf_dir))
    return rounded(differences, SCORE_DIGITS, "before_mean", "after_mean", "mean_diff")


# Independence.

@query
def crosstab_group_label(spark, sf_dir):
    return crosstab(community(spark, sf_dir), "subreddit", "sentiment_most")


@query
def crosstab_group_label_wide(spark, sf_dir):
    labels = ["Negative", "Neutral", "Positive"]
    return crosstab_wide(community(spark, sf_dir), "subreddit", "sentiment_most", labels)


def _independent(rows: DataFrame, row: str, column: str, variable: str) -> DataFrame:
    keyed = whole(rows).withColumn("variable", F.lit(variable))
    return rounded_results(chi2_independence(keyed, row, column, KEYS))


@query
def chi2_label(spark, sf_dir):
    return _independent(stored_community(spark, sf_dir), "subreddit", "sentiment_most", "sentiment_most")


@query
def chi2_topk_label(spark, sf_dir):
    name = "top40_sentiment_most"
    return _independent(stored_community(spark, sf_dir), "subreddit", name, name)


@query
def chi2_binned(spark, sf_dir):
    binned = stored(with_bins(stored_community(spark, sf_dir), "avg_sentiment_score", "bin", BIN_WIDTH), "binned")
    return _independent(binned, "subreddit", "bin", "avg_sentiment_score_bin")


@query
def chi2_binned_topk(spark, sf_dir):
    name = "top40_avg_sentiment_score"
    binned = stored(with_bins(stored_community(spark, sf_dir), name, "bin", BIN_WIDTH), "binned")
    return _independent(binned, "subreddit", "bin", f"{name}_bin")


@query
def chi2_quality_by_source(spark, sf_dir):
    labelled = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id")
    return _independent(labelled, "source", "quality", "quality")


@query
def chi2_quality_by_toxicity(spark, sf_dir):
    return _independent(table(spark, sf_dir, "labels"), "quality", "toxic", "quality")


# Tests on the monthly series.

@query
def shapiro_wilk_change(spark, sf_dir):
    columns = batteries.change_columns(stored_community(spark, sf_dir), CUT)
    values = [c for c in columns.columns if c != "subreddit"]
    return rounded_results(shapiro_wilk(whole(change.long_samples(columns, [], values)), KEYS))


def _test(name: str, test, samples, make_slice=whole, **options) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded_results(test(make_slice(samples(spark, sf_dir)), KEYS, **options))

    QUERIES[name] = run


_test("shapiro_wilk", shapiro_wilk, overall_samples, lambda s: sliced(s, "period"))
_test("levene", levene, overall_samples)
_test("levene_significant", levene, significant_samples)
_test("ttest_student", ttest_student, overall_samples)
_test("ttest_welch", ttest_welch, significant_samples)
_test("mann_whitney", mann_whitney, overall_samples)
_test("cohens_d", cohens_d, overall_samples)
_test("cohens_d_significant", cohens_d, significant_samples)
_test("anova_oneway", anova_oneway, community_samples)
_test("kruskal_wallis", kruskal_wallis, community_samples)
_test("dagostino_k2", dagostino_k2, community_samples)
_test("dagostino_k2_by_period", dagostino_k2, community_samples, lambda s: sliced(s, "period"))
_test("dagostino_k2_by_group", dagostino_k2, community_samples, lambda s: sliced(s, "subreddit"))

# The same tests over every event, where the samples grow with the table.
_test("levene_events", levene, event_samples, group="event_type")
_test("anova_events", anova_oneway, event_samples, group="event_type")
_test("kruskal_events", kruskal_wallis, event_samples, group="event_type")
_test("mann_whitney_events", mann_whitney, event_samples, lambda s: sliced(s, "event_type"))
_test("dagostino_events", dagostino_k2, event_samples, lambda s: sliced(s, "event_type"))
_test("shapiro_wilk_events", shapiro_wilk, event_samples, lambda s: sliced(s, "event_type"))


@query
def mann_whitney_change(spark, sf_dir):
    columns = batteries.change_columns(stored_community(spark, sf_dir), CUT)
    pair = ("mean_relative_change", "median_relative_change")
    samples = whole(batteries.paired_columns(columns, {"relative_change": pair}))
    return rounded_results(mann_whitney(samples, KEYS, pair=pair))


# The three sets of tests as results tables.

@query
def results_overall(spark, sf_dir):
    return rounded_results(batteries.overall_battery(stored_overall(spark, sf_dir), CUT))


@query
def results_significant(spark, sf_dir):
    return rounded_results(batteries.significant_battery(stored_significant(spark, sf_dir), CUT))


@query
def results_groups(spark, sf_dir):
    return rounded_results(batteries.community_battery(stored_community(spark, sf_dir), CUT))


# Chart tables.

@query
def distribution_by_group(spark, sf_dir):
    numbers = ("low", "lower_quartile", "median", "upper_quartile", "high")
    return rounded(series.distribution_by_group(exact_community(spark, sf_dir)), SERIES_DIGITS, *numbers)


@query
def density_by_group(spark, sf_dir):
    samples = change.long_samples(stored_community(spark, sf_dir), ["subreddit"], batteries.COMMUNITY)
    curves = density.density(samples, ["variable", "subreddit"])
    return rounded(curves, 9, "x", "density")


@query
def density_events(spark, sf_dir):
    curves = density.density(table(spark, sf_dir, "events"), ["event_type"])
    return rounded(curves, 9, "x", "density")


@query
def density_integral(spark, sf_dir):
    """Whether the area under each curve is 1 within a thousandth."""
    curves = density.density(table(spark, sf_dir, "events"), ["event_type"])
    step = (F.max("x") - F.min("x")) / (F.count("x") - 1)
    area = curves.groupBy("event_type").agg((F.sum("density") * step).alias("area"), F.count("x").alias("points"))
    return area.select("event_type", "points", (F.abs(F.col("area") - 1) < 1e-3).alias("whole"))


SKETCH_SHARES = (0.05, 0.25, 0.5, 0.75, 0.95)


@query
def sketch_quantiles(spark, sf_dir):
    """Quantiles from daily sketches merged over all days: is each within the sketch's bound?"""
    events = table(spark, sf_dir, "events")
    daily = stored(sketches.sketches(events.withColumn("day", F.col("ts").cast("date")), ["event_type", "day"]), "sketches")
    found = sketches.with_quantiles(sketches.merged(daily, ["event_type"]), {f"q{i}": q for i, q in enumerate(SKETCH_SHARES)})
    each = F.explode(F.array(*(F.struct(F.lit(q).alias("share"), F.col(f"q{i}").alias("found")) for i, q in enumerate(SKETCH_SHARES))))
    asked = stored(found.select("event_type", "n", each.alias("a")).select("event_type", "n", "a.share", "a.found"), "quantiles")
    ranks = events.join(asked, "event_type").groupBy("event_type", "share", "n").agg(
        F.avg((F.col("value") <= F.col("found")).cast("int")).alias("upto"), F.avg((F.col("value") < F.col("found")).cast("int")).alias("below")
    )
    bound = sketches.rank_error()
    return ranks.select("event_type", "share", "n", ((F.col("below") - bound <= F.col("share")) & (F.col("share") <= F.col("upto") + bound)).alias("within"))


@query
def histogram_by_group(spark, sf_dir):
    return series.histogram_by_group(stored_community(spark, sf_dir), width=BIN_WIDTH)


@query
def histogram_by_group_topk(spark, sf_dir):
    return series.histogram_by_group(stored_community(spark, sf_dir), "top40_avg_sentiment_score", BIN_WIDTH)


@query
def series_overall(spark, sf_dir):
    return rounded(series.monthly_lines(exact_overall(spark, sf_dir), batteries.OVERALL, CUT), SERIES_DIGITS, "value")


@query
def series_counts(spark, sf_dir):
    counts = significant.significant_overall(dated_posts(spark, sf_dir))
    return rounded(series.monthly_lines(counts, batteries.COUNTS, CUT), SCORE_DIGITS, "value")


@query
def series_scores(spark, sf_dir):
    counts = significant.significant_overall(dated_posts(spark, sf_dir))
    return rounded(series.monthly_lines(counts, batteries.AVERAGES, CUT), SCORE_DIGITS, "value")


# Sentiment of whole texts.

def _scored_documents(spark, sf_dir, id_column):
    documents = submissions.dealt_out(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return score_sentiment(
        documents, lexicon_frame(spark, LEXICON), "text", id_column, rules=RULES
    )


@query
def sentiment_score(spark, sf_dir):
    return _scored_documents(spark, sf_dir, "doc_id").select("doc_id", "sentiment_score", "sentiment")


@query
def sentiment_score_by_text(spark, sf_dir):
    return _scored_documents(spark, sf_dir, None).select("doc_id", "sentiment_score", "sentiment")


@query
def scored_submissions(spark, sf_dir):
    scored = _scored_documents(spark, sf_dir, "doc_id")
    per_label = scored.groupBy("source", "sentiment").agg(
        F.count(F.lit(1)).alias("posts"), F.avg("sentiment_score").alias("avg_sentiment_score")
    )
    return rounded(per_label, SENTIMENT_DIGITS, "avg_sentiment_score")
