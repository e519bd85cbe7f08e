"""End-to-end jobs: extract, build the series, run the tests, lay out the charts.

Each job writes its tables and the next one reads them back with a known schema,
so no step repeats the work of an earlier one.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sentiseries import schemas
from sentiseries.operators import change, monthly, series, significant
from sentiseries.operators.sentiment import lexicon_frame, read_lexicon, score_sentiment
from sentiseries.plans import batteries, inputs
from sentiseries.plans.settings import Settings
from sentiseries.sources import submissions
from sentiseries.sources.storage import delete_folder, exists, stored, write, write_partitions

CLEANED, SCORED = "cleaned", "scored"
COMMUNITY, OVERALL = "community_month", "overall_month"
OVERALL_BY_POSTS = "overall_month_by_posts"
SIGNIFICANT, SIGNIFICANT_BY_GROUP = "significant_overall", "significant_by_group"
# Cleaned posts carry no key. A hash of the title settles equal scores: rows equal in
# both have the same title and so the same sentiment, and the sort stays narrow.
TITLE_KEY = "title_key"
MARKED_MONTH = ("has_keys", *inputs.MONTH)
MANIFEST = "input_months"
# How a writer names the folder of a null.
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


def _qualified(spark: SparkSession, path: str) -> str:
    one = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = one.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.makeQualified(one).toString().rstrip("/") + "/"


def extract(spark: SparkSession, settings: Settings, target: str) -> None:
    """Copy the studied communities and years out of the full collection, as gzip JSON.

    The target is replaced, so it may not lie in the collection, nor the other way round.
    Records that cannot be read are passed on in ``unread``, for ``clean`` to set apart.
    """
    source, out = _qualified(spark, settings.raw_dir), _qualified(spark, target)
    if source.startswith(out) or out.startswith(source):
        raise ValueError(f"the target {target} and the collection {settings.raw_dir} lie in each other")
    posts = submissions.scan_submissions(spark, settings.raw_dir, unread=True)
    write(submissions.extract_with_unread(posts, settings.communities, settings.years), target, "json")


def _read(spark: SparkSession, settings: Settings, name: str, schema) -> DataFrame:
    return submissions.read_table(spark, settings.table(name), schema, settings.table_format)


def _write(settings: Settings, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> None:
    write(df, settings.table(name), settings.table_format, partition_by)


def _monthly(settings: Settings, df: DataFrame, name: str, months: list[inputs.Month] | None, by: tuple[str, ...]) -> None:
    """Write a table with a folder for each month: all of it, or the months that ``df`` has."""
    if months is None:
        _write(settings, df, name, by)
    else:
        write_partitions(df, settings.table(name), settings.table_format, by)


def clean(spark: SparkSession, settings: Settings, change: inputs.Change | None = None) -> None:
    """Project the submissions, a folder for each month, communities in order.

    Rows without usable keys and records that cannot be read are set apart under
    ``has_keys=false`` by the same write, with a reason. The input is read once.
    """
    months, files = (change.months, change.files) if change else (None, None)
    posts = submissions.scan_multi_dir(spark, settings.input_dir, unread=True, files=files, source=inputs.FILE)
    marked = submissions.clean_marked(posts).filter(inputs.in_months(months))
    ordered = submissions.spread_for_write(marked, MARKED_MONTH, ("subreddit",))
    _monthly(settings, ordered, CLEANED, months, MARKED_MONTH)


def quarantined(spark: SparkSession, settings: Settings) -> DataFrame:
    """The rows ``clean`` set apart."""
    return _read(spark, settings, CLEANED, schemas.CLEANED_MARKED).filter("NOT has_keys")


def quarantine_counts(spark: SparkSession, settings: Settings) -> DataFrame:
    """Rows kept, and rows set apart for each reason."""
    marked = _read(spark, settings, CLEANED, schemas.CLEANED_MARKED)
    return submissions.quarantine_counts(marked)


def score(spark: SparkSession, settings: Settings, months: list[inputs.Month] | None = None) -> None:
    """Score and label every cleaned post; the scored table is laid out by month."""
    marked = _read(spark, settings, CLEANED, schemas.CLEANED_MARKED)
    cleaned = marked.filter("has_keys").filter(inputs.in_months(months)).select(*schemas.CLEANED.fieldNames())
    path = settings.lexicon_path
    lexicon = read_lexicon(spark, path) if path else lexicon_frame(spark)
    scored = score_sentiment(cleaned, lexicon, labels=settings.labels)
    _monthly(settings, submissions.spread_for_write(scored), SCORED, months, inputs.MONTH)


def build_series(spark: SparkSession, settings: Settings, months: list[inputs.Month] | None = None) -> None:
    """The community and overall monthly series and both significance tables.

    The scored table is read four times: for all posts and the top k of each community,
    for the mean over posts, and for the counts both significance tables are made of.
    With ``months``, only their folders are read, and only their rows of the tables made again.
    """
    scored = _read(spark, settings, SCORED, schemas.SCORED).filter(inputs.in_months(months))
    ordered = scored.withColumn(TITLE_KEY, F.xxhash64("title"))
    community = stored(monthly.community_month(ordered, settings.top_k, (TITLE_KEY,), settings.top_k_salts), COMMUNITY)
    dated = monthly.with_month_date(scored)
    counts = stored(significant.significant_counts(dated, settings.significant_cut), "significant_counts")
    made = {
        COMMUNITY: (community, ("subreddit", "date")), OVERALL: (monthly.overall_month(community), ("date",)),
        OVERALL_BY_POSTS: (monthly.overall_by_posts(scored), ("date",)),
        SIGNIFICANT: (significant.from_counts(counts), ("date",)),
        SIGNIFICANT_BY_GROUP: (significant.from_counts(counts, ("date", "subreddit"), significant.GROUP_TOTALS), ("date", "subreddit")),
    }
    for name, (table, order) in made.items():
        if months is not None:
            table = stored(table.unionByName(_other_months(spark, settings, name, table.schema, months)), name)
        _write(settings, table.orderBy(*order), name)


def _other_months(spark: SparkSession, settings: Settings, name: str, schema, months: list[inputs.Month]) -> DataFrame:
    """The rows of a finished table that other months have."""
    table = submissions.read_table(spark, settings.table(name), schema, settings.table_format)
    of = table.withColumns({"year": F.year("date"), "month": F.month("date")})
    return of.filter(~inputs.in_months([m for m in months if None not in m])).select(*table.columns)


def _fingerprint(spark: SparkSession, settings: Settings) -> str:
    """What the monthly tables were made with, the lexicon's files included."""
    files = []
    if settings.lexicon_path:
        listed = submissions.list_files(spark, settings.lexicon_path).select("file", "size", "modified")
        files = sorted(str(tuple(r)) for r in listed.collect())
    return json.dumps({**settings.of_months(), "lexicon_files": files}, sort_keys=True)


def _known(spark: SparkSession, settings: Settings, made_with: str) -> DataFrame | None:
    """The last finished run's manifest, if it was made with the same settings."""
    path = settings.table(MANIFEST)
    if not exists(spark, path):
        return None
    found = submissions.read_table(spark, path, T.StructType([*schemas.INPUT_MONTHS.fields, T.StructField("made_with", T.StringType())]))
    row = found.select("made_with").first()
    return found.drop("made_with") if row and row[0] == made_with else None


def process(spark: SparkSession, settings: Settings, full: bool = False) -> list[inputs.Month] | None:
    """Bring all monthly tables up to date; returns the months made again, None for all.

    The first run, one with other settings, and one with ``full`` make all months. Later
    ones make those months again whose input files changed, see ``plans.inputs``.
    """
    made_with = _fingerprint(spark, settings)
    change = inputs.changes(spark, settings.input_dir, None if full else _known(spark, settings, made_with))
    if not change.nothing:
        clean(spark, settings, change)
        for keys, year, month in change.stale:
            part = "/".join(f"{n}={HIVE_NULL if v is None else v}" for n, v in (("year", year), ("month", month)))
            delete_folder(spark, f"{settings.table(CLEANED)}/has_keys={str(keys).lower()}/{part}")
            if keys:
                delete_folder(spark, f"{settings.table(SCORED)}/{part}")
        _write(settings, quarantine_counts(spark, settings), "quarantine_counts")
        score(spark, settings, change.months)
        build_series(spark, settings, change.months)
    manifest = change.manifest
    if manifest is None:
        manifest = stored(inputs.manifest_of(change.listing, _read(spark, settings, CLEANED, schemas.CLEANED_MARKED)), MANIFEST)
    write(manifest.withColumn("made_with", F.lit(made_with)), settings.table(MANIFEST))
    return change.months


def overall_results(spark: SparkSession, settings: Settings) -> DataFrame:
    overall = _read(spark, settings, OVERALL, schemas.OVERALL_MONTH)
    return batteries.overall_battery(overall, settings.cut_date, settings.alpha)


def significant_results(spark: SparkSession, settings: Settings) -> DataFrame:
    table = _read(spark, settings, SIGNIFICANT, schemas.SIGNIFICANT_OVERALL)
    return batteries.significant_battery(table, settings.cut_date, settings.alpha)


def community_results(spark: SparkSession, settings: Settings) -> DataFrame:
    community = _read(spark, settings, COMMUNITY, schemas.COMMUNITY_MONTH)
    return batteries.community_battery(
        community, settings.cut_date, settings.alpha, settings.bin_width
    )


def period_means(spark: SparkSession, settings: Settings) -> DataFrame:
    """Mean and standard deviation before and after, of every monthly series."""
    overall = _read(spark, settings, OVERALL, schemas.OVERALL_MONTH)
    counts = _read(spark, settings, SIGNIFICANT, schemas.SIGNIFICANT_OVERALL)
    cut = settings.cut_date
    return change.period_mean_std(submissions.union_by_name([
        batteries.period_samples(overall, batteries.OVERALL, cut),
        batteries.period_samples(counts, batteries.AVERAGES + batteries.COUNTS, cut),
    ]))


def run_tests(spark: SparkSession, settings: Settings) -> None:
    """Write the three results tables and the means they compare."""
    _write(settings, period_means(spark, settings), "period_means")
    _write(settings, overall_results(spark, settings), "results_overall")
    _write(settings, significant_results(spark, settings), "results_significant")
    _write(settings, community_results(spark, settings), "results_communities")


def chart_tables(spark: SparkSession, settings: Settings) -> dict[str, DataFrame]:
    """The table behind each chart."""
    cut = settings.cut_date
    community = _read(spark, settings, COMMUNITY, schemas.COMMUNITY_MONTH)
    overall = _read(spark, settings, OVERALL, schemas.OVERALL_MONTH)
    counts = _read(spark, settings, SIGNIFICANT, schemas.SIGNIFICANT_OVERALL)
    ranked = change.group_median_mean(community)
    both = change.before_after(community, cut)
    return {
        "distribution_by_group": series.distribution_by_group(community),
        "histogram_by_group": series.histogram_by_group(community, width=settings.bin_width),
        "histogram_by_group_topk": series.histogram_by_group(
            community, "top40_avg_sentiment_score", settings.bin_width
        ),
        "group_rank_median": series.ranked_groups(ranked, "median_sentiment"),
        "group_rank_topk_mean": series.ranked_groups(ranked, "mean_top40_sentiment"),
        "change_median": change.melt_change(change.change_table(both, "median"), "median"),
        "change_mean": change.melt_change(change.change_table(both, "mean"), "mean"),
        "series_overall": series.monthly_lines(overall, batteries.OVERALL, cut),
        "series_counts": series.monthly_lines(counts, batteries.COUNTS, cut),
        "series_scores": series.monthly_lines(counts, batteries.AVERAGES, cut),
    }


def write_charts(spark: SparkSession, settings: Settings) -> None:
    for name, table in chart_tables(spark, settings).items():
        _write(settings, table, f"charts/{name}")
