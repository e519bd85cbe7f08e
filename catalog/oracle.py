"""SQL for each registered query."""

from __future__ import annotations

from catalog import oracle_parts as P
from catalog.inputs import BIN_WIDTH, CUT, EVENT_CUT, SUBSET_COMMUNITIES, SUBSET_YEARS
from catalog.oracle_sentiment import PER_DOCUMENT, PER_LABEL

ORACLE: dict[str, str] = {}

WIDE = [P.POSTS, P.WIDE_POSTS]
SERIES = [P.POSTS, P.TITLED, P.TOP, P.COMMUNITY]
EXACT = [P.POSTS, P.TITLED, P.TOP, P.COMMUNITY_EXACT]
EXACT_OVERALL = [*EXACT, P.OVERALL_EXACT]
SUBSET = f"""subreddit IN ({', '.join(f"'{c}'" for c in SUBSET_COMMUNITIES)})
  AND year IN ({', '.join(map(str, SUBSET_YEARS))})"""
NARROW = "archived, author, gilded, num_comments, score, selftext, subreddit, title, year, month"
KEYS = P.MONTH_KEYS


def add(name: str, parts: list[str], body: str) -> None:
    ORACLE[name] = P.with_(parts, body)


# Sources and sinks.
add("scan_submissions", WIDE, "SELECT * FROM wide")
add("scan_multi_dir", WIDE, f"""
SELECT {NARROW.replace('title', "CASE WHEN CAST(substr(name, 4) AS BIGINT) % 2 = 0 THEN title END AS title")} FROM wide""")
add("scan_partitioned", WIDE, "SELECT * FROM wide")
add("extract_partitioned", WIDE, f"SELECT * FROM wide WHERE {SUBSET}")
add("json_roundtrip", WIDE, "SELECT * FROM wide")
COMMUNITY_ROWS = """
SELECT date, format_month, month, sentiment_most, subreddit, round(avg_sentiment_score, 10) + 0.0 AS avg_sentiment_score,
  round(top40_avg_sentiment_score, 10) + 0.0 AS top40_avg_sentiment_score, top40_sentiment_most, year FROM community"""
add("scan_gz_json", SERIES, COMMUNITY_ROWS)
add("clean_submissions", [P.POSTS], "SELECT subreddit, year, month, title, score FROM posts")
add("extract_subset", [P.POSTS], f"SELECT id, subreddit, year, month, title, score FROM posts WHERE {SUBSET}")
add("quarantine_rows", [P.POSTS], """
SELECT id, year, CAST(CASE WHEN id % 53 <> 0 THEN month ELSE 13 END AS INT) AS month,
  CASE WHEN id % 59 <> 0 THEN subreddit END AS subreddit
FROM posts WHERE id % 53 = 0 OR id % 59 = 0""")
BROKEN = """lines AS (
  SELECT id, CASE WHEN id % 53 = 0 THEN substr(line, 1, 40) ELSE line END AS line FROM (
    SELECT id, '{' || CASE WHEN id % 67 <> 0 THEN '"subreddit":"' || subreddit || '",' ELSE '' END || '"year":' || year || ',"month":'
      || CASE WHEN id % 61 <> 0 THEN month ELSE 13 END || ',"title":"post ' || id || '","score":'
      || CASE WHEN id % 59 <> 0 THEN CAST(score AS VARCHAR) ELSE '"many"' END || '}' AS line FROM posts)),
marked AS (
  SELECT id, line, CASE WHEN id % 53 = 0 OR id % 59 = 0 THEN 'not readable' WHEN id % 67 = 0 THEN 'no community'
    WHEN id % 61 = 0 THEN 'no month' END AS reason FROM lines)"""
add("unread_records", [P.POSTS, BROKEN], """
SELECT reason, CASE WHEN reason = 'not readable' THEN line END AS unread,
  CASE WHEN reason <> 'not readable' THEN 'post ' || id END AS title
FROM marked WHERE reason IS NOT NULL""")
add("quarantine_counts", [P.POSTS, BROKEN], """
SELECT reason IS NULL AS has_keys, reason, count(*) AS posts FROM marked GROUP BY ALL""")
add("month_update", [P.POSTS], """
SELECT subreddit, year, month, round(avg(s), 10) + 0.0 AS avg_sentiment_score, arg_min(label, (-n, label)) AS sentiment_most FROM (
  SELECT *, count(*) OVER (PARTITION BY subreddit, year, month, label) AS n,
    round(v / sqrt(v * v + 15), 4) AS s FROM (
    SELECT subreddit, year, month, CASE WHEN good THEN 1.9 WHEN id % 3 = 1 THEN -2.5 ELSE 0.0 END::DOUBLE AS v,
      CASE WHEN good THEN 'Positive' WHEN id % 3 = 1 THEN 'Negative' ELSE 'Neutral' END AS label
    FROM (SELECT *, id % 3 = 0 OR (year = 1997 AND month = 5) AS good FROM posts WHERE NOT (year = 1995 AND month = 2))))
GROUP BY subreddit, year, month""")
add("union_by_name", [P.POSTS], "SELECT id, subreddit, year, month FROM posts")
add("union_missing_cols", [P.POSTS], "SELECT id, year, CASE WHEN year < 1998 THEN title END AS title FROM posts")

# Scalar columns.
add("month_date", [P.POSTS], "SELECT id, format_month, date FROM posts")
add("sentiment_label", [P.POSTS], "SELECT id, sentiment_score, sentiment FROM posts")
add("split_before_after", [P.POSTS], f"SELECT id, date, {P.PERIOD} AS period FROM posts")
add("split_before_after_ym", [P.POSTS], f"SELECT id, year, month, {P.PERIOD} AS period FROM posts")
add("distinct_groups", [P.POSTS], "SELECT DISTINCT subreddit FROM posts")


def binned(source: str, value: str) -> str:
    """Rows of ``source`` with their bin: the edges strictly below the value, less one."""
    return f"""ends AS (SELECT min({value}) AS low, max({value}) AS high FROM {source}),
edges AS (SELECT low + i * ((low + {BIN_WIDTH}) - low) AS edge
  FROM ends, range(0, 1000) r(i) WHERE i < ceil((high + {BIN_WIDTH} - low) / {BIN_WIDTH})),
binned AS (SELECT t.*, CASE WHEN {value} > (SELECT low FROM ends) AND {value} <= (SELECT max(edge) FROM edges)
  THEN CAST((SELECT count(*) FROM edges WHERE edge < t.{value}) - 1 AS INT) END AS bin FROM {source} t)"""


add("bin_scores", [P.POSTS, binned("posts", "sentiment_score")], "SELECT id, sentiment_score, bin FROM binned")

# Monthly series.
add("community_month_avg", SERIES, f"SELECT {KEYS}, round(avg_sentiment_score, 10) + 0.0 AS avg_sentiment_score FROM community")
add("topk_per_group", SERIES, "SELECT id, year, month, subreddit, score, upvote_rank FROM top")
add("topk_per_group_salted", SERIES, """
SELECT * FROM (SELECT id, subreddit, score,
  CAST(row_number() OVER (PARTITION BY subreddit ORDER BY score DESC NULLS LAST, id) AS INT) AS upvote_rank FROM titled)
WHERE upvote_rank <= 1500""")
add("topk_avg", SERIES, f"""
SELECT {KEYS}, round(avg(sentiment_score), 10) + 0.0 AS top40_avg_sentiment_score FROM top GROUP BY {KEYS}""")
add("label_frequency", SERIES, f"SELECT {KEYS}, sentiment, count(sentiment) AS frequency FROM titled GROUP BY ALL")
add("topk_label_frequency", SERIES, f"SELECT {KEYS}, sentiment, count(sentiment) AS frequency_40 FROM top GROUP BY ALL")
add("modal_label", SERIES, P.mode_per("titled", KEYS, "sentiment", "sentiment_most"))
add("topk_modal_label", SERIES, P.mode_per("top", KEYS, "sentiment", "top40_sentiment_most"))
add("community_month", SERIES, COMMUNITY_ROWS)
add("overall_month", EXACT_OVERALL, """
SELECT date, year, month, format_month, round(overall_sentiment_score, 12) + 0.0 AS overall_sentiment_score,
  round(overall_top40_sentiment_score, 12) + 0.0 AS overall_top40_sentiment_score, overall_sentiment, top40_sentiment
FROM overall""")
add("overall_by_posts", SERIES, """
SELECT year, month, count(*) AS posts, round(avg(sentiment_score), 10) + 0.0 AS mean_sentiment_score,
  lpad(CAST(month AS VARCHAR), 2, '0') AS format_month, make_date(year, month, 1) AS date FROM titled GROUP BY year, month""")
add("overall_modal_label", SERIES, """
SELECT date, year, month, sentiment_most AS overall_sentiment, sentiment_sum FROM (
  SELECT date, year, month, sentiment_most, count(sentiment_most) AS sentiment_sum,
    row_number() OVER (PARTITION BY year, month ORDER BY count(sentiment_most) DESC, sentiment_most) AS r
  FROM community GROUP BY date, year, month, sentiment_most) WHERE r = 1""")

# Strongly positive and negative posts.
AVERAGES = ["pos_avg_score", "neg_avg_score", "total_avg_score"]
COUNTS = ["num_pos_submissions", "num_neg_submissions", "overall_num_submissions"]
OVERALL_VALUES = ["overall_sentiment_score", "overall_top40_sentiment_score"]
COMMUNITY_VALUES = ["avg_sentiment_score", "top40_avg_sentiment_score"]
REPLACED = ", ".join(f"round({a}, 4) + 0.0 AS {a}" for a in AVERAGES)
for names, part, source in (
    (("significant_overall", "significant_overall_from_counts", "outer_join_chain"), P.SIGNIFICANT, "significant"),
    (("significant_by_group", "significant_by_group_from_counts", "outer_join_chain_by_group"), P.SIGNIFICANT_GROUP, "significant_group"),
):
    for name in names:
        add(name, [P.POSTS, part], f"SELECT * REPLACE ({REPLACED}) FROM {source}")

# Before and after.
add("group_median_mean", EXACT, """
SELECT subreddit, round(median(avg_sentiment_score), 12) + 0.0 AS median_sentiment,
  round(avg(top40_avg_sentiment_score), 12) + 0.0 AS mean_top40_sentiment FROM community GROUP BY subreddit""")
add("group_rank_median", EXACT, """
SELECT subreddit, round(median(avg_sentiment_score), 12) + 0.0 AS median_sentiment FROM community GROUP BY subreddit
ORDER BY 2 DESC, 1""")
add("group_rank_topk_mean", EXACT, """
SELECT subreddit, round(avg(top40_avg_sentiment_score), 12) + 0.0 AS mean_top40_sentiment FROM community GROUP BY subreddit
ORDER BY 2 DESC, 1""")
SIDES = ", ".join(
    f"round({s}, 12) + 0.0 AS {s}" for s in ("before_median", "before_mean", "after_median", "after_mean")
)
CHANGES = [*SERIES, P.CHANGE]
EXACT_CHANGES = [*EXACT, P.CHANGE]
for name in ("before_after_table", "before_after_outer"):
    add(name, EXACT_CHANGES, f"SELECT subreddit, {SIDES} FROM sides")
for statistic in ("median", "mean"):
    add(f"change_{statistic}", EXACT_CHANGES, f"""
SELECT subreddit, round(before_{statistic}, 12) + 0.0 AS before_{statistic}, round(after_{statistic}, 12) + 0.0 AS after_{statistic},
  round({statistic}_absolute_change, 12) + 0.0 AS absolute_change, round({statistic}_relative_change, 6) + 0.0 AS relative_change
FROM change""")
    pieces = [f"before_{statistic}", f"after_{statistic}", f"{statistic}_absolute_change"]
    add(f"unpivot_change_{statistic}", EXACT_CHANGES, f"""
SELECT subreddit, replace(variable, '{statistic}_absolute', 'absolute') AS time, round(value, 12) + 0.0 AS average
FROM ({P.melted('change', ['subreddit'], pieces)})""")

# Samples.
def samples(source: str, values: list[str], name: str = "samples", slice_: str = "'all'", keys: tuple = ()) -> str:
    head = [f"{P.PERIOD} AS period", *keys]
    return f"{name} AS (SELECT *, {slice_} AS slice FROM ({P.melted(source, head, values)}))"


OVERALL_PARTS = [*SERIES, P.OVERALL]
SIGNIFICANT_PARTS = [P.POSTS, P.SIGNIFICANT]
OVERALL_SAMPLES = [*OVERALL_PARTS, samples("overall", OVERALL_VALUES)]
SIGNIFICANT_SAMPLES = [*SIGNIFICANT_PARTS, samples("significant", AVERAGES + COUNTS)]


def community_samples(slice_: str = "'all'", name: str = "samples") -> list[str]:
    return [*SERIES, samples("community", COMMUNITY_VALUES, name, slice_, ("subreddit",))]


def event_samples(slice_: str = "'all'") -> list[str]:
    return [P.EVENTS.replace("SELECT event_type", f"SELECT {slice_} AS slice, event_type")]


add("period_mean_std", [*EXACT_OVERALL, samples("overall", OVERALL_VALUES)], """
SELECT variable, period, count(value) AS n, round(avg(value), 12) + 0.0 AS mean, round(stddev_samp(value), 12) + 0.0 AS std
FROM samples GROUP BY variable, period""")
add("period_mean_diff", SIGNIFICANT_SAMPLES, """
SELECT variable, n1, n2, round(b, 4) + 0.0 AS before_mean, round(a, 4) + 0.0 AS after_mean, round(a - b, 4) + 0.0 AS mean_diff FROM (
  SELECT variable, count(value) FILTER (WHERE period = 'before') AS n1,
    count(value) FILTER (WHERE period = 'after') AS n2, avg(value) FILTER (WHERE period = 'before') AS b, avg(value) FILTER (WHERE period = 'after') AS a
  FROM samples GROUP BY variable)""")

# Independence.
add("crosstab_group_label", SERIES, """
SELECT subreddit, sentiment_most, count(*) AS observed FROM community
WHERE sentiment_most IS NOT NULL GROUP BY subreddit, sentiment_most""")
add("crosstab_group_label_wide", SERIES, """
SELECT subreddit, count(*) FILTER (WHERE sentiment_most = 'Negative') AS "Negative",
  count(*) FILTER (WHERE sentiment_most = 'Neutral') AS "Neutral",
  count(*) FILTER (WHERE sentiment_most = 'Positive') AS "Positive" FROM community GROUP BY subreddit""")
add("chi2_label", SERIES, P.chi2("community", "subreddit", "sentiment_most", "sentiment_most"))
add("chi2_topk_label", SERIES, P.chi2("community", "subreddit", "top40_sentiment_most", "top40_sentiment_most"))
for name, value in zip(("chi2_binned", "chi2_binned_topk"), COMMUNITY_VALUES):
    add(name, [*SERIES, binned("community", value)], P.chi2("binned", "subreddit", "bin", f"{value}_bin"))
ORACLE["chi2_quality_by_source"] = P.chi2(
    "(SELECT source, quality FROM labels JOIN documents USING (doc_id))", "source", "quality", "quality"
).strip()
ORACLE["chi2_quality_by_toxicity"] = P.chi2("labels", "quality", "toxic", "quality").strip()

# Tests.
PERIOD_SLICES = [*OVERALL_PARTS, samples("overall", OVERALL_VALUES, slice_="period")]
add("shapiro_wilk", PERIOD_SLICES, P.shapiro("samples"))
CHANGE_VALUES = [
    "before_median", "after_median", "median_absolute_change", "median_relative_change",
    "before_mean", "after_mean", "mean_absolute_change", "mean_relative_change",
]


def change_samples(slice_: str, name: str = "samples") -> str:
    return f"{name} AS (SELECT *, '{slice_}' AS slice FROM ({P.melted('change', [], CHANGE_VALUES)}))"


RELATIVE = ("mean_relative_change", "median_relative_change")


def pair_samples(pairs: dict[str, tuple[str, str]], slice_: str, name: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{variable}' AS variable, variable AS period, value FROM ({P.melted('change', [], columns)})"
        for variable, columns in pairs.items()
    )
    return f"{name} AS (SELECT *, '{slice_}' AS slice FROM ({rows}))"


add("shapiro_wilk_change", [*CHANGES, change_samples("all")], P.shapiro("samples"))
add("mann_whitney_change", [*CHANGES, pair_samples({"relative_change": RELATIVE}, "all", "samples")],
    P.rank_sum("samples", pair=RELATIVE))
add("levene", OVERALL_SAMPLES, P.levene("samples"))
add("levene_significant", SIGNIFICANT_SAMPLES, P.levene("samples"))
add("ttest_student", OVERALL_SAMPLES, P.student("samples"))
add("ttest_welch", SIGNIFICANT_SAMPLES, P.welch("samples"))
add("mann_whitney", OVERALL_SAMPLES, P.rank_sum("samples"))
add("cohens_d", OVERALL_SAMPLES, P.effect_size("samples"))
add("cohens_d_significant", SIGNIFICANT_SAMPLES, P.effect_size("samples"))
add("anova_oneway", community_samples(), P.anova("samples", "subreddit"))
add("kruskal_wallis", community_samples(), P.kruskal("samples", "subreddit"))
add("dagostino_k2", community_samples(), P.k2("samples"))
add("dagostino_k2_by_period", community_samples("period"), P.k2("samples"))
add("dagostino_k2_by_group", community_samples("subreddit"), P.k2("samples"))
add("levene_events", event_samples(), P.levene("samples", "event_type"))
add("anova_events", event_samples(), P.anova("samples", "event_type"))
add("kruskal_events", event_samples(), P.kruskal("samples", "event_type"))
add("mann_whitney_events", event_samples("event_type"), P.rank_sum("samples"))
add("dagostino_events", event_samples("event_type"), P.k2("samples"))
add("shapiro_wilk_events", event_samples("event_type"), P.shapiro("samples"))


# The three sets of tests.
def all_rows(*selects: str) -> str:
    return " UNION ALL ".join(f"SELECT * FROM ({select})" for select in selects)


def only(source: str, variables: tuple[str, ...]) -> str:
    return f"(SELECT * FROM {source} WHERE variable IN ({', '.join(repr(v) for v in variables)}))"


BOTH = "'before vs after'"
ACROSS = "across communities"
MEAN, TOP = OVERALL_VALUES
add("results_overall", [
    *OVERALL_PARTS, samples("overall", OVERALL_VALUES, "periods", "period"),
    samples("overall", OVERALL_VALUES, "joint", BOTH),
], all_rows(
    P.shapiro("periods"), P.levene("joint"), P.rank_sum(only("joint", (MEAN,))),
    P.student(only("joint", (TOP,))), P.mean_difference("joint"), P.effect_size("joint"),
))
POS, NEG, TOTAL = AVERAGES
add("results_significant", [
    *SIGNIFICANT_PARTS, samples("significant", AVERAGES, "periods", "period"),
    samples("significant", AVERAGES + COUNTS, "joint", BOTH),
], all_rows(
    P.shapiro("periods"), P.levene(only("joint", tuple(AVERAGES))), P.student(only("joint", (POS,))),
    P.welch(only("joint", (NEG, TOTAL))), P.mean_difference("joint"), P.effect_size("joint"),
))
PAIRS = {
    "absolute_change": ("median_absolute_change", "mean_absolute_change"),
    "relative_change": RELATIVE,
    "mean": ("before_mean", "after_mean"),
    "median": ("before_median", "after_median"),
}
BINNED = [
    binned("community", value).replace("ends", f"ends{i}").replace("edges", f"edges{i}").replace("binned", f"binned{i}")
    for i, value in enumerate(COMMUNITY_VALUES)
]
add("results_groups", [
    *CHANGES,
    samples("community", COMMUNITY_VALUES, "everything", "'all'", ("subreddit",)),
    samples("community", COMMUNITY_VALUES, "periods", "period", ("subreddit",)),
    samples("community", COMMUNITY_VALUES, "groups", "subreddit", ("subreddit",)),
    samples("community", COMMUNITY_VALUES, "joint", BOTH, ("subreddit",)),
    samples("community", COMMUNITY_VALUES, "across", f"'{ACROSS}'", ("subreddit",)),
    change_samples(ACROSS, "changed"), pair_samples(PAIRS, ACROSS, "pairs"), *BINNED,
], all_rows(
    P.chi2("community", "subreddit", "sentiment_most", "sentiment_most", ACROSS),
    P.chi2("community", "subreddit", "top40_sentiment_most", "top40_sentiment_most", ACROSS),
    P.k2("everything"), P.k2("periods"), P.levene("joint"), P.anova("across", "subreddit"), P.k2("groups"),
    P.kruskal(only("across", (COMMUNITY_VALUES[1],)), "subreddit"),
    P.chi2("binned0", "subreddit", "bin", f"{COMMUNITY_VALUES[0]}_bin", ACROSS),
    P.chi2("binned1", "subreddit", "bin", f"{COMMUNITY_VALUES[1]}_bin", ACROSS),
    P.shapiro("changed"), P.levene("pairs"),
    P.student(only("pairs", ("relative_change",)), pair=RELATIVE),
    P.rank_sum(only("pairs", ("relative_change",)), pair=RELATIVE),
))

def curve(source: str, keys: str, value: str) -> list[str]:
    """Kernel density on 128 points: linear binning, then the kernel between all pairs of points."""
    return [f"""rows AS (SELECT {keys}, {value}::DOUBLE AS v FROM {source} WHERE {value} IS NOT NULL)""",
    f"""limits AS (SELECT {keys}, n, w, low - 4.0 * w AS low, (high + 4.0 * w - (low - 4.0 * w)) / 127 AS step FROM (
      SELECT {keys}, count(*)::DOUBLE AS n, min(v) AS low, max(v) AS high, stddev_samp(v) * pow(count(*)::DOUBLE, -0.2) AS w FROM rows GROUP BY {keys})
      WHERE w > 0)""",
    f"""places AS (SELECT {keys}, (v - low) / step AS place, least(floor((v - low) / step), 126)::INT AS pos FROM rows JOIN limits USING ({keys}))""",
    f"""weights AS (SELECT {keys}, pos, sum(weight) AS weight FROM (
      SELECT {keys}, pos, 1 - (place - pos) AS weight FROM places UNION ALL SELECT {keys}, pos + 1, place - pos FROM places) GROUP BY {keys}, pos)""",
    f"""curve AS (SELECT {keys}, p AS point, low + p * step AS x,
      sum(weight * exp(-pow((p - pos) * step / w, 2) / 2)) / (n * w * sqrt(2 * pi())) AS density
      FROM limits CROSS JOIN (SELECT unnest(range(128))::INT AS p) JOIN weights USING ({keys}) GROUP BY {keys}, p, low, step, n, w)"""]


add("density_by_group", [*SERIES, """long AS (
  SELECT subreddit, 'avg_sentiment_score' AS variable, round(avg_sentiment_score, 10) + 0.0 AS value FROM community
  UNION ALL SELECT subreddit, 'top40_avg_sentiment_score', round(top40_avg_sentiment_score, 10) + 0.0 FROM community)""", *curve("long", "variable, subreddit", "value")],
    "SELECT variable, subreddit, point, round(x, 9) + 0.0 AS x, round(density, 9) + 0.0 AS density FROM curve")
add("density_events", curve("events", "event_type", "value"), "SELECT event_type, point, round(x, 9) + 0.0 AS x, round(density, 9) + 0.0 AS density FROM curve")
add("density_integral", curve("events", "event_type", "value"), """
SELECT event_type, count(*) AS points, abs(sum(density) * any_value(step) - 1) < 1e-3 AS whole
FROM curve JOIN limits USING (event_type) GROUP BY event_type""")
ORACLE["sketch_quantiles"] = ("""
SELECT event_type, share::DOUBLE AS share, n, true AS within
FROM (SELECT event_type, count(value) AS n FROM events GROUP BY event_type), (SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.95]) AS share)""")

# Chart tables.
add("distribution_by_group", EXACT, f"""
SELECT subreddit, variable, count(value) AS n, round(min(value), 12) + 0.0 AS low,
  round(quantile_cont(value, 0.25), 12) + 0.0 AS lower_quartile, round(median(value), 12) + 0.0 AS median,
  round(quantile_cont(value, 0.75), 12) + 0.0 AS upper_quartile, round(max(value), 12) + 0.0 AS high
FROM ({P.melted('community', ['subreddit'], COMMUNITY_VALUES)}) WHERE value IS NOT NULL GROUP BY subreddit, variable""")
add("histogram_by_group", [*SERIES, binned("community", "avg_sentiment_score")], """
SELECT subreddit, bin, count(*) AS months FROM (
  SELECT subreddit, CASE WHEN avg_sentiment_score = (SELECT low FROM ends) THEN 0 ELSE bin END AS bin FROM binned)
WHERE bin IS NOT NULL GROUP BY subreddit, bin""")
add("histogram_by_group_topk", [*SERIES, binned("community", "top40_avg_sentiment_score")], """
SELECT subreddit, bin, count(*) AS months FROM (
  SELECT subreddit, CASE WHEN top40_avg_sentiment_score = (SELECT low FROM ends) THEN 0 ELSE bin END AS bin FROM binned)
WHERE bin IS NOT NULL GROUP BY subreddit, bin""")
LINES = "SELECT date, period, variable, round(value, {digits}) + 0.0 AS value FROM ({rows})"
DATED = ["date", f"{P.PERIOD} AS period"]
add("series_overall", EXACT_OVERALL, LINES.format(digits=12, rows=P.melted("overall", DATED, OVERALL_VALUES)))
add("series_counts", SIGNIFICANT_PARTS, LINES.format(digits=4, rows=P.melted("significant", DATED, COUNTS)))
add("series_scores", SIGNIFICANT_PARTS, LINES.format(digits=4, rows=P.melted("significant", DATED, AVERAGES)))

# Sentiment of whole texts.
ORACLE["sentiment_score"] = ORACLE["sentiment_score_by_text"] = PER_DOCUMENT
ORACLE["scored_submissions"] = PER_LABEL
