"""Building blocks of the SQL the queries are checked against.

Written the plain way on purpose (global ranks by window, tail probabilities by
numerical integration), so that it shares no method with the Spark side.
"""

from __future__ import annotations

from catalog import fixed_values as fixed
from catalog.inputs import CUT, EVENT_CUT, TOP_K

POSTS = """
posts AS (
  SELECT p.*,
    CASE WHEN sentiment_score >= 0.05 THEN 'Positive' WHEN sentiment_score <= -0.05 THEN 'Negative'
         WHEN sentiment_score IS NOT NULL THEN 'Neutral' END AS sentiment,
    lpad(CAST(month AS VARCHAR), 2, '0') AS format_month, make_date(year, month, 1) AS date
  FROM (
    SELECT o_orderkey AS id, o_orderpriority AS subreddit, CAST(year(o_orderdate) AS INT) AS year,
      CAST(month(o_orderdate) AS INT) AS month, CAST(floor(o_totalprice) AS BIGINT) AS score,
      CASE WHEN o_orderkey % 97 <> 0 THEN concat('post ', CAST(o_orderkey AS VARCHAR)) END AS title,
      CASE WHEN o_orderkey % 97 <> 0
           THEN CAST((o_orderkey * 7919) % 2001 - 1000 AS DOUBLE) / 1000 END AS sentiment_score
    FROM orders) p
)"""

WIDE_POSTS = """
wide AS (
  SELECT o_orderstatus = 'F' AS archived, concat('user ', CAST(o_custkey AS VARCHAR)) AS author,
    CAST(datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 86400 AS BIGINT) AS created,
    o_orderkey % 7 AS downs, o_orderkey % 3 AS gilded, concat('t3_', CAST(o_orderkey AS VARCHAR)) AS name,
    o_custkey % 50 AS num_comments, p.score,
    CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS selftext, p.subreddit, p.title,
    p.score + o_orderkey % 7 AS ups, p.year, p.month
  FROM orders JOIN posts p ON p.id = o_orderkey
)"""

TITLED = "titled AS (SELECT * FROM posts WHERE title IS NOT NULL)"

TOP = f"""
top AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY year, month, subreddit
                                      ORDER BY score DESC NULLS LAST, id) AS INT) AS upvote_rank
    FROM titled) WHERE upvote_rank <= {TOP_K}
)"""


def mode_per(source: str, keys: str, label: str, out: str) -> str:
    return f"""
  SELECT {keys}, {label} AS {out} FROM (
    SELECT {keys}, {label}, row_number() OVER (PARTITION BY {keys} ORDER BY count({label}) DESC, {label}) AS r
    FROM {source} GROUP BY {keys}, {label}) WHERE r = 1"""


MONTH_KEYS = "year, month, subreddit"
COMMUNITY = f"""
community AS (
  SELECT a.*, m.sentiment_most, t.top40_avg_sentiment_score, tm.top40_sentiment_most,
    lpad(CAST(a.month AS VARCHAR), 2, '0') AS format_month, make_date(a.year, a.month, 1) AS date
  FROM (SELECT {MONTH_KEYS}, round(avg(sentiment_score), 10) + 0.0 AS avg_sentiment_score FROM titled GROUP BY ALL) a
  LEFT JOIN ({mode_per('titled', MONTH_KEYS, 'sentiment', 'sentiment_most')}) m USING ({MONTH_KEYS})
  LEFT JOIN (SELECT {MONTH_KEYS}, round(avg(sentiment_score), 10) + 0.0 AS top40_avg_sentiment_score FROM top GROUP BY ALL) t
    USING ({MONTH_KEYS})
  LEFT JOIN ({mode_per('top', MONTH_KEYS, 'sentiment', 'top40_sentiment_most')}) tm USING ({MONTH_KEYS})
)"""

# What is published as a mean of means is averaged from unrounded means: a mean of values
# kept to some places may lie exactly half way between two last places.
COMMUNITY_EXACT = COMMUNITY.replace("round(avg(sentiment_score), 10) + 0.0", "avg(sentiment_score)")

OVERALL = f"""
overall AS (
  SELECT a.*, m.overall_sentiment, t.top40_sentiment
  FROM (SELECT date, year, month, format_month, round(avg(avg_sentiment_score), 12) + 0.0 AS overall_sentiment_score,
          round(avg(top40_avg_sentiment_score), 12) + 0.0 AS overall_top40_sentiment_score
        FROM community GROUP BY ALL) a
  LEFT JOIN ({mode_per('community', 'date', 'sentiment_most', 'overall_sentiment')}) m USING (date)
  LEFT JOIN ({mode_per('community', 'date', 'top40_sentiment_most', 'top40_sentiment')}) t USING (date)
)"""

OVERALL_EXACT = OVERALL.replace("round(avg(avg_sentiment_score), 12) + 0.0", "avg(avg_sentiment_score)").replace(
    "round(avg(top40_avg_sentiment_score), 12) + 0.0", "avg(top40_avg_sentiment_score)"
)


def significant_table(name: str, keys: str, totals: tuple[str, str, str]) -> str:
    def side(rows: str, n: str, s: str, a: str) -> str:
        return f"""(SELECT {keys}, count(title) AS {n}, CAST(sum(score) AS BIGINT) AS {s}, avg(score) AS {a}
                    FROM posts {rows} GROUP BY {keys})"""

    pos = side("WHERE sentiment_score > 0.5", "num_pos_submissions", "pos_sum_score", "pos_avg_score")
    neg = side("WHERE sentiment_score < -0.5", "num_neg_submissions", "neg_sum_score", "neg_avg_score")
    return f"""
{name} AS (
  SELECT * FROM {pos} p FULL JOIN {neg} n USING ({keys}) FULL JOIN {side('', *totals)} t USING ({keys})
)"""


SIGNIFICANT = significant_table(
    "significant", "date", ("overall_num_submissions", "overall_sum_score", "total_avg_score")
)
SIGNIFICANT_GROUP = significant_table(
    "significant_group", "date, subreddit", ("num_total_submissions", "total_sum_score", "total_avg_score")
)

PERIOD = f"CASE WHEN date < DATE '{CUT}' THEN 'before' ELSE 'after' END"

CHANGE = f"""
sides AS (
  SELECT * FROM (
    SELECT subreddit, median(avg_sentiment_score) AS before_median, avg(top40_avg_sentiment_score) AS before_mean
    FROM community WHERE date < DATE '{CUT}' GROUP BY subreddit) b
  FULL JOIN (
    SELECT subreddit, median(avg_sentiment_score) AS after_median, avg(top40_avg_sentiment_score) AS after_mean
    FROM community WHERE date >= DATE '{CUT}' GROUP BY subreddit) a USING (subreddit)
),
change AS (
  SELECT *, after_median - before_median AS median_absolute_change,
    (after_median - before_median) / nullif(abs(before_median), 0) * 100 AS median_relative_change,
    after_mean - before_mean AS mean_absolute_change,
    (after_mean - before_mean) / nullif(abs(before_mean), 0) * 100 AS mean_relative_change
  FROM sides
)"""

BASE = [POSTS, TITLED, TOP, COMMUNITY, OVERALL, SIGNIFICANT, SIGNIFICANT_GROUP, CHANGE]


def with_(parts: list[str], body: str) -> str:
    return "WITH " + ",\n".join(part.strip() for part in parts) + "\n" + body


def melted(source: str, keys: list[str], values: list[str] | tuple[str, ...]) -> str:
    """Long form of some columns, one SELECT per column, nulls kept."""
    head = "".join(f"{k}, " for k in keys)
    return " UNION ALL ".join(
        f"SELECT {head}'{v}' AS variable, CAST({v} AS DOUBLE) AS value FROM {source}" for v in values
    )


# Tail probabilities by Simpson's rule.

def simpson(integrand: str, low: str, high: str, steps: int = 20000) -> str:
    """Integral of ``integrand`` (a function of x) from ``low`` to ``high``."""
    width = f"(({high}) - ({low}))"
    return f"""(SELECT {width} / {3 * steps} * sum(w * ({integrand})) FROM (
      SELECT CASE WHEN g IN (0, {steps}) THEN 1 WHEN g % 2 = 1 THEN 4 ELSE 2 END AS w,
             ({low}) + {width} * g / {steps}.0 AS x FROM range(0, {steps + 1}) nodes(g)))"""


def normal_upper(z: str) -> str:
    return f"greatest(0.5 - {simpson('exp(-x * x / 2) / sqrt(2 * pi())', '0', z)}, 0)"


def t_two_sided(t: str, dof: str) -> str:
    scale = f"exp(lgamma(({dof} + 1) / 2.0) - lgamma({dof} / 2.0)) / sqrt(pi())"
    tail = simpson(f"pow(greatest(cos(x), 0), {dof} - 1)", f"atan(abs({t}) / sqrt({dof}))", "pi() / 2")
    return f"greatest(2 * {scale} * {tail}, 0)"


def f_upper(f: str, dof1: str, dof2: str) -> str:
    scale = f"exp(lgamma(({dof1} + {dof2}) / 2.0) - lgamma({dof1} / 2.0) - lgamma({dof2} / 2.0))"
    area = simpson(
        f"pow(sin(x), {dof2} - 1) * pow(cos(x), {dof1} - 1)", "0",
        f"asin(sqrt({dof2} / ({dof2} + {dof1} * {f})))",
    )
    return f"greatest(2 * {scale} * {area}, 0)"


def chi2_upper(x: str, dof: str) -> str:
    density = (
        f"exp(({dof} - 1) * ln(greatest(x, 1e-300)) - x * x / 2 - ({dof} / 2.0 - 1) * ln(2)"
        f" - lgamma({dof} / 2.0))"
    )
    return f"greatest(1 - {simpson(density, '0', f'sqrt({x})')}, 0)"


# Tests. Each takes the name of a relation with (variable, slice, value) and a
# grouping column, and gives one results row per (variable, slice).

NOTHING = "CAST(NULL AS DOUBLE)"


def result_rows(source: str, test: str, statistic: str, n1: str, n2: str = "NULL",
                df1: str = NOTHING, df2: str = NOTHING, p: str = NOTHING) -> str:
    return f"""
SELECT test, variable, slice, n1, n2, round(statistic, 6) + 0.0 AS statistic, round(df1, 6) + 0.0 AS df1,
  round(df2, 6) + 0.0 AS df2, round(p, 6) + 0.0 AS p_value, p >= 0.05 AS keep_null
FROM (SELECT '{test}' AS test, variable, slice, CAST({n1} AS BIGINT) AS n1, CAST({n2} AS BIGINT) AS n2,
        CAST({statistic} AS DOUBLE) AS statistic, CAST({df1} AS DOUBLE) AS df1, CAST({df2} AS DOUBLE) AS df2,
        CAST({p} AS DOUBLE) AS p FROM ({source}) source_rows)"""


def two_sample_moments(samples: str, group: str, pair: tuple[str, str]) -> str:
    a, b = (f"FILTER (WHERE {group} = '{name}')" for name in pair)
    return f"""
  SELECT variable, slice, count(value) {a} AS n1, count(value) {b} AS n2, avg(value) {a} AS m1,
    avg(value) {b} AS m2, var_samp(value) {a} AS v1, var_samp(value) {b} AS v2
  FROM {samples} WHERE value IS NOT NULL GROUP BY variable, slice"""


PERIODS = ("before", "after")
POOLED = "((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)"


def student(samples: str, group: str = "period", pair: tuple[str, str] = PERIODS) -> str:
    rows = f"""SELECT *, (m1 - m2) / sqrt({POOLED} * (1.0 / n1 + 1.0 / n2)) AS t,
      CAST(n1 + n2 - 2 AS DOUBLE) AS dof FROM ({two_sample_moments(samples, group, pair)})"""
    return result_rows(rows, "ttest_student", "t", "n1", "n2", "dof", p=t_two_sided("t", "dof"))


def welch(samples: str, group: str = "period", pair: tuple[str, str] = PERIODS) -> str:
    rows = f"""SELECT *, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS t,
      pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS dof
      FROM ({two_sample_moments(samples, group, pair)})"""
    return result_rows(rows, "ttest_welch", "t", "n1", "n2", "dof", p=t_two_sided("t", "dof"))


def effect_size(samples: str, group: str = "period", pair: tuple[str, str] = PERIODS) -> str:
    rows = two_sample_moments(samples, group, pair)
    return result_rows(rows, "cohens_d", f"(m1 - m2) / sqrt({POOLED})", "n1", "n2")


def mean_difference(samples: str, group: str = "period", pair: tuple[str, str] = PERIODS) -> str:
    rows = two_sample_moments(samples, group, pair)
    return result_rows(rows, "mean_difference", "m2 - m1", "n1", "n2")


def f_ratio(values: str, test: str, group: str) -> str:
    rows = f"""
  SELECT variable, slice, count(*) AS n, count(DISTINCT {group}) AS k,
    CAST(count(DISTINCT {group}) - 1 AS DOUBLE) AS d1, CAST(count(*) - count(DISTINCT {group}) AS DOUBLE) AS d2,
    (sum(pow(gm - am, 2)) / (count(DISTINCT {group}) - 1))
      / (sum(pow(value - gm, 2)) / (count(*) - count(DISTINCT {group}))) AS f
  FROM (SELECT *, avg(value) OVER (PARTITION BY variable, slice, {group}) AS gm,
               avg(value) OVER (PARTITION BY variable, slice) AS am FROM ({values}))
  GROUP BY variable, slice"""
    return result_rows(rows, test, "f", "n", "k", "d1", "d2", f_upper("f", "d1", "d2"))


def anova(samples: str, group: str) -> str:
    return f_ratio(f"SELECT * FROM {samples} WHERE value IS NOT NULL", "anova_oneway", group)


def levene(samples: str, group: str = "period") -> str:
    distances = f"""SELECT variable, slice, {group},
      abs(value - median(value) OVER (PARTITION BY variable, slice, {group})) AS value
      FROM {samples} WHERE value IS NOT NULL"""
    return f_ratio(distances, "levene", group)


def average_ranks(samples: str) -> str:
    return f"""SELECT *, rank() OVER (PARTITION BY variable, slice ORDER BY value)
      + (count(*) OVER (PARTITION BY variable, slice, value) - 1) / 2.0 AS r,
      CAST(count(*) OVER (PARTITION BY variable, slice, value) AS DOUBLE) AS t
      FROM {samples} WHERE value IS NOT NULL"""


def rank_sum(samples: str, group: str = "period", pair: tuple[str, str] = PERIODS) -> str:
    """Small untied samples are compared with every way to deal the ranks (up to ten)."""
    sums = f"""
  SELECT variable, slice, CAST(count(*) FILTER (WHERE {group} = '{pair[0]}') AS DOUBLE) AS a,
    CAST(count(*) FILTER (WHERE {group} = '{pair[1]}') AS DOUBLE) AS b,
    sum(r) FILTER (WHERE {group} = '{pair[0]}') AS rank_sum, sum(t * t - 1) AS ties
  FROM ({average_ranks(samples)}) GROUP BY variable, slice"""
    scores = f"SELECT *, rank_sum - a * (a + 1) / 2 AS u FROM ({sums})"
    spread = "sqrt(a * b / 12 * (a + b + 1 - ties / ((a + b) * (a + b - 1))))"
    z = f"greatest((abs(u - a * b / 2) - 0.5) / {spread}, 0)"
    deals = """(SELECT 2.0 * count(*) FILTER (WHERE v <= least(u, a * b - u)) / count(*) FROM (
      SELECT mask, sum(bit + 1) - a * (a + 1) / 2 AS v FROM range(0, 1024) m(mask), range(0, 10) d(bit)
      WHERE mask < pow(2, a + b) AND bit < a + b AND (mask >> bit) & 1 = 1 AND bit_count(mask) = a
      GROUP BY mask))"""
    p = f"""CASE WHEN least(a, b) <= 8 AND ties = 0 THEN least({deals}, 1)
      ELSE least(2 * {normal_upper(z)}, 1) END"""
    return result_rows(scores, "mann_whitney", "u", "a", "b", p=p)


def kruskal(samples: str, group: str) -> str:
    rows = f"""
  SELECT variable, slice, sum(size) AS n, count(*) AS k, CAST(count(*) - 1 AS DOUBLE) AS dof,
    (12 / (sum(size) * (sum(size) + 1)) * sum(rs * rs / size) - 3 * (sum(size) + 1))
      / (1 - sum(ties) / (pow(sum(size), 3) - sum(size))) AS h
  FROM (SELECT variable, slice, {group}, CAST(count(*) AS DOUBLE) AS size, sum(r) AS rs, sum(t * t - 1) AS ties
        FROM ({average_ranks(samples)}) GROUP BY ALL)
  GROUP BY variable, slice"""
    return result_rows(rows, "kruskal_wallis", "h", "n", "k", "dof", p=chi2_upper("h", "dof"))


def k2(samples: str) -> str:
    rows = f"""
  WITH centred AS (
    SELECT variable, slice, value - avg(value) OVER (PARTITION BY variable, slice) AS d
    FROM {samples} WHERE value IS NOT NULL),
  shape AS (
    SELECT variable, slice, CAST(count(*) AS DOUBLE) AS n, avg(pow(d, 3)) / pow(avg(d * d), 1.5) AS g,
      avg(pow(d, 4)) / pow(avg(d * d), 2) AS b FROM centred GROUP BY ALL),
  first AS (
    SELECT *, g * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
      sqrt(2 * (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) - 1)) - 1 AS w2,
      (b - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / (pow(n + 1, 2) * (n + 3) * (n + 5))) AS x,
      6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS s
    FROM shape),
  second AS (
    SELECT *, ln(y / sqrt(2 / (w2 - 1)) + sqrt(y * y / (2 / (w2 - 1)) + 1)) / sqrt(ln(w2) / 2) AS zs,
      6 + 8 / s * (2 / s + sqrt(1 + 4 / (s * s))) AS a FROM first),
  third AS (SELECT *, 1 + x * sqrt(2 / (a - 4)) AS q FROM second)
  SELECT *, zs * zs + pow((1 - 2 / (9 * a) - sign(q) * pow((1 - 2 / a) / abs(q), 1.0 / 3)) / sqrt(2 / (9 * a)), 2) AS k
  FROM third"""
    return result_rows(rows, "dagostino_k2", "k", "n", df1="2.0", p="exp(-k / 2)")


def chi2(table: str, row: str, column: str, variable: str, slice_: str = "all") -> str:
    both = f"{table} WHERE {row} IS NOT NULL AND {column} IS NOT NULL"
    rows = f"""
  WITH cells AS (SELECT {row} AS a, {column} AS b, count(*) AS o FROM {both} GROUP BY ALL),
  ra AS (SELECT a, sum(o) AS ta FROM cells GROUP BY a), cb AS (SELECT b, sum(o) AS tb FROM cells GROUP BY b),
  whole AS (SELECT sum(o) AS n, CAST((SELECT count(*) - 1 FROM ra) * (SELECT count(*) - 1 FROM cb) AS DOUBLE) AS dof
            FROM cells),
  grid AS (SELECT coalesce(o, 0) AS o, CAST(ta * tb AS DOUBLE) / n AS e, n, dof
           FROM ra CROSS JOIN cb CROSS JOIN whole LEFT JOIN cells USING (a, b))
  SELECT '{variable}' AS variable, '{slice_}' AS slice, any_value(n) AS n, any_value(dof) AS dof,
    sum(CASE WHEN dof = 1 THEN pow(greatest(abs(o - e) - 0.5, 0), 2) / e ELSE pow(o - e, 2) / e END) AS x2
  FROM grid"""
    return result_rows(rows, "chi2_independence", "x2", "n", df1="dof", p=chi2_upper("x2", "dof"))


def _polynomial(x: str, coefficients: tuple[float, ...]) -> str:
    return " + ".join(f"{c!r}::DOUBLE * pow({x}, {i})" for i, c in enumerate(coefficients))


def shapiro(samples: str) -> str:
    def ratio(x: str, num: tuple[float, ...], den: tuple[float, ...]) -> str:
        return f"({_polynomial(x, num)}) / ({_polynomial(x, den)})"

    rows = f"""
  WITH placed AS (
    SELECT variable, slice, value AS x,
      CAST(row_number() OVER (PARTITION BY variable, slice ORDER BY value) AS DOUBLE) AS i,
      CAST(count(*) OVER (PARTITION BY variable, slice) AS DOUBLE) AS n
    FROM {samples} WHERE value IS NOT NULL),
  p AS (SELECT *, (i - 0.375) / (n + 0.25) AS p FROM placed),
  parts AS (SELECT *, 0.180625 - pow(p - 0.5, 2) AS mid, sqrt(-ln(least(p, 1 - p))) AS tail FROM p),
  scored AS (SELECT *, CASE WHEN abs(p - 0.5) <= 0.425 THEN (p - 0.5) * {ratio('mid', fixed.CENTRE_NUM, fixed.CENTRE_DEN)}
      WHEN tail <= 5 THEN sign(p - 0.5) * {ratio('(tail - 1.6)', fixed.MIDDLE_NUM, fixed.MIDDLE_DEN)}
      ELSE sign(p - 0.5) * {ratio('(tail - 5)', fixed.TAIL_NUM, fixed.TAIL_DEN)} END AS m FROM parts),
  grouped AS (SELECT *, sum(m * m) OVER w AS ssm, max(m) OVER w AS ml,
      max(CASE WHEN i = n - 1 THEN m END) OVER w AS mk, 1 / sqrt(n) AS u, avg(x) OVER w AS mean
    FROM scored WINDOW w AS (PARTITION BY variable, slice)),
  ends AS (SELECT *, {_polynomial('u', fixed.LAST_WEIGHT)} + ml / sqrt(ssm) AS al,
      {_polynomial('u', fixed.NEXT_WEIGHT)} + mk / sqrt(ssm) AS ak FROM grouped),
  weighted AS (SELECT *, CASE
      WHEN n = 3 THEN sign(m) * sqrt(0.5)
      WHEN i = n THEN al WHEN i = 1 THEN -al
      WHEN n <= 5 THEN m / sqrt((ssm - 2 * ml * ml) / (1 - 2 * al * al))
      WHEN i = n - 1 THEN ak WHEN i = 2 THEN -ak
      ELSE m / sqrt((ssm - 2 * ml * ml - 2 * mk * mk) / (1 - 2 * al * al - 2 * ak * ak)) END AS weight
    FROM ends),
  final AS (SELECT variable, slice, any_value(n) AS n, ln(any_value(n)) AS ln_n,
      pow(sum(weight * x), 2) / sum(pow(x - mean, 2)) AS w FROM weighted GROUP BY ALL),
  standard AS (SELECT *, CASE WHEN n <= 11
      THEN (-ln({_polynomial('n', fixed.SMALL_BOUND)} - ln(1 - w)) - ({_polynomial('n', fixed.SMALL_MEAN)}))
           / exp({_polynomial('n', fixed.SMALL_LOG_SD)})
      ELSE (ln(1 - w) - ({_polynomial('ln_n', fixed.LARGE_MEAN)})) / exp({_polynomial('ln_n', fixed.LARGE_LOG_SD)}) END AS z
    FROM final)
  SELECT * FROM standard"""
    return result_rows(rows, "shapiro_wilk", "w", "n", p=normal_upper("z"))


EVENTS = f"""
samples AS (
  SELECT event_type, 'value' AS variable, value,
    CASE WHEN CAST(ts AS DATE) < DATE '{EVENT_CUT}' THEN 'before' ELSE 'after' END AS period FROM events
)"""
