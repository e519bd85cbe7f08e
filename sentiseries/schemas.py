"""Explicit schemas of every table the jobs read back.

No reader infers a schema: the JSON writer drops null fields, so a column that
is null in every row would be missing after an inferred read.
"""

from pyspark.sql import types as T


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_BOOL, _STR, _LONG, _INT = T.BooleanType(), T.StringType(), T.LongType(), T.IntegerType()
_DOUBLE, _DATE = T.DoubleType(), T.DateType()

SUBMISSIONS_WIDE = _schema(
    archived=_BOOL, author=_STR, created=_LONG, downs=_LONG, gilded=_LONG,
    name=_STR, num_comments=_LONG, score=_LONG, selftext=_STR, subreddit=_STR,
    title=_STR, ups=_LONG, year=_INT, month=_INT,
)

SUBMISSIONS = _schema(
    archived=_BOOL, author=_STR, gilded=_LONG, num_comments=_LONG, score=_LONG,
    selftext=_STR, subreddit=_STR, title=_STR, year=_INT, month=_INT,
)

CLEANED = _schema(subreddit=_STR, year=_INT, month=_INT, title=_STR, score=_LONG)

# As written: ``has_keys`` tells the usable rows from the quarantined ones, which have a
# reason and, if they could not be read, their raw text. ``input_file`` is a row's source.
CLEANED_MARKED = T.StructType([*CLEANED.fields, *_schema(reason=_STR, unread=_STR, input_file=_STR, has_keys=_BOOL).fields])

# Of each input file, the months its rows went to.
INPUT_MONTHS = _schema(file=_STR, path=_STR, size=_LONG, modified=T.TimestampType(), has_keys=_BOOL, year=_INT, month=_INT)

SCORED = _schema(
    subreddit=_STR, year=_INT, month=_INT, title=_STR, score=_LONG,
    sentiment=_STR, sentiment_score=_DOUBLE,
)

COMMUNITY_MONTH = _schema(
    date=_DATE, format_month=_STR, month=_INT, sentiment_most=_STR, subreddit=_STR,
    avg_sentiment_score=_DOUBLE, top40_avg_sentiment_score=_DOUBLE,
    top40_sentiment_most=_STR, year=_INT,
)

OVERALL_MONTH = _schema(
    date=_DATE, year=_INT, month=_INT, overall_sentiment_score=_DOUBLE,
    overall_top40_sentiment_score=_DOUBLE, overall_sentiment=_STR,
    format_month=_STR, top40_sentiment=_STR,
)

SIGNIFICANT_OVERALL = _schema(
    date=_DATE, num_pos_submissions=_LONG, num_neg_submissions=_LONG,
    pos_sum_score=_LONG, neg_sum_score=_LONG, pos_avg_score=_DOUBLE,
    neg_avg_score=_DOUBLE, overall_num_submissions=_LONG, overall_sum_score=_LONG,
    total_avg_score=_DOUBLE,
)

SIGNIFICANT_BY_GROUP = _schema(
    date=_DATE, subreddit=_STR, num_pos_submissions=_LONG, num_neg_submissions=_LONG,
    pos_sum_score=_LONG, neg_sum_score=_LONG, pos_avg_score=_DOUBLE,
    neg_avg_score=_DOUBLE, num_total_submissions=_LONG, total_sum_score=_LONG,
    total_avg_score=_DOUBLE,
)

LEXICON = _schema(token=_STR, valence=_DOUBLE)
