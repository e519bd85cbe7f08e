"""Lexicon sentiment of whole texts in column expressions, each row scored by itself.

A text is split into an array of words; a word that the lexicon knows is a sentiment
word, whose valence the words around it adjust. Looking up and adjusting are functions
over the row's own array, so a text is neither exploded into rows, joined nor shuffled,
and no Python runs. The lexicon is a literal of the plan: an array of small maps, one for
each remainder of the word's hash, so that a lookup costs the same for any size.

A word that occurs more than once takes the valence of its first occurrence, as
the published implementation looks tokens up by value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sentiseries.functions.scalars import Labels, sentiment_label
from sentiseries.operators import rules as R
from sentiseries.operators.rules import Rules
from sentiseries.schemas import LEXICON

# A lexicon is a list of words that every task holds; one with more entries is an error.
MOST_ENTRIES = 100_000

# A small original lexicon, enough to try the jobs; real use passes a full one.
SAMPLE_LEXICON = {
    "good": 1.9, "great": 3.1, "love": 3.2, "happy": 2.7, "hope": 1.9, "safe": 1.9,
    "best": 3.2, "thanks": 1.9, "beautiful": 2.9, "fun": 2.3, "win": 2.8, "free": 2.3,
    "bad": -2.5, "worst": -3.1, "hate": -2.7, "sad": -2.1, "fear": -2.2, "dead": -3.3,
    "crisis": -3.1, "angry": -2.3, "lost": -1.3, "sick": -2.3, "worthless": -1.9,
}


def lexicon_frame(spark: SparkSession, lexicon: dict[str, float] | None = None) -> DataFrame:
    """A lexicon given as a dictionary, as a frame."""
    return spark.createDataFrame(list((lexicon or SAMPLE_LEXICON).items()), LEXICON)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated lexicon: token and mean valence, then any two further columns."""
    columns = "token string, valence double, deviation string, ratings string"
    lines = spark.read.csv(path, sep="\t", schema=columns, quote="")
    return lines.select("token", "valence").dropna()


def _valences(lexicon: DataFrame) -> list[tuple[int, str, float]]:
    """(hash, word, valence) of the lexicon's words."""
    words = lexicon.dropna().groupBy("token").agg(F.max("valence").alias("valence"))
    rows = words.select(F.hash("token").alias("hash"), "token", "valence").limit(MOST_ENTRIES + 1).collect()
    if len(rows) > MOST_ENTRIES:
        raise ValueError(f"a lexicon has at most {MOST_ENTRIES} entries")
    return [tuple(r) for r in rows]


def _map(values: dict[str, float]) -> str:
    """SQL of a map from words to numbers; words as bytes, so that nothing needs escaping."""
    return "map(" + ", ".join(f"cast(X'{word.encode().hex()}' AS STRING), {value!r}D" for word, value in values.items()) + ")"


_NO_WORDS = "cast(map() AS map<string, double>)"


class Table:
    """A map from words to numbers as a literal, looked up by hash.

    Made of constants only, so that the optimizer leaves one value of it in the plan.
    """

    def __init__(self, rows: list[tuple[int, str, float]]):
        self.parts = 1 << len(rows).bit_length()
        maps: list[dict[str, float]] = [{} for _ in range(self.parts)]
        for code, word, value in rows:
            maps[code % self.parts][word] = value
        self.maps = F.expr("array(" + ", ".join(_map(m) if m else _NO_WORDS for m in maps) + ")")

    def of(self, word: Column) -> Column:
        """The word's number, or null."""
        return F.get(self.maps, F.pmod(F.hash(word), F.lit(self.parts)))[word]


def _let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _small(values: dict[str, float]) -> Column:
    return F.expr(_map(values) if values else _NO_WORDS)


def _split(text: Column) -> Column:
    """The words and emoticons of more than one character.

    One run of punctuation is stripped where it stands on one side only of a word of at
    least two characters that has no other punctuation.
    """
    word = rf"[^\p{{Punct}}{R.SPACE}]{{2,}}+"
    runs = "|".join("".join("\\" + mark for mark in run) for run in R.STRIPPED_RUNS)
    alone = rf"(^|[{R.SPACE}])(?:(?:{runs})({word})|({word})(?:{runs}))(?![^{R.SPACE}])"
    stripped = F.regexp_replace(text, alone, "$1$2$3")
    return F.filter(F.split(stripped, f"[{R.SPACE}]+"), lambda w: F.length(w) > 1)


def _in_capitals(word: Column) -> Column:
    return (F.upper(word) == word) & (F.lower(word) != word) & ~word.rlike(r"[\p{Ll}\p{Lt}]")


class Scorer:
    """The valences of the words of a text, under a lexicon and rules.

    ``words``, ``lower`` and ``mixed`` name columns: a text's words, their lower case, and
    whether some words are in capitals and others not.
    """

    def __init__(self, lexicon: list[tuple[int, str, float]], rules: Rules, words: str, lower: str, mixed: str):
        self.known = Table(lexicon)
        self.carriers = Table([row for row in lexicon if row[1] not in rules.boosters])
        self.boosters, self.idioms = _small(rules.boosters), _small(rules.idioms)
        self.negations, self.contrast = list(rules.negations), rules.contrast
        self.words, self.low, self.mixed = F.col(words), F.col(lower), F.col(mixed)

    def word(self, i: Column, step: int | Column = 0) -> Column:
        return F.get(self.words, i + step)

    def lower(self, i: Column, step: int | Column = 0) -> Column:
        return F.get(self.low, i + step)

    def hits(self) -> Column:
        """The places of the sentiment words; "kind of" is none."""

        def is_hit(i: Column) -> Column:
            kind_of = (self.lower(i) == "kind") & F.coalesce(self.lower(i, 1) == "of", F.lit(False))
            return self.carriers.of(self.lower(i)).isNotNull() & ~kind_of

        places = F.when(F.size(self.low) > 0, F.sequence(F.lit(0), F.size(self.low) - 1))
        return F.filter(places, is_hit)

    def valence(self, i: Column) -> Column:
        """The valence of the sentiment word at ``i`` in its context."""

        def louder(value: Column, place: Column) -> Column:
            return F.when(self.mixed & _in_capitals(self.word(place)), F.signum(value) * R.CAPS_BOOST).otherwise(0.0)

        def plain(k: int | Column) -> Column:
            # a predecessor counts only when it is there and is no sentiment word itself
            return self.lower(i, -k).isNotNull() & self.known.of(self.lower(i, -k)).isNull()

        def boosted(value: Column, k: Column) -> Column:
            size = self.boosters[self.lower(i, -k)]
            shout = F.when(value > 0, R.CAPS_BOOST).otherwise(-R.CAPS_BOOST)
            step = F.when(value < 0, -size).otherwise(size) + F.when(self.mixed & _in_capitals(self.word(i, -k)), shout).otherwise(0.0)
            damped = step * F.get(F.array(*map(F.lit, R.DISTANCE_DAMPING)), k - 1)
            return value + F.coalesce(damped, F.lit(0.0))

        def emphatic(step: int) -> Column:
            return F.coalesce(self.word(i, step).isin("so", "this"), F.lit(False))

        def factor(k: Column) -> Column:
            """What a negation k words back, or the emphasis of "never so", makes of a valence."""
            back = self.lower(i, -k)
            never_two = (k == 2) & (self.word(i, -2) == "never") & emphatic(-1)
            never_three = (k == 3) & (((self.word(i, -3) == "never") & emphatic(-2)) | emphatic(-1))
            return (
                F.when(never_two, 1.5).when(never_three, 1.25)
                .when(back.isin(self.negations) | F.contains(back, F.lit("n't")), R.NEGATION_FACTOR).otherwise(1.0)
            )

        def phrase(first: int, end: int) -> Column:
            parts = [self.word(i, k) for k in range(first, end)]
            return F.concat(parts[0], *(x for p in parts[1:] for x in (F.lit(" "), p)))

        def around(value: Column) -> Column:
            """An idiom's valence, those that reach ahead first, and a pair of words that softens."""
            spans = ((0, 3), (0, 2), (-1, 1), (-2, 1), (-2, 0), (-3, 0), (-3, -1))
            soft = phrase(-3, -1).isin(*R.DAMPENER_PAIRS) | phrase(-2, 0).isin(*R.DAMPENER_PAIRS)
            found = F.coalesce(*(self.idioms[F.coalesce(phrase(a, b), F.lit(""))] for a, b in spans), value)
            return found - F.when(soft, R.BOOST).otherwise(0.0)

        def step(value: Column, k: Column) -> Column:
            turned = boosted(value, k) * factor(k)
            return F.when(~plain(k), value).when(k == 3, _let(turned, around)).otherwise(turned)

        start = _let(self.carriers.of(self.lower(i)), lambda v: v + louder(v, i))
        value = F.aggregate(F.array(F.lit(1), F.lit(2), F.lit(3)), start, step)
        least = plain(1) & (self.lower(i, -1) == "least") & ~F.coalesce(self.lower(i, -2).isin("at", "very"), F.lit(False))
        return value * F.when(least, R.NEGATION_FACTOR).otherwise(1.0)

    def total(self, hits: Column) -> Column:
        """The weighted sum of the valences, equal words one after the other."""
        turn = F.array_position(self.low, self.contrast) - 1
        sorted_hits = F.array_sort(F.transform(hits, lambda i: F.struct(self.word(i).alias("word"), i.alias("at"))))
        none = F.struct(F.lit(None).cast("string").alias("word"), F.lit(0.0).alias("value"), F.lit(0.0).alias("total"))

        def add(done: Column, hit: Column) -> Column:
            weight = F.when((turn < 0) | (turn == hit["at"]), 1.0).when(hit["at"] < turn, 0.5).otherwise(1.5)
            value = F.when(done["word"].eqNullSafe(hit["word"]), done["value"]).otherwise(self.valence(hit["at"]))
            return _let(value, lambda v: F.struct(hit["word"].alias("word"), v.alias("value"), (done["total"] + v * weight).alias("total")))

        return F.aggregate(sorted_hits, none, add, lambda done: done["total"])


def _stressed(total: Column, text: Column) -> Column:
    """Total plus punctuation emphasis."""

    def marks(mark: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    exclamations, questions = F.least(marks("!"), F.lit(R.EXCLAMATION_MAX)), marks("?")
    emphasis = exclamations * R.EXCLAMATION_STEP + (
        F.when(questions <= 1, 0.0)
        .when(questions <= R.QUESTION_STEPS, questions * R.QUESTION_STEP)
        .otherwise(R.QUESTION_MAX)
    )
    return total + F.signum(total) * emphasis


def score_sentiment(
    df: DataFrame,
    lexicon: DataFrame,
    text: str = "title",
    id_column: str | None = None,
    rules: Rules = Rules(),
    labels: Labels = Labels(),
) -> DataFrame:
    """Add ``sentiment`` and ``sentiment_score``; a null text gets nulls.

    Every row is scored by itself, whether its id is null, repeated or missing;
    ``id_column`` is accepted for callers that have one.
    """
    # columns of their own, so that each is worked out once
    words, lower, mixed, total, stressed = "_words", "_lower_words", "_mixed_case", "_total", "_stressed"
    scorer = Scorer(_valences(lexicon), rules, words, lower, mixed)
    shouted = F.exists(words, _in_capitals) & ~F.forall(words, _in_capitals)
    split = df.withColumn(words, _split(F.col(text))).withColumns({lower: F.transform(words, F.lower), mixed: shouted})
    summed = split.withColumn(total, F.coalesce(scorer.total(scorer.hits()), F.lit(0.0)))
    summed = summed.withColumn(stressed, _stressed(F.col(total), F.col(text)))
    compound = F.round(F.col(stressed) / F.sqrt(F.col(stressed) * F.col(stressed) + R.NORMALIZER), 4)
    scored = summed.withColumn("sentiment_score", F.when(F.col(text).isNotNull(), compound))
    return scored.withColumn("sentiment", sentiment_label(F.col("sentiment_score"), labels)).select(
        *df.columns, "sentiment", "sentiment_score"
    )
