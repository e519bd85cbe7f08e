"""SQL of the sentiment rules: one row per token, neighbours by lag and lead."""

from __future__ import annotations

from catalog import fixed_values as R
from catalog.inputs import LEXICON, RULES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _values(table: dict[str, float]) -> str:
    return ", ".join(f"({_text(name)}, {value}::DOUBLE)" for name, value in table.items())


def _either(values) -> str:
    return ", ".join(_text(v) for v in values)


SPACE = r"\s\x1c-\x1f\x{85}\p{Z}"
WORD = rf"[^[:punct:]{SPACE}]{{2,}}"
RUNS = "|".join("".join("\\" + mark for mark in run) for run in R.STRIPPED_RUNS)
STRIP = rf"^(?:(?:{RUNS})({WORD})|({WORD})(?:{RUNS}))$"


def _phrase(*words: str) -> str:
    return " || ' ' || ".join(words)


def _idiom(*words: str) -> str:
    return f"(SELECT max(value) FROM idioms WHERE idiom = {_phrase(*words)})"


def _step(k: int) -> list[str]:
    """CTEs for the word k back: boost first, then negation."""
    before = "start" if k == 1 else f"after{k - 1}"
    damping = R.DISTANCE_DAMPING[k - 1]
    boosted = f"""boosted{k} AS (
  SELECT t.*, CASE WHEN plain{k} AND b.value IS NOT NULL THEN v + {damping} * (
      (CASE WHEN v < 0 THEN -b.value ELSE b.value END)
      + CASE WHEN mixed AND up{k} THEN CASE WHEN v > 0 THEN {R.CAPS_BOOST} ELSE -{R.CAPS_BOOST} END ELSE 0 END)
    ELSE v END AS v{k}
  FROM {before} t LEFT JOIN boosters b ON b.word = lower(w{k}))"""
    flip = f"WHEN deny{k} THEN v{k} * {R.NEGATION_FACTOR} ELSE v{k} END"
    never = {
        1: "CASE",
        2: f"CASE WHEN w2 = 'never' AND coalesce(w1 IN ('so', 'this'), false) THEN v{k} * 1.5",
        3: f"""CASE WHEN (coalesce(w3 = 'never', false) AND coalesce(w2 IN ('so', 'this'), false))
                 OR coalesce(w1 IN ('so', 'this'), false) THEN v{k} * 1.25""",
    }[k]
    value = f"({never} {flip})"
    if k == 3:
        value = f"""(coalesce({_idiom('tok', 'a1', 'a2')}, {_idiom('tok', 'a1')}, {_idiom('w1', 'tok')},
      {_idiom('w2', 'w1', 'tok')}, {_idiom('w2', 'w1')}, {_idiom('w3', 'w2', 'w1')}, {_idiom('w3', 'w2')}, {value})
      - CASE WHEN coalesce({_phrase('w3', 'w2')} IN ({_either(R.DAMPENER_PAIRS)}), false)
               OR coalesce({_phrase('w2', 'w1')} IN ({_either(R.DAMPENER_PAIRS)}), false)
             THEN {R.BOOST} ELSE 0 END)"""
    negated = f"""after{k} AS (
  SELECT * EXCLUDE (v, v{k}), CASE WHEN plain{k} THEN {value} ELSE v{k} END AS v FROM boosted{k})"""
    return [boosted, negated]


def _is_upper(word: str) -> str:
    return f"""coalesce(upper({word}) = {word} AND lower({word}) <> {word}
      AND NOT regexp_matches({word}, '[\\p{{Ll}}\\p{{Lt}}]'), false)"""


def _back(k: int) -> str:
    return f"""(w{k} IS NOT NULL AND lower(w{k}) NOT IN (SELECT word FROM lexicon)) AS plain{k},
    coalesce(lower(w{k}) IN ({_either(RULES.negations)}) OR contains(lower(w{k}), 'n''t'), false) AS deny{k},
    {_is_upper(f'w{k}')} AS up{k}"""


SCORED = ",\n".join([
    f"lexicon(word, value) AS (VALUES {_values(LEXICON)})",
    f"boosters(word, value) AS (VALUES {_values(RULES.boosters)})",
    f"idioms(idiom, value) AS (VALUES {_values(RULES.idioms)})",
    f"""raw AS (SELECT doc_id, unnest(parts) AS tok, generate_subscripts(parts, 1) AS place FROM (
    SELECT doc_id, regexp_split_to_array(text, '[{SPACE}]+') AS parts FROM documents))""",
    f"""tokens AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY place) - 1 AS pos,
    regexp_replace(tok, {_text(STRIP)}, '\\1\\2') AS tok FROM raw WHERE length(tok) > 1)""",
    f"""around AS (SELECT *, lag(tok, 1) OVER w AS w1, lag(tok, 2) OVER w AS w2, lag(tok, 3) OVER w AS w3,
    lead(tok, 1) OVER w AS a1, lead(tok, 2) OVER w AS a2,
    bool_or({_is_upper('tok')}) OVER d AND bool_or(NOT {_is_upper('tok')}) OVER d AS mixed,
    min(CASE WHEN lower(tok) = {_text(RULES.contrast)} THEN pos END) OVER d AS turn,
    min(pos) OVER (PARTITION BY doc_id, tok) AS first_pos
  FROM tokens WINDOW w AS (PARTITION BY doc_id ORDER BY pos), d AS (PARTITION BY doc_id))""",
    f"""hits AS (SELECT t.*, l.value AS base, CASE WHEN turn IS NULL OR pos = turn THEN 1.0
      WHEN pos < turn THEN 0.5 ELSE 1.5 END AS weight
  FROM around t JOIN lexicon l ON l.word = lower(tok)
  WHERE lower(tok) NOT IN (SELECT word FROM boosters)
    AND NOT (lower(tok) = 'kind' AND coalesce(lower(a1) = 'of', false)))""",
    f"""start AS (SELECT *, CASE WHEN mixed AND {_is_upper('tok')}
      THEN CASE WHEN base > 0 THEN base + {R.CAPS_BOOST} ELSE base - {R.CAPS_BOOST} END ELSE base END AS v,
    {_back(1)}, {_back(2)}, {_back(3)} FROM hits WHERE pos = first_pos)""",
    *_step(1), *_step(2), *_step(3),
    f"""firsts AS (SELECT doc_id, tok, CASE WHEN plain1 AND lower(w1) = 'least'
      AND NOT coalesce(lower(w2) IN ('at', 'very'), false) THEN v * {R.NEGATION_FACTOR} ELSE v END AS v
  FROM after3)""",
    """totals AS (SELECT doc_id, sum(v * weight) AS total FROM hits JOIN firsts USING (doc_id, tok) GROUP BY doc_id)""",
    f"""stressed AS (SELECT doc_id, source, text, coalesce(total, 0) + sign(coalesce(total, 0)) * (
      least(length(text) - length(replace(text, '!', '')), {R.EXCLAMATION_MAX}) * {R.EXCLAMATION_STEP}
      + CASE WHEN length(text) - length(replace(text, '?', '')) <= 1 THEN 0
             WHEN length(text) - length(replace(text, '?', '')) <= {R.QUESTION_STEPS}
             THEN (length(text) - length(replace(text, '?', ''))) * {R.QUESTION_STEP}
             ELSE {R.QUESTION_MAX} END) AS s
  FROM documents LEFT JOIN totals USING (doc_id))""",
    f"""compound AS (SELECT doc_id, source, CASE WHEN text IS NOT NULL
      THEN round(s / sqrt(s * s + {R.NORMALIZER}), 4) + 0.0 END AS sentiment_score FROM stressed)""",
    """scored AS (SELECT *, CASE WHEN sentiment_score >= 0.05 THEN 'Positive'
      WHEN sentiment_score <= -0.05 THEN 'Negative' WHEN sentiment_score IS NOT NULL THEN 'Neutral' END AS sentiment
  FROM compound)""",
])

PER_DOCUMENT = f"WITH {SCORED}\nSELECT doc_id, sentiment_score, sentiment FROM scored"
PER_LABEL = f"""WITH {SCORED}
SELECT source, sentiment, count(*) AS posts, round(avg(sentiment_score), 10) + 0.0 AS avg_sentiment_score
FROM scored GROUP BY source, sentiment"""
