"""The registered queries: each applies its operator to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sentiseries.llm import (
    decontaminate, divergence, html_text, line_quality, merkle, mixing, near_duplicates, oracle, quality_rules, repeated_bytes, secret_scan,
    token_counts, toxicity, url_filter,
)
from sentiseries.llm.common import remainder, small_batches, table


def op1_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return repeated_bytes.remove(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(documents, labels, remainder(F.col("k"), 3) != 1)
    scored = documents.select("doc_id", toxicity.score("text", model).alias("score"))
    return scored.select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    texts = table(spark, sf_dir, "pages").select("page_id", "url", html_text.extract("html").alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = line_quality.train(documents, labels, remainder(F.col("k"), 5) != 0)
    scored = documents.select("doc_id", line_quality.score("text", model).alias("score"))
    return scored.select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = secret_scan.find(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    of = lambda kinds: F.filter("spans", lambda s: s["kind"].isin(list(kinds)))
    return found.select(
        "doc_id",
        *(F.size(of([kind])).cast("long").alias(f"n_{kind}") for kind in secret_scan.BASE_KINDS),
        F.sha2(secret_scan.listed(of(secret_scan.BASE_KINDS)), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    weighed = quality_rules.weigh(table(spark, sf_dir, "documents"))
    return weighed.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality_rules.base_failed().alias("base_failed"), quality_rules.kept().alias("kept"),
        F.round("quality", 9).alias("quality"),
    )


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return near_duplicates.group(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    documents = table(spark, sf_dir, "documents").select(*columns)
    more = (F.col("n_chars").cast("decimal(20, 0)") + 1).cast("string")
    forged = merkle.leaf_of(*(more if c == "n_chars" else F.col(c) for c in columns))
    made = merkle.manifest(documents, "doc_id", "lang", columns, {"forged": F.when(remainder(F.col("doc_id"), 7) == 0, forged)})
    found = merkle.proofs(made).withColumn("folded_root", merkle.fold(F.coalesce("kept.forged", "leaf"), F.col("proof")))
    return found.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", merkle.hashed(merkle.siblings(F.col("proof"))).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    counted = token_counts.count(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_repeated_bytes": op1_repeated_bytes,
    "op2_toxicity": op2_toxicity,
    "op3_url_filter": op3_url_filter,
    "op4_html_text": op4_html_text,
    "op5_line_quality": op5_line_quality,
    "op6_secret_scan": op6_secret_scan,
    "op7_decontaminate": op7_decontaminate,
    "op8_mixing": op8_mixing,
    "op9_quality_rules": op9_quality_rules,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_token_counts": op12_token_counts,
    "op13_source_divergence": op13_source_divergence,
}

_REST = "CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
_HOST = "translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract(rest, '^[^/?#]*([^?#]*)', 1)"
ORACLE: dict[str, str] = {
    "op3_url_filter": f"""
WITH rests AS (SELECT page_id, {_REST} AS rest FROM pages),
sites AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM rests),
listed AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM sites)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN regexp_matches(host, '(^|[^A-Za-z0-9])(spam[-_.]farm|cheap[-_.]pills|casino|free[-_.]bets|adult|ads[-_.]track|porn|xxx|viagra|payday[-_.]loans|link[-_.]farm)([^A-Za-z0-9]|$)')
  THEN 'block' ELSE 'allow' END AS verdict
FROM listed""",
    "op11_merkle_manifest": oracle.MERKLE,
    "op13_source_divergence": oracle.DIVERGENCE,
}
