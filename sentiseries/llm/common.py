"""What several operators share: words, shingles, labelled samples, stored tables."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

SPACES = " \t\n\x0b\x0c\r"
SHINGLE = 5
_UPPER = bytes(range(65, 91))
_ASCII_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Hand texts to Python in small batches, so that long ones fit beside each other."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def words(text: str | None) -> list[bytes]:
    """Runs of bytes other than space and x09-x0D; ``bytes.split`` splits at just these."""
    return utf8(text).split()


def folded_words(text: str | None) -> list[bytes]:
    """``words`` with A-Z lower-cased and nothing else."""
    return utf8(text).translate(_ASCII_LOWER).split()


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finisher)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def seeds(count: int, seed: int) -> np.ndarray:
    """``count`` fixed odd 64-bit multipliers."""
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    """64-bit hashes of words that do not depend on the process."""
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """One 64-bit hash for each ``size``-word window, in order and with repeats.

    With fewer words the whole sequence is one shingle; without words there is none.
    """
    hashes = word_hashes(folded_words(text))
    if not len(hashes):
        return hashes
    width = min(size, len(hashes))
    # windows of another width start from another constant, so they never equal a full one
    total = np.full(len(hashes) - width + 1, width * 0x9E37, np.uint64)
    for k in range(width):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(total)])
    return total


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Texts of up to ``per_class`` labelled documents of either class, with weights.

    ``usable`` is a condition on ``key``; rows without key or label are left out, and so
    are documents with both labels. The ids with the smallest hash are taken, and a
    weight restores the classes' shares. Of several documents with one id the one whose
    text has the smallest hash is taken, so there is never more than one row an id; they
    are reduced where they are read, and other texts are not moved. Ids may be of any
    type that can be grouped and sorted. Columns: text, label (0 or 1), weight.
    """
    spark = documents.sparkSession
    votes = (
        labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).filter(usable)
        .filter("k is not null and y in (0, 1)").groupBy("k").agg(F.min("y").alias("y"), F.max("y").alias("other"))
        .filter("y = other").drop("other")
    )
    totals = {r["y"]: r["n"] for r in votes.groupBy("y").agg(F.count("*").alias("n")).collect()}
    rows = []
    for y, total in sorted(totals.items()):
        taken = votes.filter(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(per_class).collect()
        rows += [(r["k"], y, total / len(taken)) for r in taken]
    shape = T.StructType([votes.schema["k"], T.StructField("label", T.IntegerType()), T.StructField("weight", T.DoubleType())])
    found = documents.select(F.col(key).alias("k"), F.col(text).alias("text")).join(F.broadcast(spark.createDataFrame(rows, shape)), "k")
    one = F.min(F.struct(F.xxhash64("text").alias("h"), F.col("text"), F.col("label"), F.col("weight"))).alias("one")
    return found.groupBy("k").agg(one).select("one.text", "one.label", "one.weight")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
