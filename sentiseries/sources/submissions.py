"""Reading, cleaning and subsetting submissions."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sentiseries.functions.scalars import month_date
from sentiseries.schemas import CLEANED, SUBMISSIONS, SUBMISSIONS_WIDE


# The raw text of a record that could not be read, here and in the files ``extract`` writes.
UNREAD = "unread"
_CORRUPT = "_corrupt_record"


def _roots(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """What to read plainly under ``path``, and the folders that hold ``column=value`` folders.

    A folder with files only is read as a folder; files beside folders are named one by
    one, as a reader of their folder would look into the others.
    """
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(top) or not files.getFileStatus(top).isDirectory():
        return [path], []
    plain, partitioned, folders = [], [], [top]
    while folders:
        folder = folders.pop()
        inside = [s for s in files.listStatus(folder) if s.getPath().getName()[0] not in "_."]
        below = [s.getPath() for s in inside if s.isDirectory()]
        if any("=" in p.getName() for p in below):
            partitioned.append(folder.toString())
        elif below:
            plain += [s.getPath().toString() for s in inside if s.isFile()]
        elif inside:
            plain.append(folder.toString())
        folders += [p for p in below if "=" not in p.getName()]
    return (sorted(plain), sorted(partitioned)) if plain or partitioned else ([path], [])


def _qualified(spark: SparkSession, path: str) -> str:
    one = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return one.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(one).toString()


def read_json(
    spark: SparkSession, path: str | Sequence[str], schema: StructType, unread: bool = False,
    files: Collection[str] | None = None, source: str | None = None,
) -> DataFrame:
    """JSON lines (plain or gzip) under one or more paths, at any depth.

    Columns may also come from ``column=value`` folders; filters on them skip folders.
    With ``unread``, a column ``UNREAD`` holds the raw text of records that are no JSON or have
    a value of another type in a column that is read, and null for the others; without it they are
    rows of nulls. ``files`` reads only those of the files; ``source`` names a column for
    the file a row is from.
    """
    plain: list[str] = []
    partitioned: list[str] = []
    for one in [path] if isinstance(path, str) else path:
        found = _roots(spark, one)
        plain += found[0]
        partitioned += found[1]
    reads: list[tuple[str | None, str | list[str]]] = [(None, plain)] if plain else []
    reads += [(None, root) for root in partitioned]
    if files is not None:
        rest, reads = set(files), []
        for root in sorted((_qualified(spark, r) for r in partitioned), key=len, reverse=True):
            inside = {f for f in rest if f.startswith(root.rstrip("/") + "/")}
            reads += [(root, sorted(inside))] if inside else []
            rest -= inside
        reads += [(None, sorted(rest))] if rest else []
    names = [*schema.fieldNames(), *([UNREAD] if unread and UNREAD not in schema.fieldNames() else [])]
    read = schema
    if unread:
        read = StructType([*schema.fields, StructField(_CORRUPT, StringType())])
    frames = []
    for base, where in reads:
        reader = spark.read.schema(read).option("columnNameOfCorruptRecord", _CORRUPT)
        rows = (reader.option("basePath", base) if base else reader).json(where)
        picked = [F.col(n) for n in names]
        if unread:
            told = [F.col(UNREAD)] if UNREAD in schema.fieldNames() else []
            picked[names.index(UNREAD)] = F.coalesce(F.col(_CORRUPT), *told).alias(UNREAD)
        frames.append(rows.select(*picked, *([F.col("_metadata.file_path").alias(source)] if source else [])))
    if not frames:
        none = StructType([*(StructField(n, schema[n].dataType if n in schema.fieldNames() else StringType()) for n in names), *([StructField(source, StringType())] if source else [])])
        return spark.createDataFrame([], none)
    return reduce(DataFrame.union, frames)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, path, size, modified) of the files under ``path``; ``file`` is what ``read_json`` calls a row's source."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.select(
        F.col("_metadata.file_path").alias("file"), "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )


def read_table(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """A table one of the jobs wrote, with its known schema."""
    return spark.read.schema(schema).format(fmt).load(path)


def scan_submissions(spark: SparkSession, path: str | Sequence[str], unread: bool = False) -> DataFrame:
    return read_json(spark, path, SUBMISSIONS_WIDE, unread)


def scan_multi_dir(
    spark: SparkSession, path: str | Sequence[str], unread: bool = False, files: Collection[str] | None = None, source: str | None = None
) -> DataFrame:
    """Every directory of submissions under ``path`` as one scan; no path, no rows.

    With ``unread``, also the records that ``extract`` passed on unread.
    """
    schema = StructType([*SUBMISSIONS.fields, StructField(UNREAD, StringType())]) if unread else SUBMISSIONS
    if not isinstance(path, str) and not path:
        return spark.createDataFrame([], schema)
    return read_json(spark, path, schema, unread, files, source)


def union_by_name(frames: Sequence[DataFrame], missing: bool = False) -> DataFrame:
    """Append frames by column name; ``missing`` fills absent columns with null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=missing), frames)


def extract_subset(df: DataFrame, communities: Sequence[str], years: Sequence[int]) -> DataFrame:
    """Posts of the given communities and years."""
    return df.filter(F.col("subreddit").isin(list(communities)) & F.col("year").isin(list(years)))


def extract_with_unread(df: DataFrame, communities: Sequence[str], years: Sequence[int]) -> DataFrame:
    """``extract_subset``, and every record that could not be read.

    A record that could not be read may have lost its community or year. Where the year
    comes from a folder's name, the folders of other years are still skipped.
    """
    lost = F.col(UNREAD).isNotNull()
    year = F.col("year").isin(list(years)) | F.col("year").isNull()
    known = F.col("subreddit").isin(list(communities)) & F.col("year").isNotNull()
    return df.filter(year & (lost | known))


def clean(df: DataFrame) -> DataFrame:
    """The five columns the series are built from."""
    return df.select(*CLEANED.fieldNames())


def sorted_for_write(df: DataFrame, by: Sequence[str] = ("subreddit", "year", "month")) -> DataFrame:
    """Rows in global ``by`` order over the output files.

    The range boundaries also use a hash of the row, so one key that fills much of
    the table is spread over several files instead of one task.
    """
    spread = F.xxhash64(*df.columns)
    ranged = df.withColumn("_spread", spread).repartitionByRange(*by, "_spread")
    return ranged.sortWithinPartitions(*by).drop("_spread")


def spread_for_write(df: DataFrame, by: Sequence[str] = ("year", "month"), order: Sequence[str] = ()) -> DataFrame:
    """Rows of each ``by`` value together, in files of the size the session asks for, in ``order``.

    A rebalance joins small partitions and splits large ones at run time, by
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``. Unlike a range sort it needs no
    sampling pass, which would run what comes before it twice.
    """
    return df.hint("rebalance", *(F.col(c) for c in by)).sortWithinPartitions(*by, *order)


def dealt_out(df: DataFrame) -> DataFrame:
    """``df`` over as many tasks as the session has cores, if its input has fewer splits than that.

    Such an input is small, at most a split for each core, so moving it is cheap; a larger one is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def has_keys() -> Column:
    """A community and a real month are given; only such rows can join on their keys."""
    return F.col("subreddit").isNotNull() & month_date().isNotNull()


def quarantine_reason() -> Column:
    """Why a row of ``clean_marked`` is set apart; null for a usable row."""
    return (
        F.when(F.col(UNREAD).isNotNull(), "not readable").when(F.col("subreddit").isNull(), "no community")
        .when(month_date().isNull(), "no month")
    )


def clean_marked(df: DataFrame) -> DataFrame:
    """The cleaned columns, why a row is set apart, the raw text of one that could not be read, and ``has_keys``.

    Further columns that ``df`` may have beside those of submissions are dropped, but for ``input_file``.
    A reader only checks the columns that are read. So that a record with a word for a
    number is found whatever is selected afterwards, its mark depends on all numbers.
    """
    source = ["input_file"] if "input_file" in df.columns else []
    numbers = [f.name for f in CLEANED.fields if f.dataType != StringType()]
    always = F.xxhash64(*numbers) % 2 < 2
    marked = df.withColumn(UNREAD, F.when(always, F.col(UNREAD))).select(*CLEANED.fieldNames(), quarantine_reason().alias("reason"), UNREAD, *source)
    return marked.withColumn("has_keys", F.col("reason").isNull())


def quarantine_counts(marked: DataFrame) -> DataFrame:
    """Rows kept, and rows set apart for each reason."""
    return marked.groupBy("has_keys", "reason").agg(F.count(F.lit(1)).alias("posts"))


def valid_keys(df: DataFrame) -> DataFrame:
    return df.filter(has_keys())


def quarantine(df: DataFrame) -> DataFrame:
    """The rows without usable keys."""
    return df.filter(~has_keys())
