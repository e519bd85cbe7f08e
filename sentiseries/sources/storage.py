"""Writers, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_folders: dict[tuple[str, str | None], str] = {}


def shared_folder(spark: SparkSession) -> str:
    """This application's folder inside the one every executor reaches.

    That is ``spark.checkpoint.dir``; only a local session without the setting gets a
    temporary folder. The application's folder is removed when the driver's JVM ends.
    """
    context = spark.sparkContext
    setting = spark.conf.get(_SETTING, None) or context.getConf().get(_SETTING)
    known = (context.applicationId, setting)
    if known not in _folders:
        base = setting
        if base is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise ValueError(f"set {_SETTING} to a folder all executors share")
            base = tempfile.mkdtemp(prefix="sentiseries-")
        path = context._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{context.applicationId}-{uuid.uuid4().hex[:8]}")
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _folders[known] = path.toString()
    return _folders[known]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_json(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Gzip JSON lines, replacing what was there."""
    df.write.mode("overwrite").partitionBy(*partition_by).option("compression", "gzip").json(path)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Parquet, replacing what was there."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    """Write as ``parquet`` or gzip ``json``."""
    {"parquet": write_parquet, "json": write_json}[fmt](df, path, partition_by)


def write_partitions(df: DataFrame, path: str, fmt: str, partition_by: tuple[str, ...]) -> None:
    """Replace the partitions that ``df`` has rows of, and leave the others alone."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    (writer.option("compression", "gzip") if fmt == "json" else writer).format(fmt).save(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete one folder of a table, if it is there."""
    one = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    one.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(one, True)


def exists(spark: SparkSession, path: str) -> bool:
    one = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return one.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(one)


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For a small table that several tests read, so that what it was made from is
    read once, and a lost executor costs a re-read instead of a recomputation.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
