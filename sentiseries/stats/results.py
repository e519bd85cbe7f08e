"""The one shape all test results share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sentiseries.functions.scalars import keeps_null

DEFAULT_ALPHA = 0.05


def _typed(value, kind: str) -> Column:
    return (F.lit(None) if value is None else value).cast(kind)


def results(
    df: DataFrame,
    test: str,
    keys: Sequence[str],
    statistic: Column,
    n1: Column,
    n2: Column | None = None,
    df1: Column | None = None,
    df2: Column | None = None,
    p_value: Column | None = None,
    alpha: float = DEFAULT_ALPHA,
) -> DataFrame:
    """``(test, keys..., n1, n2, statistic, df1, df2, p_value, keep_null)`` rows."""
    rows = df.select(
        F.lit(test).alias("test"),
        *keys,
        _typed(n1, "long").alias("n1"),
        _typed(n2, "long").alias("n2"),
        _typed(statistic, "double").alias("statistic"),
        _typed(df1, "double").alias("df1"),
        _typed(df2, "double").alias("df2"),
        _typed(p_value, "double").alias("p_value"),
    )
    return rows.withColumn("keep_null", keeps_null(F.col("p_value"), alpha))


def observed(df: DataFrame, value: str = "value") -> DataFrame:
    """Rows that carry a number; nulls and NaN never enter a test."""
    return df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
