"""Cross-tabulation and the chi-squared test of independence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from sentiseries.functions.pvalues import chi2_p
from sentiseries.stats.results import DEFAULT_ALPHA, results


def crosstab(df: DataFrame, row: str, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """Observed cells in long form; rows with a null on either side are left out."""
    both = F.col(row).isNotNull() & F.col(column).isNotNull()
    return df.filter(both).groupBy(*keys, row, column).agg(F.count(F.lit(1)).alias("observed"))


def crosstab_wide(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Wide form with one count column per given value, zero where unseen."""
    counts = df.filter(F.col(row).isNotNull()).groupBy(row).pivot(column, list(values)).count()
    return counts.fillna(0, subset=[str(v) for v in values])


def chi2_independence(
    df: DataFrame,
    row: str,
    column: str,
    keys: Sequence[str] = ("variable",),
    alpha: float = DEFAULT_ALPHA,
) -> DataFrame:
    """Pearson's chi-squared over the categories present; ``n1`` rows, no ``n2``.

    Observed cells add (o - e)^2 / e. An empty cell adds its e, and all cells' e sum to
    N, so the empty ones add what the observed cells' e leave of N and need no rows. A
    two-by-two table gets the continuity correction: its four deviations are equal
    in size, so that size follows from the uncorrected sum and the expectations.
    """
    of_key = list(keys)
    of_row, of_column = Window.partitionBy(*keys, row), Window.partitionBy(*keys, column)
    cells = crosstab(df, row, column, keys)
    cells = cells.join(crosstab(df, row, column, keys).groupBy(*of_key).agg(F.sum("observed").alias("n")), of_key)
    # the margins of a cell, and the share of each margin that the cell stands for
    cells = cells.withColumns({"row_total": F.sum("observed").over(of_row), "row_part": 1 / F.count(F.lit(1)).over(of_row)})
    cells = cells.withColumns({"column_total": F.sum("observed").over(of_column), "column_part": 1 / F.count(F.lit(1)).over(of_column)})
    cells = cells.withColumn("e", F.col("row_total") / F.col("n") * F.col("column_total"))
    o = F.col("observed").cast("double")
    table = cells.groupBy(*of_key).agg(
        F.max("n").alias("n"),
        F.count(F.lit(1)).alias("n_cells"),
        F.sum((o - F.col("e")) * (o - F.col("e")) / F.col("e")).alias("observed_part"),
        F.sum("e").alias("expected"),
        F.round(F.sum("row_part")).cast("long").alias("n_rows"),
        F.round(F.sum("column_part")).cast("long").alias("n_columns"),
        F.sum(F.col("row_part") / F.col("row_total")).alias("row_inverse"),
        F.sum(F.col("column_part") / F.col("column_total")).alias("column_inverse"),
    )
    n = F.col("n").cast("double")
    full = F.col("n_cells") == F.col("n_rows") * F.col("n_columns")
    empty_part = F.when(full, 0.0).otherwise(F.greatest(n - F.col("expected"), F.lit(0.0)))
    plain = F.col("observed_part") + empty_part
    dof = ((F.col("n_rows") - 1) * (F.col("n_columns") - 1)).cast("double")
    inverse_expected = n * F.col("row_inverse") * F.col("column_inverse")
    deviation = F.sqrt(plain / inverse_expected)
    kept = F.greatest(deviation - 0.5, F.lit(0.0))
    table = table.withColumns({
        "dof": dof,
        "chi2": F.when(dof == 1, kept * kept * inverse_expected).otherwise(plain),
    })
    p = F.when(F.col("dof") == 0, F.lit(1.0)).otherwise(chi2_p(F.col("chi2"), F.col("dof")))
    test = "chi2_independence"
    return results(table, test, keys, F.col("chi2"), F.col("n"), df1=F.col("dof"), p_value=p, alpha=alpha)
