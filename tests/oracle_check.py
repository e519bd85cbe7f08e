"""Run every registered query against its SQL: ``python tests/oracle_check.py SF_DIR [names]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "DATE": "date", "BOOLEAN": "boolean",
}


def sorted_rows(columns: list[str], rows) -> list[tuple[str, ...]]:
    """Rows as text, columns and rows in a fixed order; text tells -0.0 from 0.0."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def difference(df, connection, sql: str) -> str | None:
    """What differs between a query and its SQL in schema or rows, or None."""
    expected = connection.execute(sql)
    wanted = sorted((d[0], SPARK_TYPES.get(str(d[1]), str(d[1]))) for d in expected.description)
    if sorted(df.dtypes) != wanted:
        return f"columns {sorted(set(df.dtypes) ^ set(wanted))}"
    right = sorted_rows([d[0] for d in expected.description], expected.fetchall())
    left = sorted_rows(df.columns, df.collect())
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} of {len(left)} rows, first {wrong[0]}" if wrong else None


def main(sf_dir: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    queries, oracle = contract.queries(), contract.oracle_sql()
    failures = 0
    for name in names or queries:
        start = time.time()
        try:
            problem = difference(queries[name](spark, sf_dir), connection, oracle[name])
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", file=sys.stderr, flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
