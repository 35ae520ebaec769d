"""Compare every registered query with its DuckDB SQL: ``oracle_check.py [sf_dir] [names]``."""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def normal(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of text-comparable values, columns by name."""
    frame = frame[sorted(frame.columns)]
    rows = []
    for row in frame.itertuples(index=False, name=None):
        rows.append(tuple(None if pd.isna(v) else _value(v) for v in row))
    return sorted(rows, key=repr)


def _value(value):
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return bool(value)
    if isinstance(value, float) and value.is_integer():
        return int(value)
    return value.item() if hasattr(value, "item") else value


def compare(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """None when equal, else the first difference."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} vs {sorted(sql_frame.columns)}"
    left, right = normal(spark_frame), normal(sql_frame)
    if len(left) != len(right):
        return f"rows {len(left)} vs {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"value {a} vs {b}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2].split(",") if len(sys.argv) > 2 else None
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    sql = contract.oracle_sql()
    failures = 0
    for name, query in contract.queries().items():
        if name not in sql or wanted and name not in wanted:
            continue
        start = time.time()
        ours = query(spark, sf_dir).toPandas()
        spent = time.time() - start
        theirs = connection.execute(sql[name]).df()
        difference = compare(ours, theirs)
        failures += difference is not None
        print(f"{'ok  ' if difference is None else 'DIFF'} {name} {len(ours)} rows "
              f"{spent:.2f}s {difference or ''}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main())
