"""Run the registered queries beside their SQL: ``python tests/check_oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normalized(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def compare(spark, connection, name: str, sf_dir: str) -> str:
    """Empty when the query and its SQL agree, else what differs."""
    have = normalized(entry.queries()[name](spark, sf_dir).toPandas())
    want = normalized(connection.sql(entry.oracle_sql()[name]).df())
    if list(have.columns) != list(want.columns):
        return f"columns {list(have.columns)} and {list(want.columns)}"
    if len(have) != len(want):
        return f"rows {len(have)} and {len(want)}"
    # Whole numbers with nulls have no fixed type in pandas.
    full = [c for c in have if not want[c].isna().any()]
    types = [(c, str(have[c].dtype), str(want[c].dtype)) for c in full if have[c].dtype != want[c].dtype]
    if types:
        return f"types {types}"
    unequal = pd.DataFrame({c: (have[c] != want[c]).fillna(True) & ~(have[c].isna() & want[c].isna()) for c in have})
    if unequal.any().any():
        rows = unequal.any(axis=1)
        first = rows.idxmax()
        return f"{int(rows.sum())} rows, first {have.loc[first].to_dict()} and {want.loc[first].to_dict()}"
    return ""


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            problem = compare(spark, connection, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '} {name:28s} {time.time() - start:6.2f}s {problem}", flush=True)
    print("failures:", bad)
