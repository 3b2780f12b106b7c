"""Run registered queries next to their SQL: ``python tests/compare.py [folder] [names...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def sql_rows(sql: str, folder: str) -> pd.DataFrame:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection.execute(sql).df()


def normalized(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        column = df[name]
        if pd.api.types.is_datetime64_any_dtype(column):
            df[name] = column.astype("datetime64[us]").astype(str)
        elif pd.api.types.is_float_dtype(column):
            df[name] = column.map(lambda x: "" if pd.isna(x) else f"{x:.6f}")
        elif pd.api.types.is_bool_dtype(column):
            df[name] = column.map(str)
        else:
            df[name] = column.map(
                lambda x: "" if x is None or x is pd.NaT or (isinstance(x, float) and pd.isna(x)) or x is pd.NA
                else (f"{x:.6f}" if isinstance(x, float) else str(x))
            )
    for name in df.columns:  # whole numbers next to nulls come as floats on one side only
        df[name] = df[name].str.replace(r"^(-?\d+)\.000000$", r"\1", regex=True)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def difference(spark_df, sql: str, folder: str) -> str | None:
    left, right = normalized(spark_df.toPandas()), normalized(sql_rows(sql, folder))
    if list(left.columns) != list(right.columns):
        return f"columns {list(left.columns)} and {list(right.columns)}"
    if len(left) != len(right):
        return f"{len(left)} rows and {len(right)}"
    wrong = (left != right).any(axis=1)
    if wrong.any():
        return f"{wrong.sum()} rows differ, first:\n{left[wrong].iloc[0]}\n{right[wrong].iloc[0]}"
    return None if len(left) else "no rows at all"


if __name__ == "__main__":
    from tests.conftest import make_session

    import __spark_entry__ as entry

    args = sys.argv[1:]
    folder = args[0] if args else "/root/testdata/sf0.01"
    spark = make_session()
    sql = entry.oracle_sql()
    for name, run in entry.queries().items():
        if args[1:] and name not in args[1:]:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            problem = difference(df, sql[name], folder) if name in sql else f"(no SQL) {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:300]}"
        print(f"{name:36s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
