"""Compare registered queries with their SQL, run by DuckDB on the same tables."""

import math
import os
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    return "NULL" if value is None else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(con, sql, df):
    """None when both sides give the same columns and rows, else a short account."""
    found = con.execute(sql)
    expected = _rows([d[0] for d in found.description], found.fetchall())
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if expected[0] != actual[0]:
        return f"columns {actual[0]} instead of {expected[0]}"
    if not actual[1]:
        return "no rows"
    if expected[1] != actual[1]:
        missing, extra = set(expected[1]) - set(actual[1]), set(actual[1]) - set(expected[1])
        return (
            f"{len(actual[1])} rows instead of {len(expected[1])}; missing {sorted(missing)[:2]}, "
            f"extra {sorted(extra)[:2]}"
        )
    return None


if __name__ == "__main__":
    import sys
    from pathlib import Path

    from pyspark.sql import SparkSession

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as contract

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(folder), contract.oracle_sql()
    chosen = sys.argv[1:] or list(contract.queries())
    for name in chosen:
        start = time.time()
        try:
            df = contract.queries()[name](spark, folder)
            result = difference(con, sql[name], df) if name in sql else f"no oracle; {df.count()} rows"
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:28} {time.time() - start:6.2f}s  {'ok' if result is None else result}", flush=True)
