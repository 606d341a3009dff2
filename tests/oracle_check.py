"""Compare Spark results with the SQL counterparts: ``python -m tests.oracle_check [sf_dir] [query ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def sorted_rows(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), ignore_index=True)


def compare(got: pd.DataFrame, sql: str, con) -> list[str]:
    """Differences in words; empty when columns, types, rows and values agree exactly."""
    want = con.sql(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(got.columns)} != {sorted(want.columns)}"]
    got, want = sorted_rows(got), sorted_rows(want)
    found = []
    for c in got.columns:
        if str(want[c].dtype).startswith("Int"):  # integers with nulls, which Spark hands over as floats
            got[c] = got[c].astype(want[c].dtype)
        if got[c].dtype.kind != want[c].dtype.kind or got[c].dtype.itemsize != want[c].dtype.itemsize:
            found.append(f"type of {c}: {got[c].dtype} != {want[c].dtype}")
    if len(got) != len(want):
        return [*found, f"rows {len(got)} != {len(want)}"]
    for c in got.columns:
        a, b = got[c].astype(object), want[c].astype(object)
        differ = ~((a == b) | (a.isna() & b.isna()))
        if differ.any():
            found.append(f"{differ.sum()} values of {c}, e.g. {a[differ].iloc[0]!r} != {b[differ].iloc[0]!r}")
    return found


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from __spark_entry__ import oracle_sql, queries
    from cinerank.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries())
    spark = build_session("oracle-check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    for name in wanted:
        start = time.time()
        got = queries()[name](spark, sf_dir).toPandas()
        seconds = time.time() - start
        if name in oracle_sql():
            found = compare(got, oracle_sql()[name], con)
            print(f"{name:32s} {seconds:6.1f}s {len(got):9d} rows  {'; '.join(found) or 'same'}", flush=True)
        else:
            print(f"{name:32s} {seconds:6.1f}s {len(got):9d} rows  no oracle", flush=True)


if __name__ == "__main__":
    main()
