"""Compare registered queries with their SQL on one data folder: ``python tests/parity.py [folder] [prefixes]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        kind, values = frame[name].dtype.kind, frame[name]
        if values.isna().any() and kind in "fiu" and (values.dropna() % 1 == 0).all():
            frame[name] = values.astype("Int64")  # pandas holds integers with nulls as either kind
        elif kind == "f":
            frame[name] = values.round(9) + 0.0
    return frame.sort_values(list(frame.columns), ignore_index=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} and {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} and {len(want)}"
    a, b = canonical(got), canonical(want)
    for name in a.columns:
        if a[name].dtype != b[name].dtype:
            return f"type of {name}: {a[name].dtype} and {b[name].dtype}"
        unequal = ~((a[name] == b[name]) | (a[name].isna() & b[name].isna()))
        if unequal.any():
            at = unequal.idxmax()
            return f"{unequal.sum()} values of {name}, first {a.loc[at].to_dict()} and {b.loc[at].to_dict()}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as registered
    from gleaner.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2].split(",")) if len(sys.argv) > 2 else ("",)
    spark, con = local_session("parity", 8), connect(folder)
    sqls = registered.oracle_sql()
    for name, run in registered.queries().items():
        if not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            got = run(spark, folder).toPandas()
            middle = time.time()
            sql = sqls.get(name)
            if sql is None:
                print(f"rows {name} {len(got)} {middle - start:.1f}s", flush=True)
                continue
            want = con.execute(sql).df()
            wrong = difference(got, want)
            print(f"{'DIFF' if wrong else 'ok'} {name} {len(got)} spark {middle - start:.1f}s duckdb {time.time() - middle:.1f}s {wrong or ''}", flush=True)
        except Exception as error:
            print(f"FAIL {name} {str(error)[:600]}", flush=True)
