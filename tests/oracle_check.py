"""Compare registered queries with their oracles: ``python tests/oracle_check.py [sf_dir] [name prefix ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "item") and not hasattr(v, "__len__"):
        return plain(v.item())
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if type(v).__name__ == "Row":
        return tuple(sorted((k, plain(x)) for k, x in v.asDict().items()))
    return v


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)


def oracle_rows(con, sql: str):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(plain(r[i]) for i in order) for r in cur.fetchall()]
    return [names[i] for i in order], sorted(rows, key=repr)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    names, rows = spark_rows(df)
    want_names, want = oracle_rows(con, sql)
    if names != want_names:
        return f"columns {names} / {want_names}"
    if len(rows) != len(want):
        return f"{len(rows)} rows / {len(want)}: {rows[:2]} / {want[:2]}"
    for a, b in zip(rows, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} / {b}"
    return None


def main() -> int:
    from fareflow import session
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = (session.builder(master="local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                problem = difference(df, con, oracles[name])
                result = "ok" if problem is None else "DIFF " + problem[:600]
            else:
                problem, result = None, f"no oracle, {df.count()} rows"
        except Exception as e:
            problem = result = "ERROR " + str(e)[:900]
        bad += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {result}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
