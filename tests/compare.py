"""Run registered queries next to their DuckDB twins and compare the rows.

python tests/compare.py [sf] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of text, columns in name order."""
    def text(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return ""
        if isinstance(v, pd.Timestamp):
            return str(v.date()) if v == v.normalize() else str(v)
        if isinstance(v, (bool,)) or type(v).__name__ == "bool_":
            return str(bool(v))
        if isinstance(v, float):
            return repr(float(v))
        return str(v)

    columns = sorted(df.columns)
    return sorted(tuple(text(v) for v in row) for row in df[columns].astype(object).itertuples(index=False))


def kinds(df: pd.DataFrame) -> dict:
    return {c: str(df[c].dtype) for c in sorted(df.columns)}


def duck_types(con, sql) -> dict:
    rows = con.execute(f"DESCRIBE {sql}").fetchall()
    return {r[0]: r[1] for r in rows}


SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN",
}


def compare(spark, con, name, fn, sql, sf_dir) -> str:
    start = time.time()
    out = fn(spark, sf_dir)
    got = out.toPandas()
    took = time.time() - start
    if sql is None:
        return f"rows-only {name}: {len(got)} rows {took:.1f}s"
    want = con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"FAIL {name}: columns {sorted(got.columns)} != {sorted(want.columns)}"
    types = duck_types(con, sql)
    odd = {c: (t, types[c]) for c, t in out.dtypes if SAME.get(t) != types[c]}
    a, b = canonical(got), canonical(want)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
        return (
            f"FAIL {name}: {len(a)} vs {len(b)} rows, {len(set(a) - set(b))} differ; columns {sorted(got.columns)}\n"
            f"   spark {only_a}\n   duck  {only_b}"
        )
    note = f" TYPES {odd}" if odd else ""
    return f"ok {name}: {len(got)} rows {took:.1f}s{note}"


def main():
    import __spark_entry__ as entry
    from tidepanel.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    for extra in set(oracle) - set(queries):
        print("oracle without query:", extra)
    for name in names or queries:
        try:
            line = compare(spark, con, name, queries[name], oracle.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001
            line = f"ERROR {name}: {str(error)[:700]}"
        print(line, flush=True)


if __name__ == "__main__":
    main()
