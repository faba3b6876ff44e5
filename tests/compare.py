"""Run registered queries against their SQL in DuckDB and report differences.

    python tests/compare.py <sf_dir> [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _kind(s: pd.Series) -> str:
    if pd.api.types.is_bool_dtype(s):
        return "bool"
    if pd.api.types.is_integer_dtype(s):
        return "int"
    if pd.api.types.is_float_dtype(s):
        return "float"
    return "other"


def difference(left: pd.DataFrame, right: pd.DataFrame) -> str | None:
    """None when both frames hold the same rows in any order, else a short account."""
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(set(left.columns) ^ set(right.columns))}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    cols = sorted(left.columns)
    left, right = left[cols].copy(), right[cols].copy()
    notes = []
    for c in cols:
        a, b = _kind(left[c]), _kind(right[c])
        if a != b and {a, b} != {"int", "float"}:
            notes.append(f"type of {c}: {a} / {b}")
        if "float" in (a, b) or "int" in (a, b):
            left[c], right[c] = left[c].astype("float64"), right[c].astype("float64")
    order = lambda d: d.round(6).astype(str).sort_values(cols).index
    left, right = left.loc[order(left)].reset_index(drop=True), right.loc[order(right)].reset_index(drop=True)
    for c in cols:
        x, y = left[c], right[c]
        both_null = x.isna() & y.isna()
        same = (x == y) | both_null
        if not same.all():
            i = int(np.argmax(~same.to_numpy()))
            notes.append(f"{c}: {int((~same).sum())} differ, e.g. {x[i]!r} / {y[i]!r}")
    return "; ".join(notes) or None


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from scoreloom.session import build_session

    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(queries):
        t0 = time.time()
        try:
            got = queries[name](spark, sf_dir).toPandas()
            took = time.time() - t0
            if name not in oracles:
                print(f"rows  {name}: {len(got)} rows {took:.1f}s", flush=True)
                continue
            diff = difference(got, con.execute(oracles[name]).df())
        except Exception as e:  # noqa: BLE001
            diff, took, got = f"{type(e).__name__}: {str(e)[:700]}", time.time() - t0, []
        bad += diff is not None
        print(f"{'DIFF' if diff else 'ok  '}  {name}: {len(got)} rows {took:.1f}s {diff or ''}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
