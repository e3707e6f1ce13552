"""Runs a query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(frame):
    """Rows as sorted tuples of text, columns in order of name."""
    frame = frame[sorted(frame.columns)]
    return sorted(tuple("NULL" if v is None or v is pd.NA or v != v else str(v) for v in row) for row in frame.itertuples(index=False))


def difference(spark, con, sf_dir, query, sql) -> str | None:
    """What differs, or None."""
    found = query(spark, sf_dir)
    whole = {c: {"bigint": "Int64", "int": "Int32"}[kind] for c, kind in found.dtypes if kind in ("bigint", "int")}
    ours = found.toPandas()
    ours = ours.astype({c: kind for c, kind in whole.items() if ours[c].hasnans})  # else null makes floats of them
    theirs = con.execute(sql).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    kinds = {c: (str(ours[c].dtype).lower(), str(theirs[c].dtype).lower()) for c in ours.columns}
    wrong = {c: k for c, k in kinds.items() if k[0][:3] != k[1][:3] or (k[0].startswith("int") and k[0] != k[1])}
    a, b = canonical(ours), canonical(theirs)
    if a != b:
        extra = [r for r in a if r not in set(b)][:3]
        missing = [r for r in b if r not in set(a)][:3]
        return f"{len(a)} rows != {len(b)} rows; only ours {extra}; only SQL {missing}; types {wrong}"
    return f"types {wrong}" if wrong and len(ours) else None
