"""Run a named query in Spark and its SQL form in DuckDB and compare them."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def kind(values: pd.Series) -> str:
    k = values.dropna().map(type).map(lambda t: t.__name__).unique()
    return "/".join(sorted({"int": "int", "float": "float", "str": "str", "bool": "bool"}.get(x, x) for x in k))


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for record in df[cols].astype(object).itertuples(index=False):
        out.append(tuple(None if v is None or v is pd.NA or v != v else v.item() if hasattr(v, "item") else v for v in record))
    return sorted(out, key=lambda t: tuple((v is None, str(type(v)), v if v is not None else 0) for v in t))


def compare(query, spark, folder: str, con=None) -> str | None:
    """None when equal, else a description of the difference."""
    got = query(spark, folder)
    types = dict(got.dtypes)
    got = got.toPandas()
    want = (con or connect(folder)).execute(query.sql)
    duck_types = {d[0]: str(d[1]) for d in want.description}
    want = want.df()
    if set(got.columns) != set(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = [(c, types[c], duck_types[c]) for c in types if names.get(types[c]) != duck_types[c] and duck_types[c] not in ("NUMBER", "STRING", "bool")]
    note = f" types {odd}" if odd else ""
    if len(got) != len(want):
        return f"row count {len(got)} != {len(want)}{note}"
    a, b = rows(got), rows(want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}{note} cols {sorted(got.columns)}"
    if odd:
        return f"equal ({len(a)} rows) but{note}"
    if len(a) == 0:
        return "no rows"
    return None
