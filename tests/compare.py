"""Rows of a Spark query and of its DuckDB SQL, made comparable."""

import decimal
import math
from pathlib import Path

import duckdb


def plain(v):
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v


def spark_rows(df):
    return sorted(df.columns), sorted(repr([(k, plain(v)) for k, v in sorted(r.asDict().items())]) for r in df.collect())


def duck_rows(sql, sf_dir):
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    r = con.sql(sql)
    names = r.columns
    return sorted(names), sorted(repr(sorted((k, plain(v)) for k, v in zip(names, row))) for row in r.fetchall())
