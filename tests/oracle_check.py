"""Compares a query with its SQL, as the driver does: rows in any order, values exact."""

import datetime
import decimal
import glob
import math
import os

import duckdb

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def connect(sf_dir: str = SF):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, datetime.datetime):
        return f"T{v.replace(tzinfo=None)}"
    if isinstance(v, (list, tuple)):
        return str([norm(x) for x in v])
    return None if v is None else str(v)


def _rows(rows):
    return sorted((tuple(norm(v) for v in r) for r in rows), key=lambda r: tuple("" if v is None else v for v in r))


def compare(df, sql: str, con) -> None:
    cols = sorted(df.columns)
    got = _rows(df.select(*[f"`{c}`" for c in cols]).collect())
    rel = con.sql(sql)
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    want = _rows([[r[i] for i in at] for r in rel.fetchall()])
    assert len(got) == len(want)
    assert not [(a, b) for a, b in zip(got, want) if a != b][:3]
