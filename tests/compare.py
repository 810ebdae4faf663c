"""Order-free comparison of a Spark result with a DuckDB result."""

import datetime as dt
import decimal
import glob
import json
import math
import os

import duckdb


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return json.dumps([norm(v) for v in value])
    return str(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([norm(r[i]) for i in order] for r in data), key=repr)


def kind(name):
    """Coarse type class, so that both engines' type names compare."""
    name = str(name).lower()
    for prefix, label in (("decimal", "decimal"), ("timestamp", "timestamp"), ("struct", "struct")):
        if name.startswith(prefix):
            return label
    if name.startswith("array") or name.endswith("[]"):
        return "list"
    return {"string": "text", "varchar": "text", "bigint": "int64", "int": "int32", "integer": "int32"}.get(name, name)


def check(df, con, sql):
    expected = con.execute(sql)
    names = [c[0] for c in expected.description]
    types = {c[0]: kind(c[1]) for c in expected.description}
    want = rows(names, expected.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert {c: kind(t) for c, t in df.dtypes} == types
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    assert len(got) == len(want), f"{len(got)} rows, expected {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    assert not bad, f"{len(bad)} rows differ; first {bad[0]}"
    return len(got)
