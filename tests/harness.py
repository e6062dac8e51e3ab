"""Run a query and its SQL twin and compare names, row counts and values."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path) or glob.glob(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def canon(v):
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return "nan" if v != v else ("0.0" if v == 0 else repr(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    cur = con.execute(sql)
    onames = [d[0] for d in cur.description]
    otypes = [str(d[1]) for d in cur.description]
    orows = cur.fetchall()
    srows = [tuple(r) for r in spark_df.collect()]
    if sorted(spark_df.columns) != sorted(onames):
        return f"columns {sorted(spark_df.columns)} vs {sorted(onames)}"
    if any("HUGEINT" in t or "DECIMAL" in t for t in otypes):
        return f"types {otypes}"
    if len(srows) != len(orows):
        return f"rows {len(srows)} vs {len(orows)}"
    a, b = rows_of(spark_df.columns, srows), rows_of(onames, orows)
    kinds = check_types(spark_df, dict(zip(onames, otypes)))
    if kinds:
        return kinds
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        x, y = diff[0]
        cells = [(n, p[:200], q[:200]) for n, p, q in zip(sorted(onames), x, y) if p != q]
        return f"{len(diff)} of {len(a)} rows differ, e.g. {cells} in {[c[:60] for c in x]}"
    return None


SAME = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "string": {"VARCHAR"}, "double": {"DOUBLE"}, "float": {"FLOAT"},
    "boolean": {"BOOLEAN"}, "date": {"DATE"}, "timestamp_ntz": {"TIMESTAMP"}, "timestamp": {"TIMESTAMP"},
}


def check_types(spark_df, otypes) -> str | None:
    bad = [(n, t, otypes[n]) for n, t in spark_df.dtypes if t in SAME and otypes[n] not in SAME[t]]
    return f"types {bad}" if bad else None
