"""Compare a Spark result with a DuckDB result: names, types and rows without order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def rows_of(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(frame, con, sql) -> str:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(result.fetchall(), names)
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} instead of {sorted(names)}"
    got = rows_of([tuple(r) for r in frame.collect()], frame.columns)
    if got == want:
        return ""
    return f"extra {list((got - want).items())[:3]} missing {list((want - got).items())[:3]}"
