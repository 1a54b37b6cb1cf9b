"""Run a registered query and its checking SQL and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

from market_lens.plans import CHECKS, QUERIES
from market_lens.plans.fixtures import TABLES


def engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _value(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, bool):
        return v
    if v is not None and hasattr(v, "as_tuple"):
        return float(v)
    return float(v) if isinstance(v, int) and abs(v) < 2**53 else v


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(spark, con, name: str, sf_dir: str) -> str | None:
    """None when the query and its SQL agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    cursor = con.execute(CHECKS[name])
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    theirs = rows_of(columns, cursor.fetchall())
    if ours == theirs:
        return None
    extra, missing = ours - theirs, theirs - ours
    return (
        f"{ours.total()} rows against {theirs.total()}; only ours {extra.total()}: {list(extra)[:3]}; "
        f"only theirs {missing.total()}: {list(missing)[:3]}"
    )
