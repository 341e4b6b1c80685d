"""Compare a query with its SQL: columns, row count and every value, in any row order."""

from __future__ import annotations

import glob
import os

import duckdb
import numpy as np
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if pd.isna(value):
        return None
    if isinstance(value, (bool, np.bool_)):
        return bool(value)
    if isinstance(value, (pd.Timestamp, np.datetime64)):
        return str(pd.Timestamp(value))
    if isinstance(value, str):
        return value
    return float(value)


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    table = [tuple(_plain(v) for v in r) for r in frame.itertuples(index=False, name=None)]
    return sorted(table, key=repr)


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(set(ours.columns) ^ set(theirs.columns))}"
    a, b = rows(ours), rows(theirs)
    if len(a) != len(b):
        return f"{len(a)} rows, expected {len(b)}"
    unequal = [(x, y) for x, y in zip(a, b) if x != y]
    if not unequal:
        return None
    cells = [c for c, x, y in zip(sorted(ours.columns), *unequal[0]) if x != y]
    return f"{len(unequal)} rows differ, first in {cells}: {unequal[0]}"
