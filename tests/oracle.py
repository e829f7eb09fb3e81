"""Compares a query with its DuckDB equivalent: same columns, same rows in any order."""

import os

import duckdb
import numpy as np
import pandas as pd


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(folder):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{folder}/{f}'")
    return con


def _cell(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and np.isnan(v)):
        return None
    if isinstance(v, (list, tuple, np.ndarray)):
        return "[" + ",".join(str(_cell(x)) for x in v) + "]"
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (float, np.floating)):
        # Whole numbers compare as such: a nullable integer column comes back as floats from one side.
        return int(v) if float(v).is_integer() and abs(v) < 2**53 else f"{v:.9g}"
    return int(v) if isinstance(v, (int, np.integer)) else str(v)


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(map(_cell, r)) for r in frame.itertuples(index=False)), key=repr)
