"""Compare a Spark query with its SQL on DuckDB, value by value and regardless of order."""

import glob
import os

import duckdb
import pandas as pd


def connect(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def differences(got, connection, sql):
    """Reasons why the Spark result is not what the SQL gives; empty when it is."""
    want = connection.execute(sql).df()
    got = got.toPandas()
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(got.columns)} != {sorted(want.columns)}"]
    if len(got) != len(want):
        return [f"rows {len(got)} != {len(want)}"]
    reasons = []
    for name in want.columns:
        if _kind(got[name]) != _kind(want[name]):
            reasons.append(f"{name}: type {got[name].dtype} != {want[name].dtype}")
    got, want = _sorted(got), _sorted(want)
    for name in want.columns:
        unequal = (got[name] != want[name]) & ~(got[name].isna() & want[name].isna())
        if unequal.any():
            at, rows = unequal.idxmax(), unequal.sum()
            reasons.append(f"{name}: {got[name][at]!r} != {want[name][at]!r} ({rows} rows)")
    return reasons


def _kind(series):
    return "str" if series.dtype == object or series.dtype.kind == "O" else str(series.dtype)


def _sorted(frame):
    columns = sorted(frame.columns)
    frame = pd.DataFrame({name: frame[name] for name in columns})
    keys = frame.map(lambda value: "" if value is None or value is pd.NA else str(value))
    return frame.loc[keys.sort_values(columns, kind="stable").index].reset_index(drop=True)
