"""Comparison of a query's rows with those of DuckDB SQL over the same files."""

import glob
import os

import duckdb


def rows(frame):
    """Rows as sorted text, columns in order of name."""
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if frame[name].dtype.kind == "f":
            frame[name] = frame[name].round(6)
    frame = frame.astype(object).where(frame.notna(), None)
    return list(frame.columns), sorted(map(str, frame.itertuples(index=False, name=None)))


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def same(frame, con, sql):
    want = con.sql(sql).df()
    assert len(frame) == len(want)
    for name in want.columns:
        if want[name].dtype != frame[name].dtype and want[name].dtype.kind in "if":
            frame[name] = frame[name].astype(want[name].dtype)
    assert rows(frame) == rows(want)
