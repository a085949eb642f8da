"""Comparing queries with their SQL form on DuckDB.

    python tests/compare.py [--folder DIR] [name ...]
"""

from __future__ import annotations

import argparse
import pathlib
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if str(frame[name].dtype).startswith("datetime"):
            frame[name] = frame[name].astype("datetime64[us]")
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def differences(mine: pd.DataFrame, other: pd.DataFrame) -> str | None:
    """What differs between two results, rows in any order; None when nothing does."""
    if sorted(mine.columns) != sorted(other.columns):
        return f"columns {sorted(mine.columns)} and {sorted(other.columns)}"
    if len(mine) != len(other):
        return f"rows {len(mine)} and {len(other)}"
    mine, other = normal(mine), normal(other)
    for name in mine.columns:
        if mine[name].dtype.kind != other[name].dtype.kind:
            return f"type of {name}: {mine[name].dtype} and {other[name].dtype}"
        same = (mine[name] == other[name]) | (mine[name].isna() & other[name].isna())
        if not same.all():
            at = (~same).idxmax()
            return f"{name}: {mine.loc[at].to_dict()} and {other.loc[at].to_dict()}"
    return None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--folder", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    import __spark_entry__ as contract
    from tillstream.session import local_session

    spark, bad = local_session(8), 0
    oracles = contract.oracle_sql()
    for name, query in contract.queries().items():
        if options.names and name not in options.names:
            continue
        began = time.time()
        try:
            mine = query(spark, options.folder).toPandas()
            spent = time.time() - began
            other = database(options.folder).execute(oracles[name]).df() if name in oracles else mine
            wrong = differences(mine, other)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            mine, spent, wrong = [], time.time() - began, f"{type(error).__name__}: {str(error)[:600]}"
        bad += wrong is not None
        print(f"{'ok ' if wrong is None else 'BAD'} {name:38s} {len(mine):8d} rows {spent:6.2f} s {wrong or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
