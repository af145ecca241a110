"""Compare a registered query with its SQL twin on one data folder."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value: object) -> object:
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, pd.Timestamp):
        return str(value)
    if hasattr(value, "item"):
        return _plain(value.item())
    return value


def _rows(frame: pd.DataFrame) -> Counter:
    frame = frame[sorted(frame.columns)]
    columns = [[_plain(v) for v in frame[c].tolist()] for c in frame.columns]
    return Counter(zip(*columns)) if columns else Counter()


def _kinds(frame: pd.DataFrame) -> dict[str, str]:
    return {c: str(frame[c].dtype)[:4] for c in sorted(frame.columns)}


def compare(spark, con, sf_dir: str, query, sql: str | None) -> tuple[str, int]:
    """('ok' or what differs, number of rows)."""
    mine = query(spark, sf_dir).toPandas()
    if sql is None:
        return "rows only", len(mine)
    theirs = con.execute(sql).df()
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} != {sorted(theirs.columns)}", len(mine)
    a, b = _rows(mine), _rows(theirs)
    if a != b:
        extra, lack = list((a - b).items())[:3], list((b - a).items())[:3]
        return f"{len(mine)} rows != {len(theirs)}: spark only {extra}; sql only {lack}", len(mine)
    if len(mine) and _kinds(mine) != _kinds(theirs):
        differ = {c: (k, _kinds(theirs)[c]) for c, k in _kinds(mine).items()
                  if k != _kinds(theirs)[c]}
        return f"ok, but types differ: {differ}", len(mine)
    return "ok", len(mine)


if __name__ == "__main__":
    import sys
    import time

    from checks import REGISTRY
    from tidemark.session import build_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    session = build_session("8")
    session.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for name, (query, sql) in REGISTRY.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        began = time.time()
        try:
            verdict, rows = compare(session, connection, folder, query, sql)
        except Exception as error:  # report and go on to the next query
            verdict, rows = f"{type(error).__name__}: {str(error)[:600]}", -1
        bad += verdict not in ("ok", "rows only")
        print(f"{name:32} {rows:7} {time.time() - began:6.2f}s {verdict[:1200]}", flush=True)
    print("differences:", bad)
