"""Run queries against their SQL: ``python tests/check_oracles.py sf_dir [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
import pandas as pd

from readloom.catalog.oracles import ORACLES
from readloom.catalog.queries import QUERIES

TABLES = ["region", "lineitem"]


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted(frame.itertuples(index=False, name=None), key=repr)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def same(spark, con, sf_dir: str, name: str) -> tuple[bool | None, str]:
    """Whether a query gives the rows of its SQL, None where it has none."""
    got = QUERIES[name](spark, sf_dir)
    frame = got.toPandas()
    if name not in ORACLES:
        return None, f"{len(frame)} rows, no SQL"
    want = con.execute(ORACLES[name]).df()
    if sorted(frame.columns) != sorted(want.columns):
        return False, f"columns {sorted(frame.columns)} != {sorted(want.columns)}"
    kinds = {c: (str(frame[c].dtype), str(want[c].dtype)) for c in frame if frame[c].dtype != want[c].dtype}
    a, b = rows(frame), rows(want)
    if a != b:
        first = next(((x, y) for x, y in zip(a, b) if x != y), None)
        return False, f"{len(a)} vs {len(b)} rows, first difference {first}"
    return True, f"{len(a)} rows {kinds or ''}"


if __name__ == "__main__":
    from readloom.session import local_session

    spark, sf = local_session("8"), sys.argv[1]
    con = duck(sf)
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            good, note = same(spark, con, sf, name)
        except Exception as err:  # noqa: BLE001
            good, note = False, str(err)[:600]
        print({True: "ok  ", False: "FAIL", None: "none"}[good], f"{time.time() - start:6.2f}s", name, note, flush=True)
