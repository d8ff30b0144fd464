"""Run registered queries against their SQL in DuckDB and report differences.

usage: python tools/compare.py SF_DIR [name ...]
"""

from __future__ import annotations

import math
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from vesselmart.catalog import ORACLES, QUERIES  # noqa: E402
from vesselmart.session import build_session  # noqa: E402


def _plain(value):
    if value is None or isinstance(value, (bool, int, str)):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if hasattr(value, "is_finite"):  # decimals
        return float(f"{float(value):.9g}")
    return str(value)


def _rows(rows, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=lambda t: tuple(map(repr, t))
    )


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session(
        "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for path in pathlib.Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            got = _rows(df.collect(), df.columns)
        except Exception as e:  # report and go on
            print(f"FAIL {name}: {str(e)[:1500]}", flush=True)
            bad += 1
            continue
        took = time.time() - start
        if name not in ORACLES:
            print(f"rows {name}: {len(got)} rows {took:.1f}s", flush=True)
            continue
        try:
            cur = con.execute(ORACLES[name])
            columns = [d[0] for d in cur.description]
            want = _rows(cur.fetchall(), columns)
        except Exception as e:
            print(f"FAIL {name} in SQL: {str(e)[:1500]}", flush=True)
            bad += 1
            continue
        if sorted(columns) != sorted(df.columns):
            print(f"DIFF {name}: columns {sorted(df.columns)} / {sorted(columns)}", flush=True)
            bad += 1
        elif got != want:
            odd = [(a, b) for a, b in zip(got, want) if a != b][:3]
            print(f"DIFF {name}: {len(got)} / {len(want)} rows {sorted(columns)} {odd}", flush=True)
            bad += 1
        else:
            print(f"ok   {name}: {len(got)} rows {took:.1f}s", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
