"""Headline timings: prints one JSON line.

Every job runs over the whole tables of $BENCH_SF_DIR and writes its whole
result to Spark's no-op sink (or, for loads, to a fresh warehouse).
"""

from __future__ import annotations

import json
import os
import pathlib
import statistics
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from vesselmart import functions as V  # noqa: E402
from vesselmart.catalog import QUERIES, grids  # noqa: E402
from vesselmart.operators.ids import number_rows  # noqa: E402
from vesselmart.plans.loaders import load_dir  # noqa: E402
from vesselmart.plans.views import vessel_activity  # noqa: E402
from vesselmart.samples import table, write_object_files  # noqa: E402
from vesselmart.session import build_session, scratch_dir  # noqa: E402
from vesselmart.warehouse.store import Warehouse  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
# Queries that scan a table once; the load jobs are timed apart.
SCANS = (
    "timekeys_roundtrip", "mmsi_identity", "imo_check", "quadkey_from_zxy", "quadkey_encode_widths",
    "tile_xyz", "grid_assign", "wgs84_grid_assign", "wgs84_grid_corner", "gchain_key",
    "gchain_bounds", "date_dim_expand", "nullsafe_lookup", "line_centroid", "convex_hull",
    "simplified_lines",
)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        f"local[{CPUS}]", "bench", spark__sql__shuffle__partitions=CPUS, spark__driver__memory="12g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    consume(table(spark, SF_DIR, "lineitem"))  # first-use costs are nobody's
    times: dict[str, float] = {}

    def clock(name: str, job, runs: int = RUNS) -> None:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            job()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)

    for name in SCANS:
        clock(name, lambda: consume(QUERIES[name](spark, SF_DIR)))
    keys = grids.coordinates(spark, SF_DIR).select(
        V.coord_to_grid_id("x", "y", *grids.BOUNDS), V.wgs84_coord_to_grid_id("x", "y", 0.5, 0.5)
    )
    clock("grid_and_geographic_cells", lambda: consume(keys))
    line = table(spark, SF_DIR, "lineitem").select("l_orderkey", "l_linenumber")
    clock(
        "dense_ids",
        lambda: consume(number_rows(line, scratch_dir(spark, "bench"), "id").rows),
    )

    folders = write_object_files(spark, SF_DIR, scratch_dir(spark, "bench"))

    def load_all() -> Warehouse:
        wh = Warehouse.create(spark, scratch_dir(spark, "bench"))
        for folder in folders:
            load_dir(wh, folder)
        return wh

    load_all()  # warm
    start = time.perf_counter()
    wh = load_all()
    times["fact_load"] = round(time.perf_counter() - start, 3)
    clock("repeat_load", lambda: [load_dir(wh, f) for f in folders], 1)
    clock("vessel_activity", lambda: consume(vessel_activity(wh)))
    print(
        json.dumps(
            {
                "metric": "total seconds over headline jobs", "value": round(sum(times.values()), 3),
                "unit": "sec", "queries": times, "sf": pathlib.Path(SF_DIR).name,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
