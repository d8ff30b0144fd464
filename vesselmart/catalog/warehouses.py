"""Warehouses the queries look at, loaded once per session and data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    quadkey_uint64_encode,
    timestamp_to_date_id,
    timestamp_to_time_id,
    ts_to_temporal_part_key,
    zxy_to_quadkey,
    get_zxy,
)
from ..plans.loaders import load_dir
from ..samples import pings, write_object_files
from ..session import scratch_dir
from ..warehouse.store import Warehouse

_OPEN: dict[tuple[str, str, str], Warehouse] = {}
_FOLDERS: dict[str, tuple[str, str]] = {}
DEPTH = 8  # digits of the spatial partition key
ZOOM = 24


def object_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The sample objects, loaded from their files in two calls."""
    key = (spark.sparkContext.applicationId, sf_dir, "objects")
    if key not in _OPEN:
        early, late = write_object_files(spark, sf_dir, scratch_dir(spark, "objects"))
        wh = Warehouse.create(spark, scratch_dir(spark, "warehouse"))
        load_dir(wh, early)
        load_dir(wh, late)
        _OPEN[key], _FOLDERS[wh.root] = wh, (early, late)
    return _OPEN[key]


def load_again(wh: Warehouse) -> None:
    """Offer the same files a second time."""
    for folder in _FOLDERS[wh.root]:
        load_dir(wh, folder)


def point_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports as rows of the point fact; what they do not tell is a constant."""
    tile = get_zxy("lon", "lat", F.lit(ZOOM))
    keyed = pings(spark, sf_dir).withColumn("q", zxy_to_quadkey(tile["z"], tile["x"], tile["y"]))
    unknown = {
        c: F.lit(1) for c in (
            "load_id", "call_sign_id", "cargo_type_id", "depth_cell_id", "destination_id",
            "half_degree_cell_id", "nav_status_id", "pos_type_id", "transponder_type_id",
            "vessel_config_id", "vessel_type_id", "vessel_name_id",
        )
    }
    columns = {
        "ais_point_id": F.col("event_id") + 1, "qkey": quadkey_uint64_encode("q"),
        "spatial_part_key": quadkey_uint64_encode(F.substring("q", 1, DEPTH)),
        "temporal_part_key": ts_to_temporal_part_key("ts"), "alpha2": F.lit("??"),
        "date_id": timestamp_to_date_id("ts"), "time_id": timestamp_to_time_id("ts"),
        "vessel_id": F.col("user_id") + 1, "ts": F.col("ts"), "lon": F.col("lon"),
        "lat": F.col("lat"), "sog": F.col("cents") / 100, **unknown,
    }
    empty = (
        "prev_ais_point_id", "rot", "cog", "heading", "draught", "depth", "eta", "ukc",
        "delta_pos", "delta_sec", "delta_sog", "delta_rot", "delta_cog", "delta_heading",
        "delta_cog_heading", "delta_draught", "delta_destination",
    )
    return keyed.select(
        *[v.alias(c) for c, v in columns.items()], *[F.lit(None).alias(c) for c in empty]
    )


def point_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The point fact, written in two batches."""
    key = (spark.sparkContext.applicationId, sf_dir, "points")
    if key not in _OPEN:
        wh = Warehouse.create(spark, scratch_dir(spark, "points"))
        rows = point_rows(spark, sf_dir)
        for remainder in (0, 1):
            batch = wh.next_batch()
            wh.append("ais_point_fact", rows.filter(F.col("ais_point_id") % 2 == remainder), batch)
            wh.publish(batch)
        _OPEN[key] = wh
    return _OPEN[key]
