"""Vessel-like inputs derived from the general test tables.

``events`` becomes position reports (one vessel per user) and, per vessel and
week, a trajectory object with every column a trajectory file must have.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions._columns import idiv
from .functions.identity import (
    is_valid_imo,
    is_valid_mmsi,
    mmsi_to_mid,
    mmsi_to_radio_service_type,
)
from .functions.timekeys import timestamp_to_date_id, timestamp_to_time_id
from .sources.trajectories import REQUIRED

# An object is also cut every so many event ids, so none grows with a busy vessel.
CUT = 1 << 20
STATES = (
    "unknown", "initial", "temporal gap", "spatial gap", "speeding", "corrupt", "stopping",
    "starting",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position reports: event_id, user_id, ts, cents, week, period, lon, lat."""
    week = F.floor((F.day("ts") - 1) / 7.0)
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        week.alias("week"), (idiv(F.col("event_id"), CUT) * 5 + week).alias("period"),
        *[c.alias(n) for n, c in zip(("lon", "lat"), _place(F.col("user_id"), F.col("event_id")))],
    )


def _place(user: Column, event: Column) -> tuple[Column, Column]:
    """Longitude and latitude of a report."""
    return (
        8.0 + (user % 40) / 10.0 + (event * 7919 % 1000) / 10000.0,
        54.0 + (user % 30) / 10.0 + (event * 104729 % 1000) / 10000.0,
    )


def _label(text: str, number: Column) -> Column:
    return F.concat(F.lit(text), number.cast("string"))


def _tenths(number: Column) -> Column:
    """Exact one-place decimal from a whole number of tenths."""
    return (number.cast("decimal(11,0)") * F.lit(Decimal("0.1"))).cast("decimal(10,1)")


def _grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    def point(event: Column) -> Column:
        lon, lat = _place(F.col("user_id"), event)
        return F.struct(lon.alias("x"), lat.alias("y"))

    # a report's id tells its place, so only ids are grouped; those without one come first
    unnumbered = F.array_repeat(point(F.lit(None).cast("bigint")), F.col("unnumbered").cast("int"))
    line = F.concat(unnumbered, F.transform(F.sort_array("ids"), point))
    return (
        pings(spark, sf_dir).groupBy("user_id", "week", "period")
        .agg(
            F.count(F.lit(1)).alias("n"), F.min("ts").alias("t0"), F.max("ts").alias("t1"),
            idiv(F.min("cents"), 10).alias("low"), idiv(F.max("cents"), 10).alias("high"),
            idiv(idiv(F.sum("cents"), F.count(F.lit(1))), 10).alias("mean"),
            idiv(F.min_by("cents", "event_id"), 10).alias("first"),
            idiv(F.max_by("cents", "event_id"), 10).alias("last"),
            F.collect_list("event_id").alias("ids"),
            F.count_if(F.col("event_id").isNull()).alias("unnumbered"),
        )
        .filter("n >= 2")
        .withColumn("geom", line)
        .drop("ids", "unnumbered")
    )


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per vessel and week (with two reports or more), plus its ``week``."""
    g = _grouped(spark, sf_dir)
    user, period = F.col("user_id"), F.col("period")
    kind, country = (user + period) % 4, user % 25
    ships = g.withColumns(
        {
            "mmsi": user + 219000000,
            "imo": F.when(user % 5 != 0, user * 7 + 9000000),
            "first_week": period == 0,
        }
    )
    parts = {
        "start": F.col("first"), "end": F.col("last"), "min": F.col("low"), "max": F.col("high"),
        "avg": F.col("mean"), "median": idiv(F.col("low") + F.col("high"), 2),
    }
    config = {
        "length": F.when(user % 3 != 0, user % 50 * 2 + 10),
        "width": F.when(user % 3 != 0, user % 50 + 5),
        "height": F.when(user % 6 != 0, user % 7 + 3), "max_draught": user % 9,
        "dwt": user % 11 * 1000, "grt": user % 11 * 500, "to_bow": user % 4,
        "to_stern": user % 4 + 1, "to_port": user % 2, "to_starboard": F.lit(None),
        "main_engine_kwh": user % 13 * 100, "aux_engine_kwh": F.lit(None),
    }
    columns: dict[str, Column] = {
        "traj_id": period * 10000000 + user,
        "type": F.when(kind == 3, "outlier").when(kind == 2, "stationary").otherwise("in motion"),
        "mmsi": F.col("mmsi"), "imo": F.col("imo"), "mid": mmsi_to_mid("mmsi"),
        "radio_service_type": mmsi_to_radio_service_type("mmsi"),
        "is_valid_mmsi": is_valid_mmsi("mmsi"), "is_valid_imo": is_valid_imo("imo"),
        "in_eu_mrv_db": user % 2 == 0,
        "start_date_id": timestamp_to_date_id("t0"), "end_date_id": timestamp_to_date_id("t1"),
        "start_time_id": timestamp_to_time_id("t0"), "end_time_id": timestamp_to_time_id("t1"),
        "seconds": F.timestamp_diff("SECOND", F.col("t0"), F.col("t1")), "no_points": F.col("n"),
        "meters": F.col("n") * 12.5, "tortuosity": F.lit(1.0) + F.col("n") % 7 / 8,
        "meters_to_prev_obj": F.when(~F.col("first_week"), period * 1000 + user % 7),
        "seconds_to_prev_obj": F.when(~F.col("first_week"), period * 60),
        "prev_obj_type": F.when(
            ~F.col("first_week"),
            F.when((user + period) % 2 == 0, "in motion").otherwise("stationary"),
        ),
        "state_change": F.element_at(
            F.array(*[F.lit(s) for s in STATES]), ((user + period) % 8 + 1).cast("int")
        ),
        "vessel_name": _label("VESSEL ", user % 150), "call_sign": _label("CALL ", user % 97),
        "vessel_type": _label("type ", user % 5), "cargo_type": _label("cargo ", user % 4),
        "transponder_type": _label("class ", user % 2), "pos_type": _label("pos ", user % 3),
        "start_destination_msg": _label("DEST ", user % 23),
        "end_destination_msg": _label("DEST ", (user + period) % 23),
        "alpha2": F.concat(F.char(country + 65), F.lit("A")),
        "alpha3": F.concat(F.char(country + 65), F.lit("AX")),
        "country_name": _label("COUNTRY ", country), "country_code": country + 100,
        "region": _label("R", country % 5), "region_code": country % 5,
        "sub_region": _label("S", country % 10), "sub_region_code": country % 10,
        "intermediate_region": F.lit(None), "intermediate_region_code": F.lit(None),
        "geom": F.col("geom"), "start_point": F.element_at("geom", 1),
        "end_point": F.element_at("geom", -1), "is_simple_geom": user % 2 == 0,
        "is_valid_geom": F.lit(True),
        **config,
    }
    for part, tenths in parts.items():
        if part != "median":
            columns[f"calc_speed_{part}"] = _tenths(tenths + 1)
        columns[f"sog_{part}"] = _tenths(tenths)
        columns[f"draught_{part}"] = _tenths(tenths % 150)
        columns[f"ukc_{part}"] = F.when(user % 2 != 0, _tenths(tenths % 300))
    return ships.select(
        "week", *[columns[name].cast(kind).alias(name) for name, kind in REQUIRED.items()]
    )


def write_object_files(spark: SparkSession, sf_dir: str, path: str) -> tuple[str, str]:
    """Write the objects as trajectory files; the folders of the first weeks and of the rest."""
    rows = objects(spark, sf_dir)
    early, late = f"{path}/early", f"{path}/late"
    for folder, weeks in ((early, "week < 3"), (late, "week >= 3")):
        rows.filter(weeks).drop("week").write.parquet(folder)
    return early, late
