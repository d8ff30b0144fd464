"""Processors that turn a batch into a dimension's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timekeys import date_id_to_timestamp, time_id_to_timestamp
from ..functions._columns import idiv
from ..warehouse.schema import GEOM_COLUMNS, LINE, STOP_EXTRA, TRAJ_EXTRA
from .geometry import centroid, with_stop_shapes

SIMPLIFY_TOLERANCE = 0.1  # fixed value


def expand_date_ids(batch: DataFrame, names: dict[str, str]) -> DataFrame:
    """Distinct date keys with their calendar fields."""
    key = names["date_id"]
    ts = F.col("__ts")
    return (
        batch.select(key).distinct().withColumn("__ts", date_id_to_timestamp(key))
        .select(
            key,
            F.year(ts).alias("year_no"), F.month(ts).alias("month_no"), F.day(ts).alias("day_no"),
            F.weekofyear(ts).alias("week_no"), (F.weekday(ts) + 1).alias("weekday_no"),
            F.quarter(ts).alias("quarter_no"), F.date_format(ts, "yyyy-MM-dd").alias("iso_date"),
            F.date_format(ts, "MMMM").alias("month_name"),
        )
    )


def expand_time_ids(batch: DataFrame, names: dict[str, str]) -> DataFrame:
    """Distinct time keys with hour, minute, second and the slots of the day.

    A key that is no time of day is an error.
    """
    key = names["time_id"]
    t = F.hour(time_id_to_timestamp(key)) * 10000 + F.col(key) % 10000
    hour, minute = idiv(t, 10000), idiv(t, 100) % 100
    return batch.select(key).distinct().select(
        key, hour.alias("hour_no"), minute.alias("minute_no"), (t % 100).alias("second_no"),
        idiv(hour * 60 + minute, 15).alias("fifteen_min_no"),
        idiv(hour * 60 + minute, 5).alias("five_min_no"),
    )


def expand_stop_geometry(batch: DataFrame, names: dict[str, str]) -> DataFrame:
    """Adds centroid, convex hull and a simplification that keeps the line's topology."""
    kept = [c for c in ("geom_id", "ais_stop_id", "load_id") if c in batch.columns]
    center, hull, simplified = STOP_EXTRA
    shaped = with_stop_shapes(
        batch.select(*kept, *[F.col(names[c]).alias(c) for c in GEOM_COLUMNS]),
        "geom", hull=hull, simplified=simplified, tolerance=SIMPLIFY_TOLERANCE,
    )
    return shaped.withColumn(center, centroid("geom"))


def expand_traj_geometry(batch: DataFrame, names: dict[str, str]) -> DataFrame:
    """Adds the empty places for later simplifications."""
    kept = [c for c in ("geom_id", "ais_traj_id", "load_id") if c in batch.columns]
    return batch.select(
        *kept, *[F.col(names[c]).alias(c) for c in GEOM_COLUMNS],
        *[F.lit(None).cast(LINE).alias(c) for c in TRAJ_EXTRA],
    )
