"""Reports on loads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..warehouse.store import Warehouse


def rows_per_load(wh: Warehouse, fact: str) -> DataFrame:
    return wh.table(fact).groupBy("load_id").agg(F.count(F.lit(1)).alias("no_rows"))


def ingest_rate(wh: Warehouse) -> DataFrame:
    """Rows per second of each good load, null for one that took no time."""
    loads = wh.loads().filter("NOT failed")
    counts = reduce(
        DataFrame.unionAll,
        (rows_per_load(wh, n).withColumn("dst_tbl", F.lit(n)) for n in ("ais_traj_fact", "ais_stop_fact")),
    )
    seconds = (
        F.unix_micros(F.col("ingest_end_ts").cast("timestamp"))
        - F.unix_micros(F.col("ingest_start_ts").cast("timestamp"))
    ) / 1e6
    return (
        loads.drop("no_rows").join(counts, ["load_id", "dst_tbl"], "left")
        .select(
            "load_id", "src_id", "dst_tbl",
            F.coalesce("no_rows", F.lit(0)).alias("no_rows"), seconds.alias("seconds"),
        )
        .withColumn("rows_per_sec", F.try_divide("no_rows", "seconds"))
    )


def load_report(wh: Warehouse) -> DataFrame:
    """(batch_id, table_name, inserted, seconds, rows_per_sec) of every table that a
    published batch grew, as counted and timed by the writes."""
    events = wh.events()
    published = events.filter("kind IN ('publish', 'compact')").select("batch_id")
    seconds = (
        F.unix_micros(F.col("ingest_end_ts").cast("timestamp"))
        - F.unix_micros(F.col("ingest_start_ts").cast("timestamp"))
    ) / 1e6
    return (
        events.filter("kind = 'table' AND no_rows > 0").join(published, "batch_id", "left_semi")
        .groupBy("batch_id", "table_name")
        .agg(F.sum("no_rows").alias("inserted"), F.sum(seconds).alias("seconds"))
        .withColumn("rows_per_sec", F.try_divide("inserted", "seconds"))
    )


def batch_report(wh: Warehouse, batch_id: int) -> DataFrame:
    """(table_name, inserted, seconds, rows_per_sec) for everything one batch added."""
    return load_report(wh).filter(F.col("batch_id") == batch_id).drop("batch_id")
