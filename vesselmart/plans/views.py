"""Saved queries over the loaded facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import lookup
from ..warehouse.store import Warehouse
from .loaders import FACTS, ObjectFact


def _activity(wh: Warehouse, fact: ObjectFact) -> DataFrame:
    rows = wh.table(fact.table)
    geometry = wh.table(fact.geometry.table).select("geom_id", "geom")
    named = lookup(
        rows, wh.table("vessel_dim"), {"vessel_id": "vessel_id"}, "mmsi", "mmsi",
        dim_bytes=wh.bytes("vessel_dim"), row_id=fact.key, how="inner",
    )
    joined = named.join(geometry, "geom_id")
    shape = [c for c in rows.columns if c not in (fact.key, "load_id", "geom_id")]
    return joined.select("mmsi", F.lit(fact.object_type).alias("traj_type"), *shape, "geom")


def vessel_activity(wh: Warehouse) -> DataFrame:
    """What each vessel did, in motion and stationary, without repeats.

    The branches differ in ``traj_type``, so repeats are taken out per branch
    and the union needs no shuffle of its own.
    """
    first, second = (_activity(wh, fact).distinct() for fact in FACTS)
    return first.unionByName(second)


def register_views(wh: Warehouse) -> None:
    """Name every table and the activity view for SQL in the session."""
    from ..warehouse.schema import TABLES

    for name in TABLES:
        wh.table(name).createOrReplaceTempView(name)
    wh.loads().createOrReplaceTempView("load_dim")
    vessel_activity(wh).createOrReplaceTempView("vessel_activity")
