"""Summaries and shapes of the sample objects' lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import geometry as G
from ..samples import objects
from ..sources.wkb import line_to_wkb, wkb_to_line
from .registry import query
from .sqltext import OBJECTS
from .warehouses import object_warehouse

LINES = f"with o as ({OBJECTS}), e as (select traj_id, unnest(geom) as p, generate_subscripts(geom, 1) as i from o)"


@query(LINES + """,
s as (select traj_id, p.x as ax, p.y as ay, lead(p.x) over w as qx, lead(p.y) over w as qy, i from e
  window w as (partition by traj_id order by i)),
m as (select *, sqrt((qx - ax) * (qx - ax) + (qy - ay) * (qy - ay)) as d from s),
c as (select traj_id, sum(d) as length, sum((ax + qx) / 2 * d) as sx, sum((ay + qy) / 2 * d) as sy,
  avg(ax) as mx, avg(ay) as my from m group by 1)
select traj_id, round(case when length > 0 then sx / length else mx end, 6) as x,
  round(case when length > 0 then sy / length else my end, 6) as y, round(length, 6) as length from c""")
def line_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = objects(spark, sf_dir).select(
        "traj_id", G.centroid("geom").alias("c"), G.line_length("geom").alias("length")
    )
    return rows.select(
        "traj_id", F.round("c.x", 6).alias("x"), F.round("c.y", 6).alias("y"),
        F.round("length", 6).alias("length"),
    )


@query(LINES + """,
u as (select distinct traj_id, cast(round(p.x * 10000) as bigint) as x, cast(round(p.y * 10000) as bigint) as y from e),
g as (select a.traj_id, a.x as ax, a.y as ay, b.x as qx, b.y as qy,
    min((b.x - a.x) * (q.y - a.y) - (b.y - a.y) * (q.x - a.x)) as side,
    max(case when (b.x - a.x) * (q.y - a.y) = (b.y - a.y) * (q.x - a.x)
      and ((q.x - a.x) * (b.x - a.x) + (q.y - a.y) * (b.y - a.y) < 0
        or (q.x - b.x) * (a.x - b.x) + (q.y - b.y) * (a.y - b.y) < 0) then 1 else 0 end) as beyond
  from u a join u b on a.traj_id = b.traj_id and (a.x, a.y) <> (b.x, b.y)
    join u q on q.traj_id = a.traj_id group by all)
select traj_id, ax as x, ay as y,
  round(sum(ax * qy - qx * ay) over (partition by traj_id) / 2e8, 6) + 0.0e0 as area
from g where side >= 0 and beyond = 0""")
def convex_hull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corners and area of each hull (a line that collapses to a segment has no area).

    Points are taken in whole ten-thousandths, so that points on one line are so
    in both engines.
    """
    whole = F.transform("geom", lambda p: F.struct(
        F.round(p["x"] * 10000).alias("x"), F.round(p["y"] * 10000).alias("y")
    ))
    hulls = objects(spark, sf_dir).select("traj_id", whole.alias("geom"))
    hulls = hulls.select("traj_id", G.convex_hull("geom").alias("h")).filter(F.size("h") > 1)
    head, tail = F.expr("slice(h, 1, size(h) - 1)"), F.expr("slice(h, 2, size(h) - 1)")
    doubled = F.aggregate(
        F.zip_with(head, tail, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"]), F.lit(0.0),
        lambda total, v: total + v,
    )
    corners = F.when(F.size("h") == 2, F.col("h")).otherwise(head)
    area = F.when(F.size("h") == 2, 0.0).otherwise(F.round(doubled / 2e8, 6)) + 0.0
    return hulls.select("traj_id", area.alias("area"), F.explode(corners).alias("p")).select(
        "traj_id", F.col("p.x").cast("bigint").alias("x"), F.col("p.y").cast("bigint").alias("y"), "area"
    )


@query()
def simplified_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = objects(spark, sf_dir).select(
        "traj_id", "geom", G.simplify_preserve_topology("geom", 0.1).alias("s")
    )
    return rows.select("traj_id", F.size("geom").alias("points"), F.size("s").alias("kept"))


@query(LINES + """
select traj_id, cast(len(geom) as bigint) as points, geom[1].x as x1, geom[1].y as y1, geom[-1].x as x2,
  geom[-1].y as y2, true as in_order, true as near from o where len(geom) >= 2""")
def simplified_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends of the simplified line; whether its points are some of the line's in their
    order, and whether no point of the line is over the tolerance off it."""
    rows = objects(spark, sf_dir).filter(F.size("geom") >= 2).select(
        "traj_id", "geom", G.simplify_preserve_topology("geom", 0.1).alias("s")
    )
    matched = F.expr("aggregate(geom, 0, (k, p) -> if(try_element_at(s, k + 1) <=> p, k + 1, k))")
    rows = rows.withColumn("parts", F.expr("zip_with(slice(s, 1, size(s) - 1), slice(s, 2, size(s) - 1), "
        "(a, b) -> struct(a.x AS x, a.y AS y, b.x - a.x AS dx, b.y - a.y AS dy, "
        "greatest((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y), 1e-300) AS square))"))
    along = "greatest(0D, least(1D, ((p.x - e.x) * e.dx + (p.y - e.y) * e.dy) / e.square))"
    off = "+".join(f"power(p.{v} - e.{v} - e.d{v} * {along}, 2)" for v in "xy")
    near = F.expr(f"forall(geom, p -> exists(parts, e -> {off} <= 0.01D + 1e-9D))")
    first, last = G.start_point("s"), G.end_point("s")
    return rows.select(
        "traj_id", F.size("geom").cast("bigint").alias("points"), G.point_x(first).alias("x1"),
        G.point_y(first).alias("y1"), G.point_x(last).alias("x2"), G.point_y(last).alias("y2"),
        (matched == F.size("s")).alias("in_order"), near.alias("near"),
    )


@query(LINES + """
select traj_id, cast(len(geom) as bigint) as points, geom[1].x as x1, geom[1].y as y1, geom[-1].x as x2,
  geom[-1].y as y2, len(geom) >= 2 as is_line, true as same_ends from o""")
def endpoint_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End points taken from the line, and whether the given ones agree."""
    first, last = G.start_point("geom"), G.end_point("geom")
    same = (F.col("start_point") == first) & (F.col("end_point") == last)
    return objects(spark, sf_dir).select(
        "traj_id", F.size("geom").cast("bigint").alias("points"), G.point_x(first).alias("x1"),
        G.point_y(first).alias("y1"), G.point_x(last).alias("x2"), G.point_y(last).alias("y2"),
        G.is_linestring("geom").alias("is_line"), same.alias("same_ends"),
    )


@query(LINES + "select traj_id, i, p.x as x, p.y as y from e")
def wkb_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = objects(spark, sf_dir).select("traj_id", line_to_wkb("geom").alias("wkb"))
    return lines.select("traj_id", F.posexplode(wkb_to_line("wkb")).alias("n", "p")).select(
        "traj_id", (F.col("n") + 1).cast("bigint").alias("i"), "p.x", "p.y"
    )


@query(LINES + """,
c as (select traj_id, is_simple_geom, cast(len(geom) as bigint) as points from o where type = 'in motion')
select points, is_simple_geom, true as is_valid_geom, count(*) as n, cast(0 as bigint) as filled
from c group by all""")
def traj_geom_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = object_warehouse(spark, sf_dir).table("traj_geom_dim")
    return rows.groupBy(
        F.size("geom").cast("bigint").alias("points"), "is_simple_geom", "is_valid_geom"
    ).agg(
        F.count(F.lit(1)).alias("n"), F.count("cust_simplified_geom_00").alias("filled")
    )


@query(LINES + """,
s as (select traj_id, p.x as ax, p.y as ay, lead(p.x) over w as qx, lead(p.y) over w as qy, i from e
  window w as (partition by traj_id order by i)),
m as (select *, sqrt((qx - ax) * (qx - ax) + (qy - ay) * (qy - ay)) as d from s),
c as (select traj_id, sum(d) as length, sum((ax + qx) / 2 * d) as sx, sum((ay + qy) / 2 * d) as sy,
  avg(ax) as mx, avg(ay) as my from m group by 1)
select round(case when c.length > 0 then sx / c.length else mx end, 6) as x,
  round(case when c.length > 0 then sy / c.length else my end, 6) as y, geom[1].x as start_x
from c join o using (traj_id) where type = 'stationary'""")
def stop_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = object_warehouse(spark, sf_dir).table("stop_geom_dim")
    return rows.select(
        F.round("centroid.x", 6).alias("x"), F.round("centroid.y", 6).alias("y"),
        F.col("start_point.x").alias("start_x"),
    )
