"""Planar, geographic and hierarchical cells over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as V
from ..samples import table
from .registry import query

BOUNDS = (100.0, 5.0, 1900.0, 95.5, 7.5, 2.5)
COUNTS = "with v as (select *, 240 as cols, 36 as rows from c)"
# some coordinates are made infinite, not a number or unknown
COORDINATES = """
  select l_orderkey, l_linenumber,
    case when l_quantity = 50 then 'Infinity'::double when l_quantity = 49 then 'NaN'::double
      when l_quantity = 48 then null else l_partkey + l_discount * 10 end as x,
    case when l_quantity = 47 then '-Infinity'::double when l_quantity = 46 then 'NaN'::double
      when l_quantity = 45 then null else l_suppkey + l_tax * 10 end as y from lineitem
"""


def coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity")
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    x = F.when(q == 50, inf).when(q == 49, nan).when(
        (q != 48) | q.isNull(), F.col("l_partkey") + F.col("l_discount") * 10
    )
    y = F.when(q == 47, -inf).when(q == 46, nan).when(
        (q != 45) | q.isNull(), F.col("l_suppkey") + F.col("l_tax") * 10
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", x.alias("x"), y.alias("y")
    )


# Cells as half-open intervals of each axis; a coordinate is in one or in none.
PLACED = f"""
with c as ({COORDINATES}),
across as (select n as i, 100 + n * 7.5e0 as low, 100 + (n + 1) * 7.5e0 as high from range(240) t(n)),
up as (select n as j, 5 + n * 2.5e0 as low, 5 + (n + 1) * 2.5e0 as high from range(36) t(n)),
k as (select c.*, i, j, x is not null and i is null or y is not null and j is null as beyond
  from c left join across on x >= across.low and x < across.high
  left join up on y >= up.low and y < up.high)
"""


@query(PLACED + """
select l_orderkey, l_linenumber, case when beyond then -1 else j * 240 + i end as grid_id,
  case when isfinite(x) and isfinite(y) then coalesce(j * 240 + i, -1) end as gid
from k""")
def grid_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coordinates(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", V.coord_to_grid_id("x", "y", *BOUNDS).alias("grid_id"),
        V.coord_to_gid("x", "y", *BOUNDS).alias("gid"),
    )


def _axis(bounds: tuple, ids: str) -> str:
    return f"""
with c as (select l_orderkey, l_linenumber, {ids} as id from lineitem), k as ({COUNTS} select * from v),
p as (select *, id between 0 and cols * rows - 1 as ok from k),
q as (select l_orderkey, l_linenumber, id, case when ok then id % cols * 7.5e0 + 100.0e0 end as x,
  case when ok then floor(id / cols) * 2.5e0 + 5.0e0 end as y from p)
"""


@query(_axis(BOUNDS, "l_partkey * 5 - 20") + "select * from q")
def grid_corner(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = V.gid_to_coord("id", *BOUNDS)
    return _ids(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "id", c["x"].alias("x"), c["y"].alias("y")
    )


def _ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") * 5 - 20).alias("id")
    )


@query(_axis(BOUNDS, "l_partkey * 5 - 20") + """
select l_orderkey, l_linenumber, x as x_min, y as y_min, x + 7.5e0 as x_max, y + 2.5e0 as y_max,
  x is null as is_empty from q""")
def grid_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ids(spark, sf_dir).withColumn("b", V.grid_id_to_envelope("id", *BOUNDS)).select(
        "l_orderkey", "l_linenumber", "b.*", (V.box_wkt("b") == "POLYGON EMPTY").alias("is_empty")
    )


LONLAT = """
  select l_orderkey, l_linenumber, ((l_partkey * 37) % 3601) / 10.0e0 - 180.0e0 as lon,
    ((l_suppkey * 53) % 1801) / 10.0e0 - 90.0e0 as lat from lineitem
"""


def lonlat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_partkey") * 37 % 3601 / 10.0 - 180.0).alias("lon"),
        (F.col("l_suppkey") * 53 % 1801 / 10.0 - 90.0).alias("lat"),
    )


# The four quadrants as a table, with the corner their cells are counted from.
WGS84 = f"""
with p as (select l_orderkey, l_linenumber, if(lon = 180, -180, lon) as lon, lat from ({LONLAT})),
quadrants(quadrant, west, east, south, north) as (
  values (1, 0, 180, 0, 91), (2, -180, 0, 0, 91), (3, -180, 0, -90, 0), (4, 0, 180, -90, 0)),
columns as (select n as i, n * 0.5e0 as low, n * 0.5e0 + 0.5e0 as high from range(360) t(n)),
rows as (select n as j, n * 0.5e0 as low, n * 0.5e0 + 0.5e0 as high from range(180) t(n)),
r as (select l_orderkey, l_linenumber, quadrant, coalesce(j * 360 + i + quadrant * 100000, -1) as grid_id
  from p join quadrants on lon >= west and lon < east and lat >= south and lat < north
  left join columns on lon - west >= columns.low and lon - west < columns.high
  left join rows on lat - south >= rows.low and lat - south < rows.high)
"""


@query(WGS84 + "select l_orderkey, l_linenumber, cast(quadrant as bigint) as quadrant, grid_id from r")
def wgs84_grid_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    lon = F.when(F.col("lon") == 180, -180.0).otherwise(F.col("lon"))
    return lonlat(spark, sf_dir).select(
        "l_orderkey", "l_linenumber",
        V.coord_to_quadrant(lon, "lat").cast("bigint").alias("quadrant"),
        V.wgs84_coord_to_grid_id("lon", "lat", 0.5, 0.5).alias("grid_id"),
    )


@query("""
with c as (select l_orderkey, l_linenumber, l_partkey * 499 % 600000 as id from lineitem),
q as (select *, id // 100000 as quadrant, id % 100000 as v from c),
p as (select *, case when quadrant between 1 and 4 and v < 64800 then v % 360 * 0.5e0
    + case when quadrant in (1, 4) then 180 else 0 end - 180 end as x,
  case when quadrant between 1 and 4 and v < 64800 then (v // 360) * 0.5e0
    + case when quadrant in (1, 2) then 90 else 0 end - 90 end as y from q)
select l_orderkey, l_linenumber, id, x, y, x + 0.5e0 as x_max, y + 0.5e0 as y_max,
  x is null as no_envelope from p""")
def wgs84_grid_corner(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") * 499 % 600000).alias("id")
    )
    c = V.grid_id_to_wgs84_coord("id", 0.5, 0.5)
    e = V.grid_id_to_wgs84_envelope("id", 0.5, 0.5)
    return ids.withColumn("e", e).select(
        "l_orderkey", "l_linenumber", "id", c["x"].alias("x"), c["y"].alias("y"),
        F.col("e.x_max"), F.col("e.y_max"), F.col("e").isNull().alias("no_envelope"),
    )


CHAIN_BOUNDS = (1599625, 762675, 6567875, 6743925)
CHAIN = """
with p as (select l_orderkey, l_linenumber, 1599000 + (l_partkey * 104729) % 5000000 as x,
    762000 + (l_suppkey * 7919 * 131) % 6000000 as y from lineitem),
d as (select *, x - 1599625 as dx, y - 762675 as dy from p),
k as (select *, case when dx < 0 or dy < 0 or dx // 1000 >= 4968 or dy // 1000 >= 5981 then -1
  else 10000 + (dy // 100 % 10 * 10 + dx // 100 % 10) * 100 + dy // 10 % 10 * 10 + dx // 10 % 10
  end as key, dy // 1000 * 4968 + dx // 1000 as ref_id from d)
"""


def chain_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_partkey") * 104729 % 5000000 + 1599000).alias("x"),
        (F.col("l_suppkey") * 7919 * 131 % 6000000 + 762000).alias("y"),
    )


def base_cell() -> Column:
    """The base cell of a point, which its key is below."""
    return V.coord_to_gid("x", "y", *CHAIN_BOUNDS, 1000, 1000)


def chain_key() -> Column:
    return V.to_gchain_key("x", "y", *CHAIN_BOUNDS, 1000)


@query(CHAIN + "select l_orderkey, l_linenumber, x, y, key from k")
def gchain_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain_points(spark, sf_dir).withColumn("key", chain_key())


@query(CHAIN + """
select l_orderkey, l_linenumber, level, case level when 1 then key // 100 % 100 else key % 100 end as cell
from k, (values (1), (2)) l(level) where key > 0""")
def gchain_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = chain_points(spark, sf_dir).withColumn("key", chain_key()).filter("key > 0")
    return keyed.select(
        "l_orderkey", "l_linenumber", F.posexplode(V.segment_gchain_key("key")).alias("n", "cell")
    ).select(
        "l_orderkey", "l_linenumber", (F.col("n") + 1).alias("level"),
        F.col("cell").cast("bigint").alias("cell"),
    )


@query(CHAIN + """
select l_orderkey, l_linenumber, ref_id, key as gchain_key, 1599625.0e0 + dx // 10 * 10 as x_min,
  762675.0e0 + dy // 10 * 10 as y_min, 1599635.0e0 + dx // 10 * 10 as x_max,
  762685.0e0 + dy // 10 * 10 as y_max
from k where key > 0""")
def gchain_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = chain_points(spark, sf_dir)
    keyed = points.withColumns({"key": chain_key(), "ref": base_cell()}).filter("key > 0")
    bounds = V.gchain_key_to_bounds("key", "ref", *CHAIN_BOUNDS, 1000, depth=2)
    return keyed.select("l_orderkey", "l_linenumber", bounds.alias("b")).select(
        "l_orderkey", "l_linenumber", "b.*"
    )


@query(CHAIN + """
select l_orderkey, l_linenumber, key, key // 100 as parent, key // 10000 as root, key as same
from k where key > 0""")
def gchain_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = chain_points(spark, sf_dir).withColumn("key", chain_key()).filter("key > 0")
    return keyed.select(
        "l_orderkey", "l_linenumber", "key", V.gchain_trim_key("key", 1).alias("parent"),
        V.gchain_trim_key("key", 0).alias("root"), V.gchain_trim_key("key", 9).alias("same"),
    )


@query(CHAIN + """
select count(*) as keys, cast(min(case when key > 0 then 2 end) as bigint) as depth,
  count(distinct case when key > 0 then key // 100 end) as parents from k""")
def gchain_depth_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = chain_points(spark, sf_dir).withColumn("key", chain_key())
    known = F.when(F.col("key") > 0, F.col("key"))
    return keyed.agg(
        F.count(F.lit(1)).alias("keys"), V.assert_one_depth(known).cast("bigint").alias("depth"),
        F.countDistinct(V.gchain_trim_key(known, 1)).alias("parents"),
    )


@query("""
select l_orderkey, l_linenumber, a - b * floor(a / b) as m,
  cast((whole % d + d) % d as bigint) as m_int
from (select l_orderkey, l_linenumber, l_partkey - 1000.0e0 as a,
    case when l_suppkey % 2 = 0 then 7.0e0 else -7.0e0 end as b,
    cast((l_partkey - 1000) * 9007199254740993 as hugeint) as whole,
    cast(case when l_suppkey % 2 = 0 then 7 else -7 end as hugeint) as d from lineitem) t""")
def floor_modulo(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.col("l_suppkey") % 2 == 0
    # beyond 64 bits from part 2024 on
    whole = (F.col("l_partkey") - 1000).cast("decimal(19,0)") * F.lit(2**53 + 1).cast("decimal(18,0)")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        V.modulo(F.col("l_partkey") - 1000.0, F.when(even, 7.0).otherwise(-7.0)).alias("m"),
        V.modulo_int(whole, F.when(even, 7).otherwise(-7), "decimal(38,0)").cast("bigint").alias("m_int"),
    )


@query(PLACED + """
select l_orderkey, l_linenumber, case when beyond then -1 else j * 240 + i end as grid_id,
  cast(strftime(l_shipdate, '%Y%m') as bigint) as part_key, l_partkey < 1000000000 as in_range
from k join lineitem using (l_orderkey, l_linenumber)""")
def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same functions called from SQL text."""
    V.register_functions(
        spark, ["coord_to_grid_id", "point_to_grid_id", "ts_to_temporal_part_key", "is_valid_mmsi"]
    )
    extra = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey"
    )
    rows = coordinates(spark, sf_dir).join(extra, ["l_orderkey", "l_linenumber"])
    return rows.selectExpr(
        "l_orderkey", "l_linenumber",
        "point_to_grid_id(named_struct('x', x, 'y', y), 100, 5, 1900, 95.5, 7.5, 2.5) AS grid_id",
        "ts_to_temporal_part_key(l_shipdate) AS part_key",
        "is_valid_mmsi(l_partkey) AS in_range",
    )


@query(f"""
with t as (select l_orderkey, l_linenumber, cast(l_orderkey % 19 as integer) as z, l_partkey * 131 as x,
  l_suppkey * 977 as y, 1000000 + (l_partkey * 7919 + l_suppkey * 31) % 9500000 as imo from lineitem),
d as (select *, [cast(c as bigint) for c in string_split(cast(imo as varchar), '')] as g from t)
select l_orderkey, l_linenumber, cast(z as bigint) as z, x & ((1 << z) - 1) as x, y & ((1 << z) - 1) as y,
  g[7] as check_digit, (7*g[1] + 6*g[2] + 5*g[3] + 4*g[4] + 3*g[5] + 2*g[6]) % 10 as comp_check_digit
from d where z > 0 and imo <= 9999999""")
def sql_table_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table functions under LATERAL: rows without a result fall away."""
    V.register_functions(spark, ["quadkey_to_zxy", "zxy_to_quadkey", "imo_checksum"])
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("vm_lineitem")
    return spark.sql("""
        WITH t AS (
            SELECT l_orderkey, l_linenumber,
                zxy_to_quadkey(int(l_orderkey % 19), l_partkey * 131, l_suppkey * 977) AS q,
                1000000 + (l_partkey * 7919 + l_suppkey * 31) % 9500000 AS imo
            FROM vm_lineitem
        )
        SELECT l_orderkey, l_linenumber, bigint(k.z) AS z, k.x, k.y,
            bigint(c.check_digit) AS check_digit, bigint(c.comp_check_digit) AS comp_check_digit
        FROM t, LATERAL quadkey_to_zxy(t.q) k, LATERAL imo_checksum(t.imo) c
    """)
