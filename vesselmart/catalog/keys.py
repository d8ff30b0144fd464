"""Time keys, vessel identity and quadkeys over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as V
from ..operators.expanders import expand_date_ids, expand_time_ids
from ..samples import pings, table
from .registry import query
from .sqltext import OBJECTS, PINGS

MMSI_CASES = """
  select l_orderkey, l_linenumber, case l_orderkey % 14
    when 0 then 219000000 + l_partkey      when 1 then 2190000 + l_partkey * 10
    when 2 then 1000000 + l_partkey        when 3 then 21900000 + l_suppkey
    when 4 then 111000000 + l_partkey      when 5 then 990000000 + l_partkey * 100 + l_suppkey
    when 6 then 982190000 + l_partkey      when 7 then 821900000 + l_partkey
    when 8 then 970000000 + l_partkey      when 9 then 972000000 + l_suppkey
    when 10 then 974000000 + l_partkey     when 11 then 979000000 + l_suppkey
    when 12 then 9790000000 + l_partkey    else null end as mmsi
  from lineitem
"""


@query(f"""
select event_id, cast(strftime(ts, '%Y%m%d') as bigint) as date_id,
  cast(strftime(ts, '%-H%M%S') as bigint) as time_id,
  cast(hour(ts) * 60 + minute(ts) as bigint) as minutes,
  strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') as day_start,
  '1900-01-01 ' || strftime(ts, '%H:%M:%S') as time_of_day,
  strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as second_start
from events""")
def timekeys_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "events").select(
        "event_id", V.timestamp_to_date_id("ts").alias("date_id"),
        V.timestamp_to_time_id("ts").alias("time_id"),
        V.minutes_since_midnight("ts").cast("bigint").alias("minutes"),
    )
    text = "yyyy-MM-dd HH:mm:ss"
    return keyed.withColumns(
        {
            "day_start": F.date_format(V.date_id_to_timestamp("date_id"), text),
            "time_of_day": F.date_format(V.time_id_to_timestamp("time_id"), text),
            "second_start": F.date_format(
                V.datetime_keys_to_timestamp("date_id", "time_id"), text
            ),
        }
    )


@query("""
select distinct cast(strftime(d, '%Y%m%d') as bigint) as date_id, cast(year(d) as bigint) as year_no,
  cast(month(d) as bigint) as month_no, cast(day(d) as bigint) as day_no,
  cast(weekofyear(d) as bigint) as week_no, cast(isodow(d) as bigint) as weekday_no,
  cast(quarter(d) as bigint) as quarter_no, strftime(d, '%Y-%m-%d') as iso_date,
  strftime(d, '%B') as month_name
from (select o_orderdate as d from orders union all select l_shipdate from lineitem) t""")
def date_dim_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select("o_orderdate").unionAll(
        table(spark, sf_dir, "lineitem").select("l_shipdate")
    )
    keyed = days.select(V.timestamp_to_date_id("o_orderdate").alias("date_id"))
    out = expand_date_ids(keyed, {"date_id": "date_id"})
    return out.select(
        *[F.col(c).cast("bigint").alias(c) if c.endswith(("_no", "_id")) else c for c in out.columns]
    )


@query("""
select distinct cast(strftime(ts, '%-H%M%S') as bigint) as time_id, cast(hour(ts) as bigint) as hour_no,
  cast(minute(ts) as bigint) as minute_no, cast(second(ts) as bigint) as second_no,
  cast(floor((hour(ts) * 60 + minute(ts)) / 15) as bigint) as fifteen_min_no,
  cast(floor((hour(ts) * 60 + minute(ts)) / 5) as bigint) as five_min_no
from events""")
def time_dim_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "events").select(V.timestamp_to_time_id("ts").alias("time_id"))
    return expand_time_ids(keyed, {"time_id": "time_id"})


@query("""
select cast(year(o_orderdate) * 100 + month(o_orderdate) as bigint) as temporal_part_key,
  count(*) as orders
from orders group by 1""")
def temporal_part_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = V.ts_to_temporal_part_key("o_orderdate").alias("temporal_part_key")
    return table(spark, sf_dir, "orders").groupBy(key).agg(F.count(F.lit(1)).alias("orders"))


# What a number starts with tells its service, at times with one more digit; the
# longest prefix counts, and a digit before none.
SERVICES = """
services(prefix, place, digit, service) as (values
  ('00', 6, '1', 'cost station'), ('00', 6, '2', 'port station'), ('00', 6, '3', 'pilot station'),
  ('00', 6, '4', 'ais repeater station'), ('00', 6, '5', 'ais base station'), ('00', 0, '', 'unknown'),
  ('0', 0, '', 'ship group'), ('2', 0, '', 'ship'), ('3', 0, '', 'ship'), ('4', 0, '', 'ship'),
  ('5', 0, '', 'ship'), ('6', 0, '', 'ship'), ('7', 0, '', 'ship'),
  ('111', 7, '1', 'fixed-wing aircraft'), ('111', 7, '5', 'helicopter'), ('111', 0, '', 'unknown'),
  ('99', 6, '1', 'physical ais aton'), ('99', 6, '6', 'virtual ais aton'), ('99', 6, '8', 'mobile aton'),
  ('99', 0, '', 'unknown'), ('98', 0, '', 'deployable child craft'),
  ('8', 0, '', 'handheld vhf transceiver with dsc and integral gnss receiver'),
  ('970', 0, '', 'ais-sart'), ('972', 0, '', 'man overboard'), ('974', 0, '', 'epirb-ais'),
  ('979', 0, '', 'amrd group b')),
countries(prefix, start) as (values ('00', 3), ('98', 3), ('99', 3), ('0', 2), ('8', 2), ('111', 4),
  ('2', 1), ('3', 1), ('4', 1), ('5', 1), ('6', 1), ('7', 1))
"""


@query(f"""
with m as ({MMSI_CASES}), s as (select *, lpad(cast(mmsi as varchar), 9, '0') as t from m), {SERVICES},
numbers as (select distinct t from s where t is not null),
known as (select t, arg_max(service, 2 * length(prefix) + sign(place)) as service
  from numbers join services on starts_with(t, prefix) and (place = 0 or t[place] = digit) group by t),
country as (select t, arg_max(substr(t, start, 3), length(prefix)) as mid
  from numbers join countries on starts_with(t, prefix) group by t)
select l_orderkey, l_linenumber, mmsi, length(cast(mmsi as varchar)) <= 9 as valid,
  coalesce(service, 'unknown') as service, cast(mid as bigint) as mid
from s left join known using (t) left join country using (t)""")
def mmsi_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("vm_lineitem")
    return spark.sql(MMSI_CASES.replace("from lineitem", "from vm_lineitem")).select(
        "l_orderkey", "l_linenumber", "mmsi", V.is_valid_mmsi("mmsi").alias("valid"),
        V.mmsi_to_radio_service_type("mmsi").alias("service"),
        V.mmsi_to_mid("mmsi").cast("bigint").alias("mid"),
    )


@query("""
with i as (select l_orderkey, l_linenumber,
  case when l_orderkey % 7 = 0 then null when l_orderkey % 7 = 1 then l_partkey
    else 1000000 + (l_partkey * 7919 + l_suppkey * 31) % 9500000 end as imo from lineitem),
d as (select *, [cast(c as bigint) for c in string_split(cast(imo as varchar), '')] as g from i)
select l_orderkey, l_linenumber, imo,
  case when imo between 1000000 and 9999999 then g[7] end as check_digit,
  case when imo between 1000000 and 9999999 then
    (7*g[1] + 6*g[2] + 5*g[3] + 4*g[4] + 3*g[5] + 2*g[6]) % 10 end as comp_check_digit,
  coalesce(imo between 1000000 and 9999999
    and (7*g[1] + 6*g[2] + 5*g[3] + 4*g[4] + 3*g[5] + 2*g[6]) % 10 = g[7], false) as valid
from d""")
def imo_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, part, supp = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    imo = F.when(order % 7 == 1, part).when(
        order % 7 != 0, (part * 7919 + supp * 31) % 9500000 + 1000000
    )
    c = V.imo_checksum("imo")
    return (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber", imo.alias("imo"))
        .select(
            "*", c["check_digit"].cast("bigint").alias("check_digit"),
            c["comp_check_digit"].cast("bigint").alias("comp_check_digit"),
            V.is_valid_imo("imo").alias("valid"),
        )
    )


# lineitem keys as tile numbers at a zoom level that varies by row
TILES = """
  select l_orderkey, l_linenumber, cast(l_orderkey % 19 as integer) as z,
    l_partkey * 131 as x, l_suppkey * 977 as y from lineitem
"""
DIGITS = "list_transform(range(z, 0, -1), lambda i: cast(((x >> (i - 1)) & 1) + 2 * ((y >> (i - 1)) & 1) as varchar))"


@query(f"""
with t as ({TILES})
select l_orderkey, l_linenumber, coalesce(array_to_string({DIGITS}, ''), '') as quadkey from t""")
def quadkey_from_zxy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tiles(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", V.zxy_to_quadkey("z", "x", "y").alias("quadkey")
    )


def _tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_orderkey") % 19).cast("int").alias("z"),
        (F.col("l_partkey") * 131).alias("x"), (F.col("l_suppkey") * 977).alias("y"),
    )


@query(f"""
with t as ({TILES})
select l_orderkey, l_linenumber, cast(z as bigint) as z, x & ((1 << z) - 1) as x,
  y & ((1 << z) - 1) as y
from t where z > 0""")
def quadkey_to_zxy(spark: SparkSession, sf_dir: str) -> DataFrame:
    tile = V.quadkey_to_zxy(V.zxy_to_quadkey("z", "x", "y"))
    return (
        _tiles(spark, sf_dir).withColumn("t", tile).filter("t IS NOT NULL")
        .select(
            "l_orderkey", "l_linenumber", F.col("t.z").cast("bigint").alias("z"), "t.x", "t.y"
        )
    )


# as TILES, with up to 32 levels and numbers that fill them
DEEP_TILES = """
  select l_orderkey, l_linenumber, cast(l_orderkey % 33 as integer) as z,
    (l_partkey * 2654435 + l_linenumber * 97) % 4294967296 as x,
    (l_suppkey * 40503271 + l_linenumber * 89) % 4294967296 as y from lineitem
"""


@query(f"""
with k as (select l_orderkey, l_linenumber, array_to_string({DIGITS}, '') as q
  from (select * from ({DEEP_TILES}) where z > 0) t),
b as (select *, replace(replace(replace(replace(
    translate(q, '0123', 'abcd'), 'a', '00'), 'b', '01'), 'c', '10'), 'd', '11') as bits from k)
select l_orderkey, l_linenumber, bits,
  case when length(q) <= 8 then cast(cast(bits as bit) as smallint)::bigint end as i16,
  case when length(q) <= 16 then cast(cast(bits as bit) as integer)::bigint end as i32,
  cast(cast(bits as bit) as bigint) as i64,
  case when length(q) <= 8 then cast(cast(bits as bit) as usmallint)::bigint end as u16,
  case when length(q) <= 16 then cast(cast(bits as bit) as uinteger)::bigint end as u32,
  cast(cast(cast(bits as bit) as ubigint) as varchar) as u64
from b""")
def quadkey_encode_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    keys = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_orderkey") % 33).cast("int").alias("z"),
        ((part * 2654435 + line * 97) % 2**32).alias("x"),
        ((supp * 40503271 + line * 89) % 2**32).alias("y"),
    ).filter("z > 0").withColumn("q", V.zxy_to_quadkey("z", "x", "y"))

    def up_to(digits: int, value: Column) -> Column:
        return F.when(F.length("q") <= digits, value).cast("bigint")

    return keys.select(
        "l_orderkey", "l_linenumber", V.quadkey_bit_encode("q").alias("bits"),
        up_to(8, V.quadkey_int16_encode("q")).alias("i16"),
        up_to(16, V.quadkey_int32_encode("q")).alias("i32"),
        V.quadkey_int64_encode("q").alias("i64"),
        up_to(8, V.quadkey_uint16_encode("q")).alias("u16"),
        up_to(16, V.quadkey_uint32_encode("q")).alias("u32"),
        V.quadkey_uint64_encode("q").cast("string").alias("u64"),
    )


@query("""
with v as (select l_orderkey, l_linenumber, l_partkey * 7919 - 5000000 as val,
  cast(l_orderkey % 33 as integer) as z from lineitem)
select l_orderkey, l_linenumber, array_to_string(list_transform(range(z, 0, -1),
  lambda i: case right(cast(val::bit as varchar), 2 * i)[:2]
    when '00' then '0' when '01' then '1' when '10' then '2' else '3' end), '') as quadkey
from v where z > 0
union all select l_orderkey, l_linenumber, null from v where z = 0""")
def int_to_quadkey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn(
        "z", (F.col("l_orderkey") % 33).cast("int")
    ).select(
        "l_orderkey", "l_linenumber",
        V.int_to_quadkey(F.col("l_partkey") * 7919 - 5000000, "z").alias("quadkey"),
    )


@query(f"""
with p as ({PINGS})
select event_id, cast(14 as bigint) as z, cast(trunc((lon + 180.0e0) / 360.0e0 * 16384) as bigint) as x,
  cast(trunc((1.0e0 - ln(tan(radians(lat)) + 1.0e0 / cos(radians(lat))) / pi()) / 2.0e0 * 16384)
    as bigint) as y
from p""")
def tile_xyz(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = V.get_zxy("lon", "lat", F.lit(14))
    return pings(spark, sf_dir).select(
        "event_id", t["z"].cast("bigint").alias("z"), t["x"].alias("x"), t["y"].alias("y")
    )


@query(f"""
with t as ({TILES}), k as (select l_orderkey, l_linenumber, z, coalesce(array_to_string({DIGITS}, ''), '') as q from t),
r as (select *, left(q, 8) as h from k),
b as (select *, h || repeat('0', 8 - length(h)) as a, h || repeat('3', 8 - length(h)) as c from r)
select l_orderkey, l_linenumber,
  cast(list_sum(list_transform(range(1, 9), lambda i: cast(a[i] as bigint) * (4 ** (8 - i)))) as bigint) as lo,
  cast(list_sum(list_transform(range(1, 9), lambda i: cast(c[i] as bigint) * (4 ** (8 - i)))) as bigint) as hi,
  coalesce(cast(list_sum(list_transform(range(1, z + 1), lambda i: cast(q[i] as bigint) * (4 ** (z - i)))) as bigint), 0) as value,
  repeat('0', cast((4 - z % 4) % 4 as integer)) || q as byte_quadkey
from b""")
def quadkey_prefix_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _tiles(spark, sf_dir).withColumn("q", V.zxy_to_quadkey("z", "x", "y"))
    r = V.compute_qkey_range("q")
    value = V.quadkey_to_int("q")
    # a value of z digits always fits z + 1 digits' signed bytes, and is padded to whole bytes
    padded = V.int_to_quadkey_bytes(value, F.col("z") + 1)
    width = (F.ceil(F.col("z") / 4) * 4).cast("int")
    return keyed.select(
        "l_orderkey", "l_linenumber", r["lo"].alias("lo"), r["hi"].alias("hi"),
        value.alias("value"), F.right(padded, width).alias("byte_quadkey"),
    )


@query(f"""
with o as ({OBJECTS}) select traj_id, mmsi, imo, mid, radio_service_type, is_valid_mmsi, is_valid_imo
from o""")
def object_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..samples import objects

    return objects(spark, sf_dir).select(
        "traj_id", "mmsi", "imo", F.col("mid").cast("bigint").alias("mid"), "radio_service_type",
        "is_valid_mmsi", "is_valid_imo",
    )
