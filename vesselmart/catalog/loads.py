"""Dimension and fact loads, the ledger and table upkeep, over the sample objects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dimension as dims
from ..operators.audit import audit
from ..operators.ids import number_rows
from ..operators.lookup import lookup, new_members
from ..operators.merge import first_wins
from ..plans.loaders import FACTS
from ..plans.maintenance import compact
from ..plans.reports import ingest_rate as rates
from ..plans.reports import load_report as per_table
from ..plans.reports import rows_per_load
from ..plans.views import vessel_activity as activity
from ..samples import table, write_object_files
from ..session import scratch_dir
from ..sources.tables import read_quadkey
from ..sources.trajectories import REQUIRED, conformance, list_files
from ..warehouse import files
from ..warehouse.schema import CONFIG_COLUMNS, MEASURES, TABLES
from .registry import query
from .sqltext import MEASURE_COLUMNS, OBJECTS, PINGS
from .warehouses import load_again, object_warehouse, point_warehouse

# the objects that are loaded, with the load that brought them
LOADED = f"""
with l as (select o.*, case when week < 3 then 1 else 2 end as load_no,
  coalesce(prev_obj_type, 'unknown') as prev_type
  from ({OBJECTS}) o where type in ('in motion', 'stationary'))
"""


def whole(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint and other numbers as double, for comparing."""
    kinds = {"tinyint": "bigint", "smallint": "bigint", "int": "bigint", "float": "double"}

    def cast(field):
        kind = field.dataType.simpleString()
        target = "double" if kind.startswith("decimal") else kinds.get(kind)
        return F.col(field.name).cast(target) if target else F.col(field.name)

    return df.select(*[cast(f).alias(f.name) for f in df.schema])


@query(LOADED + """
select distinct id as date_id, cast(year(d) as bigint) as year_no, cast(month(d) as bigint) as month_no,
  cast(day(d) as bigint) as day_no, cast(weekofyear(d) as bigint) as week_no,
  cast(isodow(d) as bigint) as weekday_no, cast(quarter(d) as bigint) as quarter_no,
  strftime(d, '%Y-%m-%d') as iso_date, strftime(d, '%B') as month_name
from (select id, strptime(cast(id as varchar), '%Y%m%d') as d from
  (select start_date_id as id from l union select end_date_id from l) i) t""")
def dim_smart_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whole(object_warehouse(spark, sf_dir).table("date_dim"))


@query(LOADED + """
select distinct id as time_id, id // 10000 as hour_no, id // 100 % 100 as minute_no, id % 100 as second_no,
  (id // 10000 * 60 + id // 100 % 100) // 15 as fifteen_min_no,
  (id // 10000 * 60 + id // 100 % 100) // 5 as five_min_no
from (select start_time_id as id from l union select end_time_id from l) t""")
def dim_time_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whole(object_warehouse(spark, sf_dir).table("time_dim"))


@query(LOADED + """
select distinct alpha2, alpha3, country_name, country_code, region, sub_region, region_code, sub_region_code from l
union all select '??', '???', 'unknown', 0, null, null, null, null""")
def dim_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = object_warehouse(spark, sf_dir)
    return whole(wh.table("country_dim")).drop("intermediate_region", "intermediate_region_code")


# two unique keys over all orders: many rows rival for few of each
CONFLICTS = """
with recursive r as (select distinct o_custkey % 97 as a, o_orderkey % 89 as b, o_custkey % 7 as c from orders),
s as (select row_number() over (order by md5(a || '|' || b || '|' || c), a, b, c) as i, a, b, c from r),
t(i, a_taken, b_taken, ok) as (
  select cast(0 as bigint), cast([] as bigint[]), cast([] as bigint[]), false
  union all
  select s.i,
    case when list_contains(a_taken, s.a) or list_contains(b_taken, s.b) then a_taken
      else list_append(a_taken, s.a) end,
    case when list_contains(a_taken, s.a) or list_contains(b_taken, s.b) then b_taken
      else list_append(b_taken, s.b) end,
    not (list_contains(a_taken, s.a) or list_contains(b_taken, s.b))
  from t join s on s.i = t.i + 1)
select a, b, c from s join t using (i) where ok
"""


@query(CONFLICTS)
def dim_country_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert-or-ignore under two unique keys at once."""
    o = table(spark, sf_dir, "orders")
    rows = o.select(
        (F.col("o_custkey") % 97).alias("a"), (F.col("o_orderkey") % 89).alias("b"),
        (F.col("o_custkey") % 7).alias("c"),
    )
    taken = first_wins(rows, rows.limit(0), [("a",), ("b",)])
    return taken.select("a", "b", "c")


NAMED = {
    "transponder_type_dim": ("transponder_type", ["unknown"]),
    "vessel_type_dim": ("vessel_type", ["unknown"]),
    "vessel_name_dim": ("vessel_name", ["UNKNOWN"]),
    "pos_type_dim": ("pos_type", ["unknown"]),
    "cargo_type_dim": ("cargo_type", ["unknown"]),
    "call_sign_dim": ("call_sign", ["UNKNOWN"]),
    "traj_state_change_dim": (
        "state_change",
        ["unknown", "initial", "temporal gap", "spatial gap", "speeding", "corrupt", "stopping",
         "starting"],
    ),
    "traj_type_dim": ("prev_type", ["in motion", "stationary", "outlier"]),
}


def _named_sql(tables: dict[str, tuple[str, list[str]]], values: str = "l") -> str:
    parts = []
    for name, (column, seeds) in tables.items():
        seeded = ", ".join(f"('{s}', {n})" for n, s in enumerate(seeds, 1))
        parts.append(f"""
select '{name}' as dimension, value, cast(n as bigint) as id from (values {seeded}) s(value, n)
union all
select '{name}', value, {len(seeds)} + row_number() over (order by load_no, value) from (
  select {column} as value, min(load_no) as load_no from {values} where {column} not in
    ({', '.join(f"'{s}'" for s in seeds)}) group by 1) t""")
    return " union all ".join(parts)


@query(LOADED + _named_sql(NAMED))
def dim_surrogate_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text dimension: ids go on from the seeds, by load and then by value."""
    wh = object_warehouse(spark, sf_dir)
    parts = []
    for name in NAMED:
        key, value = TABLES[name].columns
        parts.append(
            wh.table(name).select(F.lit(name).alias("dimension"), F.col(value).alias("value"),
                                  F.col(key).alias("id"))
        )
    return reduce(DataFrame.unionAll, parts)


@query(LOADED + ", d as (select start_destination_msg as msg, load_no from l union all select end_destination_msg, load_no from l)"
       + _named_sql({"destination_dim": ("msg", ["unknown"])}, "d"))
def dim_destination_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return object_warehouse(spark, sf_dir).table("destination_dim").select(
        F.lit("destination_dim").alias("dimension"), F.col("org_msg").alias("value"),
        F.col("destination_id").alias("id"),
    )


@query(LOADED + """
select row_number() over (order by load_no, mmsi, imo nulls first) as vessel_id, * exclude (load_no) from (
  select mmsi, imo, mid, radio_service_type, is_valid_mmsi, is_valid_imo, in_eu_mrv_db,
    min(load_no) as load_no from l group by all) t""")
def dim_vessel_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whole(object_warehouse(spark, sf_dir).table("vessel_dim"))


_CONFIG = [c for c in CONFIG_COLUMNS if c not in ("to_starboard", "aux_engine_kwh")]


@query(LOADED + f"""
select row_number() over (order by load_no, {', '.join(f'{c} nulls first' for c in _CONFIG)}) as vessel_config_id,
  {', '.join(f'cast({c} as double) as {c}' for c in _CONFIG)} from (
  select {', '.join(_CONFIG)}, min(load_no) as load_no from l group by all) t""")
def dim_vessel_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = object_warehouse(spark, sf_dir).table("vessel_config_dim")
    return whole(dim).drop("to_starboard", "aux_engine_kwh")


@query("""
select row_number() over (order by o_orderdate, o_orderkey) + 1000 as id, o_orderkey from orders""")
def dense_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    order = [F.col("o_orderdate"), F.col("o_orderkey")]
    path = scratch_dir(spark, "dense_ids")
    return number_rows(rows, path, "id", 1001, order).rows.select("id", "o_orderkey")


@query("select count(*) as n, cast(1 as bigint) as first_id, count(*) as last_id, count(*) as ids from lineitem")
def dense_ids_unordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    numbered = number_rows(rows, scratch_dir(spark, "dense_ids"), "id")
    return numbered.rows.agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"),
        F.countDistinct("id").alias("ids"),
    )


@query("""
select l_orderkey, l_linenumber, p_partkey from lineitem left join part
  on case when l_partkey % 10 < 4 then null else l_partkey end is not distinct from
     case when p_partkey = 1 then null else p_partkey end""")
def nullsafe_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A look-up with over a third of the rows under one (null) key, without a broadcast."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_partkey") % 10 >= 4, F.col("l_partkey")).alias("k"),
    )
    dim = table(spark, sf_dir, "part").select(
        F.when(F.col("p_partkey") != 1, F.col("p_partkey")).alias("k"),
        F.col("p_partkey").alias("id"),
    )
    found = lookup(
        rows, dim, {"k": "k"}, "id", "p_partkey", dim_bytes=1 << 62, row_id="l_orderkey",
    )
    return found.select("l_orderkey", "l_linenumber", "p_partkey")


@query("""
select l_orderkey, l_linenumber, p_size, s_nationkey, o_custkey, c_nationkey,
  cast(n.n_regionkey as bigint) as n_regionkey, cast(m.n_regionkey as bigint) as low_region
from lineitem left join part on p_partkey = l_partkey and p_partkey > 40
  left join supplier on s_suppkey = l_suppkey left join orders on o_orderkey = l_orderkey
  left join customer on c_custkey = l_orderkey % 100
  left join nation n on n.n_nationkey = l_suppkey % 30
  left join nation m on m.n_nationkey is not distinct from case when l_suppkey % 3 = 0 then l_suppkey % 25 end""")
def lookup_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six look-ups one after another, none of them by broadcast."""
    base = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("l_orderkey") % 100).alias("c"), (F.col("l_suppkey") % 30).alias("n"),
        F.when(F.col("l_suppkey") % 3 == 0, F.col("l_suppkey") % 25).alias("m"),
        F.xxhash64("l_orderkey", "l_linenumber").alias("row"),
    )
    rows = base
    for name, key, at, value, out in (
        ("part", "l_partkey", "p_partkey", "p_size", "p_size"),
        ("supplier", "l_suppkey", "s_suppkey", "s_nationkey", "s_nationkey"),
        ("orders", "l_orderkey", "o_orderkey", "o_custkey", "o_custkey"),
        ("customer", "c", "c_custkey", "c_nationkey", "c_nationkey"),
        ("nation", "n", "n_nationkey", "n_regionkey", "n_regionkey"),
        ("nation", "m", "n_nationkey", "n_regionkey", "low_region"),
    ):
        dim = table(spark, sf_dir, name)
        if name == "part":
            dim = dim.filter("p_partkey > 40")  # frequent keys that the dimension has not
        rows = lookup(
            rows, dim, {key: at}, value, out, dim_bytes=1 << 62, row_id="row", counted=base
        )
    return whole(rows.drop("l_partkey", "l_suppkey", "c", "n", "m", "row"))


@query(f"""
with o as ({OBJECTS}), f as (select mmsi, imo, min(week) as week from o group by all)
select o.mmsi, o.imo, o.week % 2 = 0 as in_eu_mrv_db from o join f on o.mmsi = f.mmsi
  and o.imo is not distinct from f.imo and o.week = f.week
group by all""")
def vessel_conflicts_over_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch of several files that disagree on a vessel: the first file counts."""
    from ..samples import objects
    from ..warehouse.store import Warehouse

    rows = objects(spark, sf_dir).withColumns(
        {"load_id": F.col("week") + 1, "in_eu_mrv_db": F.col("week") % 2 == 0}
    )
    wh = Warehouse.create(spark, scratch_dir(spark, "warehouse"))
    batch = wh.next_batch()
    dims.load_dimension(wh, batch, rows, dims.VESSEL)
    wh.publish(batch)
    return wh.table("vessel_dim").select("mmsi", "imo", "in_eu_mrv_db")


@query("""
select distinct c_nationkey as k, c_mktsegment as v from customer
where not exists (select 1 from supplier where s_nationkey is not distinct from c_nationkey and s_suppkey % 2 = 0)""")
def new_members_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("k"), F.col("c_mktsegment").alias("v")
    ).distinct()
    known = table(spark, sf_dir, "supplier").filter("s_suppkey % 2 = 0").select(
        F.col("s_nationkey").alias("k")
    )
    return new_members(rows, known, ["k"])


_FACT_TEXT = (
    "state_change", "start_date_id", "start_time_id", "end_date_id", "end_time_id",
    "transponder_type", "mmsi", "imo", "length", "width", "height", "vessel_type", "vessel_name",
    "call_sign", "cargo_type", "pos_type", "start_destination", "end_destination", "alpha2",
    "meters", "seconds", "no_points", "tortuosity", "prev_obj_id", "prev_type",
    "dist_meter_prev_obj", "dist_sec_prev_obj", "points", "start_x", "end_y",
)


def _fact_sql(kind: str) -> str:
    measures = ", ".join(MEASURE_COLUMNS)
    return LOADED + f"""
select state_change, start_date_id, start_time_id, end_date_id, end_time_id, transponder_type, mmsi, imo,
  cast(length as double) as length, cast(width as double) as width, cast(height as double) as height,
  vessel_type, vessel_name, call_sign, cargo_type, pos_type,
  start_destination_msg as start_destination, end_destination_msg as end_destination, alpha2, meters,
  seconds, no_points, tortuosity, cast(null as bigint) as prev_obj_id, prev_type,
  meters_to_prev_obj as dist_meter_prev_obj, seconds_to_prev_obj as dist_sec_prev_obj,
  cast(len(geom) as bigint) as points, geom[1].x as start_x, geom[-1].y as end_y, {measures}
from l where type = '{kind}'"""


def _fact(spark: SparkSession, sf_dir: str, fact) -> DataFrame:
    """The fact with each id replaced by what it stands for."""
    wh = object_warehouse(spark, sf_dir)
    rows = wh.table(fact.table)
    plain = (
        "traj_state_change_dim", "transponder_type_dim", "vessel_dim", "vessel_config_dim",
        "vessel_type_dim", "vessel_name_dim", "call_sign_dim", "cargo_type_dim", "pos_type_dim",
    )
    for name in plain:
        rows = rows.join(wh.table(name), TABLES[name].primary)
    for role in ("start", "end"):
        destination = wh.table("destination_dim").select(
            F.col("destination_id").alias(f"{role}_destination_id"),
            F.col("org_msg").alias(f"{role}_destination"),
        )
        rows = rows.join(destination, f"{role}_destination_id")
    previous = wh.table("traj_type_dim").select(
        F.col("traj_type_id").alias("prev_obj_type_id"), F.col("traj_type").alias("prev_type")
    )
    geometry = wh.table(fact.geometry.table).select(
        "geom_id", F.size("geom").alias("points"), F.col("start_point.x").alias("start_x"),
        F.col("end_point.y").alias("end_y"),
    )
    joined = rows.join(previous, "prev_obj_type_id").join(geometry, "geom_id")
    return whole(joined.select(*_FACT_TEXT, *MEASURES))


@query(_fact_sql("in motion"))
def traj_fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, FACTS[0])


@query(_fact_sql("stationary"))
def stop_fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, FACTS[1])


@query(LOADED + """, c as (select type, count(*) as n from l group by 1)
select case type when 'in motion' then 'ais_traj_fact' else 'ais_stop_fact' end as table_name, n as n_rows,
  cast(1 as bigint) as first_id, n as last_id, n as ids, n as geometries from c""")
def fact_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and geometry ids are consecutive over both loads."""
    wh = object_warehouse(spark, sf_dir)
    parts = [
        wh.table(f.table).join(wh.table(f.geometry.table).select("geom_id"), "geom_id").agg(
            F.lit(f.table).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
            F.min(f.key).alias("first_id"), F.max(f.key).alias("last_id"),
            F.countDistinct(f.key).alias("ids"), F.countDistinct("geom_id").alias("geometries"),
        )
        for f in FACTS
    ]
    return reduce(DataFrame.unionAll, parts)


@query(LOADED + """
select 'ais_traj_fact' as table_name, count(*) as n_rows from l where type = 'in motion'
union all select 'ais_stop_fact', count(*) from l where type = 'stationary'
union all select 'vessel_dim', count(*) from (select distinct mmsi, imo from l) t
union all select 'traj_geom_dim', count(*) from l where type = 'in motion'""")
def idempotent_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts after loading the same files once more."""
    wh = object_warehouse(spark, sf_dir)
    load_again(wh)
    names = ("ais_traj_fact", "ais_stop_fact", "vessel_dim", "traj_geom_dim")
    return reduce(
        DataFrame.unionAll,
        (wh.table(n).agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for n in names),
    )


@query(LOADED + """
select case type when 'in motion' then 'ais_traj_fact' else 'ais_stop_fact' end as dst_tbl,
  count(*) as no_rows, true as all_good, true as counts_agree from l group by 1""")
def ledger_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = object_warehouse(spark, sf_dir)
    counted = reduce(
        DataFrame.unionAll, (rows_per_load(wh, f.table).withColumnRenamed("no_rows", "n") for f in FACTS)
    )
    loads = wh.loads().join(counted, "load_id", "left")
    agree = F.col("no_rows") == F.coalesce("n", F.lit(0))
    return loads.groupBy("dst_tbl").agg(
        F.sum("no_rows").alias("no_rows"),
        F.bool_and(~F.col("failed") & ~F.col("deleted") & F.col("end_ts").isNotNull()).alias("all_good"),
        F.bool_and(agree).alias("counts_agree"),
    )


@query(LOADED + """
select case type when 'in motion' then 'ais_traj_fact' else 'ais_stop_fact' end as dst_tbl,
  count(*) as no_rows, true as rate_agrees from l group by 1""")
def ingest_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each fact's loads; each load's rate times its seconds gives them."""
    found = rates(object_warehouse(spark, sf_dir))
    # a load whose file has no such objects has no rows, and no rate if it took no time
    agrees = F.abs(F.coalesce("rows_per_sec", F.lit(0.0)) * F.col("seconds") - F.col("no_rows")) < 1e-6
    return found.groupBy("dst_tbl").agg(F.sum("no_rows").alias("no_rows"), F.bool_and(agrees).alias("rate_agrees"))


def _table_counts() -> dict[str, str]:
    """Rows of every table after both loads, in SQL."""
    named = {
        t: f"select count(*) from (select distinct {c} as v from l union select unnest([{', '.join(map(repr, s))}])) x"
        for t, (c, s) in NAMED.items()
    }
    config = ", ".join(_CONFIG)
    motion, still = ("select count(*) from l where type = " + repr(k) for k in ("in motion", "stationary"))
    return {
        **named,
        "date_dim": "select count(*) from (select start_date_id from l union select end_date_id from l) x",
        "time_dim": "select count(*) from (select start_time_id from l union select end_time_id from l) x",
        "country_dim": "select 1 + count(distinct alpha2) from l",
        "vessel_dim": "select count(*) from (select distinct mmsi, imo from l) x",
        "vessel_config_dim": f"select count(*) from (select distinct {config} from l) x",
        "destination_dim": "select count(*) from (select start_destination_msg as v from l union "
        "select end_destination_msg from l union select 'unknown') x",
        "nav_status_dim": "select 1", "depth_grid_dim": "select 1", "half_degree_grid_dim": "select 0",
        "ais_point_fact": "select 0", "traj_geom_dim": motion, "stop_geom_dim": still,
        "ais_traj_fact": motion, "ais_stop_fact": still,
    }


SEEDED = {n: len(t.seeds) for n, t in TABLES.items() if t.seeds}


@query(LOADED + " union all ".join(
    f"select '{t}' as table_name, cast(({n}) - {SEEDED.get(t, 0)} as bigint) as loaded, true as timed where ({n}) > {SEEDED.get(t, 0)}"
    for t, n in _table_counts().items()
))
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and seconds of each table over both loads, as the writes observed them."""
    report = per_table(object_warehouse(spark, sf_dir)).filter("batch_id > 0")
    agrees = F.abs(F.col("rows_per_sec") * F.col("seconds") - F.col("inserted")) < 1e-6
    return report.groupBy("table_name").agg(
        F.sum("inserted").alias("loaded"), F.bool_and((F.col("seconds") > 0) & agrees).alias("timed")
    )


DIRTY = """
with v as (select l_partkey as vessel_id, case when l_suppkey % 10 = 0 then null else 219000000 + l_suppkey end as mmsi,
    case when l_linenumber = 1 then null else l_partkey % 50 end as imo,
    case when l_quantity < 5 then null else 'ship' end as radio_service_type, l_linenumber > 1 as is_valid_mmsi
  from lineitem)
"""


@query(DIRTY + """
select 'not null: vessel_id' as rule, count(*) filter (vessel_id is null) as violations from v
union all select 'not null: mmsi', count(*) filter (mmsi is null) from v
union all select 'not null: radio_service_type', count(*) filter (radio_service_type is null) from v
union all select 'not null: is_valid_mmsi', count(*) filter (is_valid_mmsi is null) from v
union all select 'not null: is_valid_imo', count(*) from v
union all select 'sequence: vessel_id <= 4294967295', cast(0 as bigint)
union all select 'unique: vessel_id', count(*) from (select vessel_id from v group by 1 having count(*) > 1) t
union all select 'unique: mmsi, imo', count(*) from (select mmsi, imo from v
  where mmsi is not null and imo is not null group by all having count(*) > 1) t""")
def constraint_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vessel table with faults of every kind."""
    line = table(spark, sf_dir, "lineitem")
    dirty = line.select(
        F.col("l_partkey").alias("vessel_id"),
        F.when(F.col("l_suppkey") % 10 != 0, F.col("l_suppkey") + 219000000).alias("mmsi"),
        F.when(F.col("l_linenumber") != 1, F.col("l_partkey") % 50).alias("imo"),
        F.lit(None).cast("int").alias("mid"),
        F.when(F.col("l_quantity") >= 5, "ship").alias("radio_service_type"),
        (F.col("l_linenumber") > 1).alias("is_valid_mmsi"),
        F.lit(None).cast("boolean").alias("is_valid_imo"),
        F.lit(None).cast("boolean").alias("in_eu_mrv_db"),
    )
    return audit(dirty, "vessel_dim").select("rule", "violations")


def _too_long(name: str) -> str:
    """Values of a text dimension beyond the declared length, in SQL."""
    if name not in NAMED:
        return "0"
    column, seeds = NAMED[name]
    limit = next(iter(TABLES[name].lengths.values()), None)
    values = f"select distinct {column} as v from l union select unnest([{', '.join(map(repr, seeds))}])"
    return f"(select count(*) from ({values}) x where length(v) > {limit})" if limit else "0"


@query(LOADED + " union all ".join(
    f"select '{t}' as table_name, cast(({n}) as bigint) as n_rows, cast(0 as bigint) as broken, "
    f"cast({_too_long(t)} as bigint) as too_long" for t, n in _table_counts().items()
))
def audit_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table with its rows, broken rules, and texts beyond the declared
    lengths, which do not bind (two seeds are longer)."""
    wh = object_warehouse(spark, sf_dir)
    parts = []
    for name in TABLES:
        rows = wh.table(name)
        size = rows.agg(F.count(F.lit(1)).alias("n_rows"))
        length = F.col("rule").startswith("length")
        found = audit(rows, name).groupBy("table_name").agg(
            F.coalesce(F.sum(F.when(~length, F.col("violations"))), F.lit(0)).alias("broken"),
            F.coalesce(F.sum(F.when(length, F.col("violations"))), F.lit(0)).alias("too_long"),
        )
        # one row each
        parts.append(found.crossJoin(size).select("table_name", "n_rows", "broken", "too_long"))
    return reduce(DataFrame.unionAll, parts)


@query(LOADED + """, e as (select * from l where load_no = 1), n as (
  select type, count(*) as n from e group by 1)
select case type when 'in motion' then 'ais_traj_fact' else 'ais_stop_fact' end as table_name,
  case type when 'in motion' then n else 0 end as n_rows,
  case type when 'in motion' then n else 0 end as geometries,
  case type when 'in motion' then n else 2 * n end as last_id,
  case type when 'in motion' then n else 2 * n end as last_geom_id,
  cast(case type when 'in motion' then 1 else 2 end as bigint) as failed,
  cast(case type when 'in motion' then 0 else 2 end as bigint) as deleted from n""")
def deleted_and_failed_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A failed load of the first weeks, a good one, and its stops deleted, loaded anew
    (twice as many ids) and deleted once more."""
    from ..plans.loaders import STOP_FACT, load
    from ..warehouse.ledger import mark_deleted
    from ..warehouse.store import Warehouse

    early, _ = write_object_files(spark, sf_dir, scratch_dir(spark, "objects"))
    paths = [p for p in list_files(spark, early) if p.endswith(".parquet")]
    wh = Warehouse.create(spark, scratch_dir(spark, "warehouse"))

    def stop() -> None:
        raise RuntimeError("as if the cluster went down")

    def delete_stops() -> None:
        good = wh.loads().filter("NOT failed AND NOT deleted AND dst_tbl = 'ais_stop_fact'")
        mark_deleted(wh, [r.load_id for r in good.select("load_id").collect()])

    try:
        load(wh, paths, before_publish=stop)
    except RuntimeError:
        pass
    load(wh, paths)
    delete_stops()
    try:
        load(wh, paths, [STOP_FACT], before_publish=stop)
    except RuntimeError:
        pass
    load(wh, paths)
    delete_stops()
    files = len(paths)
    ended = wh.loads().groupBy(F.col("dst_tbl").alias("table_name")).agg(
        (F.count_if("failed") / files).cast("bigint").alias("failed"),
        (F.count_if("deleted") / files).cast("bigint").alias("deleted"),
    )
    parts = [
        wh.table(f.table).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(f.table).alias("table_name"), "n_rows",
            F.lit(wh.count(f.geometry.table)).cast("bigint").alias("geometries"),
            F.lit(wh.max_id(f.table, f.key)).cast("bigint").alias("last_id"),
            F.lit(wh.max_id(f.geometry.table)).cast("bigint").alias("last_geom_id"),
        )
        for f in FACTS
    ]
    return reduce(DataFrame.unionAll, parts).join(ended, "table_name")


@query(f"""
with o as (select * from ({OBJECTS}) o)
select 'ais_traj_fact' as table_name, count(*) as n_rows from o where type = 'in motion'
union all select 'ais_stop_fact', count(*) from o where type = 'stationary'
union all select 'traj_geom_dim', count(*) from o where type = 'in motion'""")
def arrivals_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that arrive in two steps, each loaded once, beside one that does not qualify."""
    from ..streaming.arrivals import load_arrivals
    from ..warehouse.store import Warehouse

    early, late = write_object_files(spark, sf_dir, scratch_dir(spark, "objects"))
    inbox, check = scratch_dir(spark, "inbox"), scratch_dir(spark, "arrivals")
    wh = Warehouse.create(spark, scratch_dir(spark, "warehouse"))
    table(spark, sf_dir, "events").select("event_id").write.parquet(inbox)
    for folder in (early, late):
        spark.read.parquet(folder).write.mode("append").parquet(inbox)
        load_arrivals(wh, inbox, check).awaitTermination()
    load_arrivals(wh, inbox, check).awaitTermination()  # nothing new
    names = ("ais_traj_fact", "ais_stop_fact", "traj_geom_dim")
    return reduce(
        DataFrame.unionAll,
        (wh.table(n).agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for n in names),
    )


@query("""
select mode, sum(n) :: bigint as n_rows, sum(q) :: bigint as quantity from (
  select 'append' as mode, 2 * count(*) as n, 2 * sum(l_quantity) as q from lineitem
  union all select 'replace', count(*), sum(l_quantity) from lineitem where l_linenumber = 1) t group by 1""")
def ingest_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows created and appended to, and a table replaced by other rows."""
    from ..sources.tables import ingest

    line = table(spark, sf_dir, "lineitem").select("l_linenumber", "l_quantity")
    appended, replaced = scratch_dir(spark, "append"), scratch_dir(spark, "replace")
    ingest(line, appended, "create")
    ingest(line, appended, "append", row_bytes=16)
    ingest(line, replaced, "create_append")
    ingest(line.filter("l_linenumber = 1"), replaced, "replace")
    return reduce(
        DataFrame.unionAll,
        (
            spark.read.parquet(path).agg(
                F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("n_rows"),
                F.sum("l_quantity").cast("bigint").alias("quantity"),
            )
            for mode, path in (("append", appended), ("replace", replaced))
        ),
    )


@query(LOADED + f"""
select distinct mmsi, type as traj_type, start_date_id, start_time_id, end_date_id, end_time_id, alpha2, meters,
  seconds, no_points, tortuosity, cast(len(geom) as bigint) as points, geom[1].y as start_y, {', '.join(MEASURE_COLUMNS)}
from l""")
def vessel_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = activity(object_warehouse(spark, sf_dir))
    return whole(
        view.select(
            "mmsi", "traj_type", "start_date_id", "start_time_id", "end_date_id", "end_time_id",
            "alpha2", "meters", "seconds", "no_points", "tortuosity",
            F.size("geom").alias("points"), F.get("geom", F.lit(0))["y"].alias("start_y"),
            *MEASURES,
        )
    )


POINTS = f"""
with p as (select *, cast(trunc((lon + 180.0e0) / 360.0e0 * 16777216) as bigint) as tx,
    cast(trunc((1.0e0 - ln(tan(radians(lat)) + 1.0e0 / cos(radians(lat))) / pi()) / 2.0e0 * 16777216) as bigint) as ty
  from ({PINGS}) s),
k as (select *, cast(list_sum(list_transform(range(16, 24), lambda i: (((tx >> i) & 1) + 2 * ((ty >> i) & 1))
    * (4 ** (i - 16)))) as bigint) as spatial_part_key,
  cast(year(ts) * 100 + month(ts) as bigint) as temporal_part_key from p)
"""


@query(POINTS + """
select event_id + 1 as ais_point_id, spatial_part_key, temporal_part_key,
  cast(strftime(ts, '%Y%m%d') as bigint) as date_id, user_id + 1 as vessel_id
from k where spatial_part_key // 64 = 386""")
def partition_pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points below one quadkey; only its partitions are read."""
    points = point_warehouse(spark, sf_dir).table("ais_point_fact")
    return read_quadkey(points, "12002").select(
        "ais_point_id", "spatial_part_key", "temporal_part_key", "date_id", "vessel_id"
    )


@query(POINTS + """
select event_id + 1 as ais_point_id, spatial_part_key, temporal_part_key, cents / 100.0e0 as sog_cents
from k""")
def compacted_equals_original(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All points, after their small files were merged."""
    wh = point_warehouse(spark, sf_dir)
    compact(wh, "ais_point_fact")
    cents = table(spark, sf_dir, "events").select(
        (F.col("event_id") + 1).alias("ais_point_id"),
        (F.round(F.col("value") * 100).cast("bigint") / 100.0).alias("sog_cents"),
    )
    rows = wh.table("ais_point_fact").select("ais_point_id", "spatial_part_key", "temporal_part_key")
    return rows.join(cents, "ais_point_id")


def under_hidden_name(spark: SparkSession, path: str) -> str:
    """The file under a name that begins with an underscore."""
    folder, name = path.rsplit("/", 1)
    files.rename(spark, path, f"{folder}/_{name}")
    return f"{folder}/_{name}"


@query(f"""
with o as (select count(*) as n from ({OBJECTS}) o),
f(folder, compatible, missing, hidden) as (values ('as it should be', true, 0, false), ('50%20 off+more', true, 0, false),
  ('lacks two', false, 2, false), ('no table', false, 79, false), ('other name', false, 79, false), ('_set aside', true, 0, true))
select folder, compatible, cast(missing as bigint) as missing, hidden from f, o where n > 0""")
def file_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that qualify and files that do not, some under names with odd characters."""
    from ..samples import objects

    root = scratch_dir(spark, "conformance")
    made = objects(spark, sf_dir).drop("week")
    made.write.parquet(f"{root}/as it should be")
    # the objects are made once, and read for the others
    rows = spark.read.schema(made.schema).parquet(f"{root}/as it should be")
    rows.withColumn("more", F.lit(1)).write.parquet(f"{root}/50%20 off+more")
    rows.drop("mmsi", "geom").write.parquet(f"{root}/lacks two")
    rows.select("vessel_name").write.option("header", True).csv(f"{root}/no table")
    rows.write.orc(f"{root}/other name")
    rows.write.parquet(f"{root}/_set aside")
    folders = ("as it should be", "50%20 off+more", "lacks two", "no table", "other name")
    paths = [p for f in folders for p in list_files(spark, f"{root}/{f}") if "/part-" in p]
    # files under names that Spark's readers pass over
    paths += [under_hidden_name(spark, p) for p in list_files(spark, f"{root}/_set aside") if "/part-" in p]
    folder = F.element_at(F.split("path", "/"), -2)
    return conformance(spark, paths).select(
        folder.alias("folder"), "compatible", F.size("missing").cast("bigint").alias("missing"), "hidden",
    ).distinct()


@query(f"""
select type, count(*) as n, count(prev_obj_type) as with_previous, sum(n)::bigint as points
from ({OBJECTS}) o group by 1""")
def read_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trajectory files as read back, all types of object."""
    from ..sources.trajectories import read_trajectories

    folders = write_object_files(spark, sf_dir, scratch_dir(spark, "objects"))
    rows = read_trajectories(spark, [[p for p in list_files(spark, f) if p.endswith(".parquet")] for f in folders])
    return rows.select(*REQUIRED).groupBy("type").agg(
        F.count(F.lit(1)).alias("n"), F.count("prev_obj_type").alias("with_previous"),
        F.sum("no_points").alias("points"),
    )


@query("""
select distinct o_orderpriority as nav_status, 1 + dense_rank() over (order by o_orderpriority) as nav_status_id
from orders union all select 'unknown', 1""")
def dim_nav_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension loaded on its own, with a column under another name."""
    from ..warehouse.store import Warehouse

    wh = Warehouse.create(spark, scratch_dir(spark, "warehouse"))
    batch = wh.next_batch()
    dims.load_dimension(
        wh, batch, table(spark, sf_dir, "orders"), dims.NAV_STATUS, [{"nav_status": "o_orderpriority"}]
    )
    wh.publish(batch)
    return wh.table("nav_status_dim")
