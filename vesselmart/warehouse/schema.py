"""Tables of the warehouse: types, keys, seeds and constraints.

Unsigned types are widened one step; a linestring is an array of points.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import types as T

POINT = "struct<x: double, y: double>"
LINE = f"array<{POINT}>"
MAX_UINT = 4_294_967_295
MAX_USMALLINT = 65_535
MEASURE = "decimal(10,1)"


@dataclass(frozen=True)
class Table:
    name: str
    ddl: str
    kind: str = "dim"
    primary: str | None = None
    unique: tuple[tuple[str, ...], ...] = ()
    max_id: int | None = None  # set when the primary key is a sequence
    lengths: dict[str, int] = field(default_factory=dict)
    checks: dict[str, str] = field(default_factory=dict)
    seed_columns: tuple[str, ...] = ()
    seeds: tuple[tuple, ...] = ()
    partition_by: tuple[str, ...] = ()
    by_load: bool = False  # files also tell each row's load, so that a deleted load's rows can be hidden

    @cached_property
    def schema(self) -> T.StructType:
        """Needs a running session, which reads the text."""
        return T.StructType.fromDDL(self.ddl)

    @property
    def read_schema(self) -> T.StructType:
        """All columns nullable, as files give them back."""
        return T.StructType([T.StructField(f.name, f.dataType) for f in self.schema])

    @property
    def file_schema(self) -> T.StructType:
        """The columns of the table's files."""
        own = self.read_schema
        return own.add("load_id", T.LongType()) if self.by_load else own

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]


def _named_value(column: str, length: int | None, max_id: int, seeds: tuple[str, ...],
                 table: str | None = None, key: str | None = None) -> Table:
    """A dimension that is one unique text behind a sequence."""
    table, key = table or f"{column}_dim", key or f"{column}_id"
    return Table(
        table, f"{key} bigint not null, {column} string not null", primary=key,
        unique=((column,),), max_id=max_id, lengths={column: length} if length else {},
        seed_columns=(key, column), seeds=tuple((n, s) for n, s in enumerate(seeds, 1)),
    )


GEOM_HEAD = (
    f"geom_id bigint not null, geom {LINE} not null, start_point {POINT} not null, "
    f"end_point {POINT} not null, is_simple_geom boolean not null, is_valid_geom boolean not null"
)
IS_LINE = {"geom is a linestring": "size(geom) >= 2"}

FACT_IDS = (
    "load_id bigint not null, state_change_id bigint not null, start_date_id bigint not null, "
    "start_time_id bigint not null, end_date_id bigint not null, end_time_id bigint not null, "
    "transponder_type_id bigint not null, vessel_id bigint not null, "
    "vessel_config_id bigint not null, vessel_type_id bigint not null, "
    "vessel_name_id bigint not null, call_sign_id bigint not null, cargo_type_id bigint not null, "
    "pos_type_id bigint not null, start_destination_id bigint not null, "
    "end_destination_id bigint not null, alpha2 string not null, geom_id bigint not null"
)
MEASURES = tuple(
    f"{family}_{part}"
    for family, parts in {
        "calc_speed": ("start", "end", "max", "min", "avg"),
        "sog": ("start", "end", "max", "min", "avg", "median"),
        "draught": ("start", "end", "min", "max", "avg", "median"),
        "ukc": ("start", "end", "min", "max", "avg", "median"),
    }.items()
    for part in parts
)
OBJECT_FACT = (
    f"{FACT_IDS}, meters {MEASURE} not null, seconds bigint not null, no_points bigint not null, "
    "tortuosity float not null, " + ", ".join(f"{m} {MEASURE}" for m in MEASURES)
    + ", prev_obj_id bigint, prev_obj_type_id bigint, dist_meter_prev_obj bigint, "
    "dist_sec_prev_obj bigint"
)
GEOM_COLUMNS = ("geom", "start_point", "end_point", "is_simple_geom", "is_valid_geom")
TRAJ_EXTRA = tuple(f"cust_simplified_geom_{n:02}" for n in range(5))
STOP_EXTRA = ("centroid", "simplified_geom", "simplified_geom_topo")
CONFIG_COLUMNS = (
    "length", "width", "height", "max_draught", "dwt", "grt", "to_bow", "to_stern", "to_port",
    "to_starboard", "main_engine_kwh", "aux_engine_kwh",
)

_TABLES = (
    Table(
        "date_dim",
        "date_id bigint not null, year_no int not null, month_no smallint not null, "
        "day_no smallint not null, week_no smallint not null, weekday_no smallint not null, "
        "quarter_no smallint not null, iso_date string not null, month_name string not null",
        primary="date_id", lengths={"iso_date": 10, "month_name": 9},
    ),
    Table(
        "time_dim",
        "time_id bigint not null, hour_no smallint not null, minute_no smallint not null, "
        "second_no smallint not null, fifteen_min_no smallint not null, five_min_no int not null",
        primary="time_id",
    ),
    Table(
        "country_dim",
        "alpha2 string not null, alpha3 string not null, country_name string not null, "
        "country_code int not null, region_code int, sub_region_code int, "
        "intermediate_region_code int, region string, sub_region string, "
        "intermediate_region string",
        primary="alpha2", unique=(("alpha3",), ("country_name",), ("country_code",)),
        lengths={"alpha2": 2, "alpha3": 3, "country_name": 56, "region": 8, "sub_region": 31,
                 "intermediate_region": 15},
        seed_columns=("alpha2", "alpha3", "country_name", "country_code"),
        seeds=(("??", "???", "unknown", 0),),
    ),
    Table(
        "vessel_dim",
        "vessel_id bigint not null, mmsi bigint not null, imo bigint, mid int, "
        "radio_service_type string not null, is_valid_mmsi boolean not null, "
        "is_valid_imo boolean not null, in_eu_mrv_db boolean",
        primary="vessel_id", unique=(("mmsi", "imo"),), max_id=MAX_UINT,
    ),
    Table(
        "vessel_config_dim",
        "vessel_config_id bigint not null, " + ", ".join(f"{c} float" for c in CONFIG_COLUMNS),
        primary="vessel_config_id", unique=(CONFIG_COLUMNS,), max_id=MAX_UINT,
    ),
    Table(
        "depth_grid_dim",
        f"depth_cell_id bigint not null, x bigint not null, y bigint not null, "
        f"depth float not null, partly_land boolean, derived_value boolean, geom {LINE} not null",
        primary="depth_cell_id", unique=(("x", "y"),), checks={"depth is not negative": "depth >= 0"},
        seed_columns=("depth_cell_id", "x", "y", "depth", "geom"),
        seeds=((1, MAX_UINT, MAX_UINT, 0.0, []),),
    ),
    Table(
        "half_degree_grid_dim", "half_degree_cell_id bigint not null, gst_cell_id string",
        primary="half_degree_cell_id", max_id=MAX_UINT, lengths={"gst_cell_id": 5},
    ),
    _named_value("transponder_type", 29, MAX_USMALLINT, ("unknown",)),
    _named_value("vessel_type", 250, MAX_USMALLINT, ("unknown",)),
    _named_value("vessel_name", 250, MAX_UINT, ("UNKNOWN",)),
    _named_value("pos_type", 250, MAX_USMALLINT, ("unknown",)),
    _named_value("cargo_type", 50, MAX_USMALLINT, ("unknown",)),
    _named_value("call_sign", 250, MAX_UINT, ("UNKNOWN",)),
    _named_value("org_msg", None, MAX_UINT, ("unknown",), "destination_dim", "destination_id"),
    _named_value("nav_status", 250, MAX_USMALLINT, ("unknown",)),
    _named_value("traj_type", 10, MAX_USMALLINT, ("in motion", "stationary", "outlier")),
    # fixed values; two seeds are longer than the declared ten characters, as lengths do not bind
    _named_value(
        "state_change", 10, MAX_USMALLINT,
        ("unknown", "initial", "temporal gap", "spatial gap", "speeding", "corrupt", "stopping",
         "starting"),
        "traj_state_change_dim",
    ),
    Table(
        "traj_geom_dim",
        f"{GEOM_HEAD}, " + ", ".join(f"{c} {LINE}" for c in TRAJ_EXTRA),
        primary="geom_id", max_id=MAX_UINT, checks=IS_LINE, by_load=True,
    ),
    Table(
        "stop_geom_dim",
        f"{GEOM_HEAD}, centroid {POINT} not null, simplified_geom {LINE} not null, "
        f"simplified_geom_topo {LINE} not null",
        primary="geom_id", max_id=MAX_UINT, checks=IS_LINE, by_load=True,
    ),
    Table(
        "ais_point_fact",
        "ais_point_id bigint not null, prev_ais_point_id bigint, temporal_part_key bigint not null, "
        "spatial_part_key bigint not null, qkey bigint not null, alpha2 string not null, "
        "load_id bigint not null, date_id bigint not null, time_id bigint not null, "
        "call_sign_id bigint not null, cargo_type_id bigint not null, depth_cell_id bigint not null, "
        "destination_id bigint not null, half_degree_cell_id bigint not null, "
        "nav_status_id bigint not null, pos_type_id bigint not null, "
        "transponder_type_id bigint not null, vessel_id bigint not null, "
        "vessel_config_id bigint not null, vessel_type_id bigint not null, "
        "vessel_name_id bigint not null, ts timestamp_ntz not null, lon float not null, "
        "lat float not null, "
        + ", ".join(f"{m} {MEASURE}" for m in ("rot", "sog", "cog", "heading", "draught"))
        + ", depth float, eta timestamp_ntz, ukc float, delta_pos float, delta_sec float, "
        + ", ".join(
            f"delta_{m} {MEASURE}"
            for m in ("sog", "rot", "cog", "heading", "cog_heading", "draught")
        )
        + ", delta_destination boolean",
        kind="fact", partition_by=("spatial_part_key", "temporal_part_key"),
    ),
    Table("ais_traj_fact", f"ais_traj_id bigint not null, {OBJECT_FACT}", kind="fact"),
    Table("ais_stop_fact", f"ais_stop_id bigint not null, {OBJECT_FACT}", kind="fact"),
)
TABLES: dict[str, Table] = {t.name: t for t in _TABLES}

# Names, types, keys, seeds and limits above are those any loader agrees on.
# One row per load as of now; kept as an event log and folded on read.
LOAD_DIM = Table(
    "load_dim",
    "load_id bigint, src_id string, dst_tbl string, start_ts timestamp_ntz, end_ts timestamp_ntz, "
    "no_rows bigint, ingest_start_ts timestamp_ntz, ingest_end_ts timestamp_ntz, "
    "ingest_per_sec float, failed boolean, deleted boolean",
)
EVENTS = Table(
    "events",
    "seq bigint, kind string, batch_id bigint, table_name string, replaces array<bigint>, "
    "last_id bigint, "
    + LOAD_DIM.ddl,
)
