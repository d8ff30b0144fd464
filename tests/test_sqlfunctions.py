"""SQL functions agree with the column functions and stay inlined."""

import math

import pytest
from pyspark.sql import functions as F

from vesselmart import functions as V

ROWS = [
    (0, 219000000, 9074729, "30202332", 10.0, 56.0, 141422, 16884, 3),
    (1, 2191000, 1000000, "", 180.0, 0.0, 200000, 1336884, 0),
    (2, 992196001, None, "12020110", -180.0, -89.5, 403628, 10203, 8),
    (3, None, 5, None, math.nan, 12.0, -1, 1, 1),
    (4, 979123456, 9999999, "0123", math.inf, None, 16411067, 101, 5),
    (5, 111219500, 1234567, "3333", None, 89.9, None, None, 2),
]
DDL = (
    "n int, mmsi bigint, imo bigint, q string, lon double, lat double, id bigint, key bigint, z int"
)
AREA = (1599625.0, 762675.0, 6567875.0, 6743925.0, 1000.0, 1000.0)
AREA_SQL = ", ".join(map(str, AREA))


def pairs():
    return {
        "is_valid_mmsi(mmsi)": V.is_valid_mmsi("mmsi"),
        "mmsi_to_radio_service_type(mmsi)": V.mmsi_to_radio_service_type("mmsi"),
        "mmsi_to_mid(mmsi)": V.mmsi_to_mid("mmsi"),
        "is_valid_imo(imo)": V.is_valid_imo("imo"),
        "quadkey_bit_encode(q)": V.quadkey_bit_encode("q"),
        "quadkey_int16_encode(q)": V.quadkey_int16_encode("q"),
        "quadkey_int32_encode(q)": V.quadkey_int32_encode("q"),
        "quadkey_int64_encode(q)": V.quadkey_int64_encode("q"),
        "quadkey_uint16_encode(q)": V.quadkey_uint16_encode("q"),
        "quadkey_uint32_encode(q)": V.quadkey_uint32_encode("q"),
        "quadkey_uint64_encode(q)": V.quadkey_uint64_encode("q"),
        "quadkey_to_int(q)": V.quadkey_to_int("q"),
        "zxy_to_quadkey(z, id, key)": V.zxy_to_quadkey("z", "id", "key"),
        "int_to_quadkey(id, z)": V.int_to_quadkey("id", "z"),
        "get_zxy(lon, lat, z)": V.get_zxy("lon", "lat", "z"),
        "coord_to_grid_id(lon, lat, 0, 0, 180, 90, 0.5, 0.5)":
            V.coord_to_grid_id("lon", "lat", 0, 0, 180, 90, 0.5, 0.5),
        "coord_to_gid(lon, lat, 0, 0, 180, 90, 0.5, 0.5)":
            V.coord_to_gid("lon", "lat", 0, 0, 180, 90, 0.5, 0.5),
        f"grid_id_to_coord(id, {AREA_SQL})": V.grid_id_to_coord("id", *AREA),
        f"grid_id_to_envelope(id, {AREA_SQL})": V.grid_id_to_envelope("id", *AREA),
        "coord_to_quadrant(lon, lat)": V.coord_to_quadrant("lon", "lat"),
        "wgs84_coord_to_grid_id(lon, lat, 0.5, 0.5)": V.wgs84_coord_to_grid_id("lon", "lat", 0.5, 0.5),
        "grid_id_to_wgs84_coord(id, 0.5, 0.5)": V.grid_id_to_wgs84_coord("id", 0.5, 0.5),
        "grid_id_to_wgs84_envelope(id, 0.5, 0.5)": V.grid_id_to_wgs84_envelope("id", 0.5, 0.5),
        "gchain_trim_key(key, 1)": V.gchain_trim_key("key", 1),
        "gchain_segment(key, 2)": V.gchain_segment("key", 2),
        "datetime_keys_to_timestamp(20240229, 509)":
            V.datetime_keys_to_timestamp(F.lit(20240229), F.lit(509)),
        "date_id_to_timestamp(20240229)": V.date_id_to_timestamp(F.lit(20240229)),
        "time_id_to_timestamp(n)": V.time_id_to_timestamp("n"),
        "timestamp_to_date_id(time_id_to_timestamp(n))":
            V.timestamp_to_date_id(V.time_id_to_timestamp("n")),
        "timestamp_to_time_id(time_id_to_timestamp(n))":
            V.timestamp_to_time_id(V.time_id_to_timestamp("n")),
        "ts_to_temporal_part_key(time_id_to_timestamp(n))":
            V.ts_to_temporal_part_key(V.time_id_to_timestamp("n")),
        "minutes_since_midnight(time_id_to_timestamp(n))":
            V.minutes_since_midnight(V.time_id_to_timestamp("n")),
    }


@pytest.fixture(scope="module")
def df(spark):
    V.register_functions(spark)
    return spark.createDataFrame(ROWS, DDL).coalesce(1)


def test_both_forms_agree(df):
    both = pairs()
    sql = df.select(*[F.expr(s).cast("string").alias(f"c{n}") for n, s in enumerate(both)])
    col = df.select(*[c.cast("string").alias(f"c{n}") for n, c in enumerate(both.values())])
    left, right = sql.collect(), col.collect()
    for n, name in enumerate(both):
        a, b = [r[n] for r in left], [r[n] for r in right]
        assert a == b, name


def test_table_functions(spark, df):
    df.createOrReplaceTempView("rows_in")
    tiles = spark.sql("SELECT n, k.* FROM rows_in, LATERAL quadkey_to_zxy(q) k ORDER BY n").collect()
    assert [r.n for r in tiles] == [0, 2, 4, 5]  # empty and null keys give no row
    sums = spark.sql("SELECT n, c.* FROM rows_in, LATERAL imo_checksum(imo) c ORDER BY n").collect()
    assert [r.n for r in sums] == [0, 1, 4, 5] and (sums[0].check_digit, sums[0].comp_check_digit) == (9, 9)


def test_registering_by_name_brings_what_is_called(spark):
    assert V.register_functions(spark, ["grid_id_to_envelope"]) == [
        "grid_id_to_coord", "grid_id_to_envelope"
    ]


def test_functions_are_inlined(spark, df):
    plan = df.selectExpr("coord_to_grid_id(lon, lat, 0, 0, 180, 90, 0.5, 0.5) AS g")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "coord_to_grid_id(" not in text and "CASE WHEN" in text
