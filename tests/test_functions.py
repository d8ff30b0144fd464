"""Key functions on literal rows: published examples and edges."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from vesselmart import functions as V

NAN, INF = math.nan, math.inf


def rows(spark, data, ddl, *columns):
    df = spark.createDataFrame(data, ddl).coalesce(1)
    return [tuple(r) for r in df.select(*columns).collect()]


GRID = "x double, y double, x0 double, y0 double, x1 double, y1 double, w double, h double"
BOUNDS = ("x0", "y0", "x1", "y1", "w", "h")


def test_coord_to_grid_id(spark):
    cases = [
        ((0, 0, 0, 0, 15, 15, 1, 1), 0),
        ((15, 15, 0, 0, 16, 16, 1, 1), 255),
        ((15, 0, 0, 0, 15, 15, 1, 1), -1),
        ((16, 1, 1, 1, 17, 17, 1, 1), 15),
        ((3, 0, 0, 0, 4, 4, 0.5, 0.5), 6),
        ((3.49, 0, 0, 0, 4, 4, 0.5, 0.5), 6),
        ((3.5, 0, 0, 0, 4, 4, 0.5, 0.5), 7),
        ((4, 0, 0, 0, 4, 4, 0.5, 0.5), -1),
        ((180, 0, 0, 0, 180, 90, 0.5, 0.5), -1),
        ((11.477506637573242, 57.86309814453125, 0, 0, 180, 90, 0.5, 0.5), 41422),
        ((16.4549617767334, 56.233604431152344, 0, 0, 180, 90, 0.5, 0.5), 40352),
        ((INF, 1, 0, 0, 4, 4, 1, 1), -1),
        ((1, -INF, 0, 0, 4, 4, 1, 1), -1),
        ((NAN, 1, 0, 0, 4, 4, 1, 1), -1),
        ((None, 1, 0, 0, 4, 4, 1, 1), None),
        ((None, 9, 0, 0, 4, 4, 1, 1), -1),
    ]
    data = [tuple(None if v is None else float(v) for v in c) for c, _ in cases]
    got = rows(
        spark, data, GRID, V.coord_to_grid_id("x", "y", *BOUNDS), V.coord_to_gid("x", "y", *BOUNDS),
        V.point_to_grid_id(F.struct("x", "y"), *BOUNDS),
    )
    assert [g[0] for g in got] == [e for _, e in cases]
    assert [g[2] for g in got] == [e for _, e in cases]
    # the other form has no answer where a coordinate is missing or not finite
    assert [g[1] for g in got] == [e for _, e in cases[:11]] + [None] * 5


def test_wgs84_coord_to_grid_id(spark):
    cases = [
        ((180.0, 0.0), 200000),
        ((179.9, 0.0), 100359),
        ((11.477506637573242, 57.86309814453125), 141422),
        ((16.4549617767334, 56.233604431152344), 140352),
        ((-72.37855529785156, 46.40056610107422), 233335),
        ((-3.7664780616760254, 58.71392822265625), 242472),
        ((-165.11976623535156, -66.2571792602539), 316949),
        ((14.283212661743164, -84.89945220947266), 403628),
        ((10.0, 90.0), -1),
        ((None, 10.0), None),
    ]
    got = rows(
        spark, [c for c, _ in cases], "lon double, lat double",
        V.wgs84_coord_to_grid_id("lon", "lat", 0.5, 0.5),
    )
    assert [g[0] for g in got] == [e for _, e in cases]


def test_grid_id_to_coord(spark):
    area = (1599625, 762675, 6567875, 6743925, 1000, 1000)
    data = [(16411067,), (17692581,), (-1,), (4968 * 5981,), (None,)]
    c = V.grid_id_to_coord("id", *area)
    got = rows(spark, data, "id bigint", c["x"], c["y"], V.box_wkt(V.grid_id_to_envelope("id", *area)))
    assert [g[:2] for g in got] == [
        (3362625, 4065675), (3132625, 4323675), (None, None), (None, None), (None, None)
    ]
    assert got[0][2].startswith("POLYGON ((") and got[2][2] == "POLYGON EMPTY"


def test_wgs84_corner_and_envelope(spark):
    data = [(141422,), (200000,), (403628,), (541422,), (199999,), (5,)]
    c = V.grid_id_to_wgs84_coord("id", 0.5, 0.5)
    e = V.grid_id_to_wgs84_envelope("id", 0.5, 0.5)
    got = rows(spark, data, "id bigint", c["x"], c["y"], e.isNull())
    assert got[:3] == [(11.0, 57.5, False), (-180.0, 0.0, False), (14.0, -85.0, False)]
    assert [g[2] for g in got[3:]] == [True] * 3
    back = V.wgs84_coord_to_grid_id(c["x"] + 0.25, c["y"] + 0.25, 0.5, 0.5)
    assert [r[0] for r in rows(spark, data[:3], "id bigint", back)] == [141422, 200000, 403628]


def test_sizes_are_checked_when_the_plan_is_built():
    with pytest.raises(ValueError):
        V.coord_to_grid_id(F.lit(1), F.lit(1), 0, 0, 1, 1, 0, 1)
    with pytest.raises(ValueError):
        V.wgs84_coord_to_grid_id(F.lit(1), F.lit(1), 0.1, 0.1)  # ids would overlap
    for base in (1, 50, 2000, 0.1):
        with pytest.raises(ValueError):
            V.to_gchain_key(F.lit(1), F.lit(1), 0, 0, 1, 1, base)


def test_gchain_trim_key(spark):
    cases = [
        ((1112233, 2), 11122),
        ((1010203, 2), 10102),
        ((1010203, 1), 101),
        ((1010203, 3), 1010203),
        ((10102030405060708, 5), 10102030405),
        ((1010203, 7), 1010203),
        ((1010203, 0), 1),
    ]
    got = rows(
        spark, [c for c, _ in cases], "key bigint, lvl int", V.gchain_trim_key("key", "lvl")
    )
    assert [g[0] for g in got] == [e for _, e in cases]


def test_gchain_segments_and_bounds(spark):
    got = rows(spark, [(1336884,), (1,), (16884,)], "key bigint", V.segment_gchain_key("key"))
    assert [g[0] for g in got] == [[33, 68, 84], [], [68, 84]]
    area = (1599625, 762675, 6567875, 6743925)
    b = V.gchain_key_to_bounds("key", F.lit(17692581), *area, 1000)
    (got,) = rows(spark, [(16884,)], "key bigint", b)
    assert tuple(got[0]) == (17692581, 16884, 3133465, 4324355, 3133475, 4324365)
    fixed = V.gchain_key_to_bounds("key", F.lit(17692581), *area, 1000, depth=2)
    assert rows(spark, [(16884,)], "key bigint", fixed)[0][0] == got[0]
    mixed = rows(spark, [(1,), (168,), (1688412,)], "key bigint", b["x_min"], b["x_max"])
    assert mixed == [(3132625, 3133625), (3133425, 3133525), (3133467, 3133468)]
    with pytest.raises(Exception, match="2 levels deep"):
        rows(spark, [(168,)], "key bigint", fixed)
    # the point in the middle of those bounds has that key again
    key = V.to_gchain_key(F.lit(3133470), F.lit(4324360), *area, 1000)
    assert rows(spark, [(1,)], "one int", key)[0][0] == 16884


def test_gchain_key_edges(spark):
    data = [(5.0, 5.0), (NAN, 5.0), (INF, 5.0), (None, 5.0), (-1.0, 5.0), (1e7, 5.0)]
    key = V.to_gchain_key("x", "y", 0, 0, 10000, 10000, 1000)
    shallow = V.to_gchain_key("x", "y", 0, 0, 10000, 10000, 10)
    deep = V.to_gchain_key("x", "y", 0, 0, 1000000, 1000000, 1000000)
    got = rows(spark, data, "x double, y double", key, shallow, deep)
    assert [g[0] for g in got] == [10000, -1, -1, -1, -1, -1]
    assert got[0][1] == 1 and got[0][2] == 10000000000


def test_gchain_depth_guard(spark):
    one = spark.createDataFrame([(10203,), (16884,)], "key bigint")
    assert one.agg(V.assert_one_depth("key")).first()[0] == 2
    mixed = one.unionAll(spark.createDataFrame([(1336884,)], "key bigint"))
    with pytest.raises(Exception, match="differ in depth"):
        mixed.agg(V.assert_one_depth("key")).collect()
    assert one.limit(0).agg(V.assert_one_depth("key")).first()[0] is None


QUADKEYS = [
    ((-14146, 8), "30202332"),
    ((-14148, 8), "30202330"),
    ((14547, 8), "03203103"),
    ((13805, 8), "03113231"),
    ((25847, 8), "12103313"),
    ((16384, 8), "10000000"),
    ((14197, 8), "03131311"),
    ((-13821, 8), "30220003"),
    ((-13792, 8), "30220200"),
    ((13808, 8), "03113300"),
]


def test_int_to_quadkey(spark):
    data = [c for c, _ in QUADKEYS]
    got = rows(
        spark, data, "v bigint, z int", V.int_to_quadkey("v", "z"), V.int_to_quadkey_bytes("v", "z")
    )
    assert got == [(e, e) for _, e in QUADKEYS]
    back = rows(spark, [(e,) for _, e in QUADKEYS], "q string", V.quadkey_int16_encode("q"))
    assert [b[0] for b in back] == [v for (v, _), _ in QUADKEYS]


def test_quadkey_widths(spark):
    data = [("11",), ("",), (None,), ("1x1",), ("3" * 8,)]
    got = rows(
        spark, data, "q string", V.quadkey_bit_encode("q"), V.quadkey_int16_encode("q"),
        V.quadkey_uint16_encode("q"), V.quadkey_int32_encode("q"),
        # other characters are skipped by the encoders and refused here
        V.quadkey_to_int(F.when(F.col("q") != "1x1", F.col("q"))),
    )
    assert got[0] == ("0101", 5, 5, 5, 5)
    assert got[1] == (None, None, None, None, 0)
    assert got[2] == (None, None, None, None, None)
    assert got[3][:4] == ("0101", 5, 5, 5)
    assert got[4] == ("1" * 16, -1, 65535, 65535, 65535)
    full = rows(
        spark, [("3" * 32,), ("2" + "0" * 31,)], "q string", V.quadkey_int64_encode("q"),
        V.quadkey_uint64_encode("q"),
    )
    assert full == [(-1, 2**64 - 1), (-(2**63), 2**63)]
    for encode in (V.quadkey_int16_encode, V.quadkey_uint16_encode):
        with pytest.raises(Exception, match="does not fit 16 bits"):
            rows(spark, [("0" * 9,)], "q string", encode("q"))


def test_quadkey_tiles(spark):
    cases = [
        ("12020110022002023100", (20, 548876, 329304)),
        ("12002330212211211001", (20, 550105, 322336)),
    ]
    t = V.quadkey_to_zxy("q")
    got = rows(spark, [(q,) for q, _ in cases], "q string", t["z"], t["x"], t["y"])
    assert got == [e for _, e in cases]
    back = rows(
        spark, [e for _, e in cases] + [(0, 5, 7), (33, 2**33 - 1, 0)], "z int, x bigint, y bigint",
        V.zxy_to_quadkey("z", "x", "y"),
    )
    assert [b[0] for b in back] == [*(q for q, _ in cases), "", "1" * 33]
    assert rows(spark, [("",)], "q string", V.quadkey_to_zxy("q"))[0][0] is None


def test_get_zxy(spark):
    data = [(10.046, 56.054), (10.467, 56.237), (0.0, -90.0)]
    t = V.get_zxy("lon", "lat", F.lit(15))
    got = rows(spark, data, "lon double, lat double", t["z"], t["x"], t["y"])
    assert got[:2] == [(15, 17298, 10194), (15, 17336, 10165)]


def test_quadkey_ranges(spark):
    data = [("12",), ("12020110022002023100",), ("",), ("12020110",)]
    r = V.compute_qkey_range("q")
    got = rows(spark, data, "q string", r["lo"], r["hi"])
    whole = int("12020110", 4)
    assert got == [
        (int("12000000", 4), int("12333333", 4)), (whole, whole), (0, 4**8 - 1), (whole, whole)
    ]


def test_value_too_large_for_its_bytes(spark):
    with pytest.raises(Exception, match="does not fit"):
        rows(spark, [(200, 4)], "v bigint, z int", V.int_to_quadkey_bytes("v", "z"))
    assert rows(spark, [(5, 3)], "v bigint, z int", V.int_to_quadkey_bytes("v", "z"))[0][0] == "0011"


def test_time_keys(spark):
    ts = dt.datetime(2024, 2, 29, 0, 5, 9, 999)
    got = rows(
        spark, [(ts,)], "ts timestamp_ntz", V.timestamp_to_date_id("ts"),
        V.timestamp_to_time_id("ts"), V.minutes_since_midnight("ts"),
        V.ts_to_temporal_part_key("ts"),
    )
    assert got == [(20240229, 509, 5, 202402)]
    times = rows(
        spark, [(0,), (509,), (235959,)], "t bigint", V.time_id_to_timestamp("t"),
        V.datetime_keys_to_timestamp(F.lit(20240229), "t"),
    )
    assert times[1] == (dt.datetime(1900, 1, 1, 0, 5, 9), dt.datetime(2024, 2, 29, 0, 5, 9))
    assert times[2][0] == dt.datetime(1900, 1, 1, 23, 59, 59)
    with pytest.raises(Exception):
        rows(spark, [(20230229,)], "d bigint", V.date_id_to_timestamp("d"))


def test_mmsi(spark):
    cases = [
        (219000000, True, "ship", 219),
        (2190001, True, "unknown", 219),
        (2191000, True, "cost station", 219),
        (2195000, True, "ais base station", 219),
        (21900001, True, "ship group", 219),
        (111219500, True, "helicopter", 219),
        (992196001, True, "virtual ais aton", 219),
        (982190001, True, "deployable child craft", 219),
        (821900001, True, "handheld vhf transceiver with dsc and integral gnss receiver", 219),
        (970123456, True, "ais-sart", None),
        (979123456, True, "amrd group b", None),
        (973123456, True, "unknown", None),
        (100000000, True, "unknown", None),
        (2190000001, False, "ship", 219),
        (0, True, "unknown", 0),
        (None, None, "unknown", None),
    ]
    got = rows(
        spark, [(c[0],) for c in cases], "m bigint", "m", V.is_valid_mmsi("m"),
        V.mmsi_to_radio_service_type("m"), V.mmsi_to_mid("m"),
    )
    assert got == cases


def test_imo(spark):
    data = [(9074729,), (9074728,), (907472,), (90747290,), (None,), (1000000,)]
    got = rows(spark, data, "i bigint", V.is_valid_imo("i"))
    assert [g[0] for g in got] == [True, False, False, False, False, False]


def test_modulo(spark):
    data = [(7.0, 3.0), (-7.0, 3.0), (7.0, -3.0), (None, 3.0)]
    got = rows(spark, data, "a double, b double", V.modulo("a", "b"))
    assert [g[0] for g in got] == [1.0, 2.0, -2.0, None]


@pytest.mark.parametrize("bad", ["1239", "12x3", "a", "1 2"])
def test_a_key_with_other_characters_is_an_error(spark, bad):
    df = spark.createDataFrame([(bad,)], "q string")
    for column in (V.quadkey_to_int("q"), V.compute_qkey_range("q")["lo"]):
        with pytest.raises(Exception, match="not a quadkey"):
            df.select(column).collect()


def test_no_digits_at_depth_zero(spark):
    row = spark.range(1).select(
        V.int_to_quadkey(F.lit(5), F.lit(0)).alias("a"), V.quadkey_to_int(F.lit("")).alias("b")
    ).first()
    assert (row.a, row.b) == (None, 0)


def test_whole_number_modulo_is_exact(spark):
    pairs = [(2**62 + 1, 7), (-(2**62) - 1, 7), (5, -3), (-5, 3), (6, 3), (-6, -4), (0, 5)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = [r.m for r in df.select(V.modulo_int("a", "b").alias("m")).collect()]
    assert got == [a % b for a, b in pairs]


def test_modulo_of_whole_numbers_beyond_64_bits(spark, tmp_path):
    from vesselmart.catalog import QUERIES

    parts = [0, 1000, 2024, 2025, 19999, 7_200_000]
    data = [(k, n, p, 4 + n) for k, p in enumerate(parts) for n in (1, 2)]
    kinds = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint"
    spark.createDataFrame(data, kinds).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {(r.l_orderkey, r.l_linenumber): r.m_int for r in QUERIES["floor_modulo"](spark, str(tmp_path)).collect()}
    assert got == {
        (k, n): (p - 1000) * (2**53 + 1) % (7 if s % 2 == 0 else -7) for k, n, p, s in data
    }


def test_chain_key_grows_with_its_levels(spark):
    df = spark.range(1)
    sizes = []
    for levels in range(1, 10):
        key = V.to_gchain_key(F.lit(5.0), F.lit(7.0), 0, 0, 1e12, 1e12, 10 ** (levels + 1))
        sizes.append(len(df.select(key)._jdf.queryExecution().analyzed().toString()))
    steps = [b - a for a, b in zip(sizes, sizes[1:])]
    assert max(steps) <= 1.5 * min(steps)
    with pytest.raises(ValueError, match="room for 9 levels"):
        V.to_gchain_key(F.lit(5.0), F.lit(7.0), 0, 0, 1e12, 1e12, 10**11)
