"""Ids, look-ups, merges and shapes on small fixtures, against brute force."""

import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vesselmart.operators import dimension as dims
from vesselmart.operators import geometry
from vesselmart.operators.geometry import centroid, hull_ring, simplify_line
from vesselmart.operators.ids import SequenceOverflow, number_rows
from vesselmart.operators.expanders import expand_time_ids
from vesselmart.operators.lookup import HOT_KEYS, broadcast_limit, fits_broadcast, lookup
from vesselmart.operators.merge import KeyConflict, first_wins
from vesselmart.session import scratch_dir
from vesselmart.sources import wkb
from vesselmart.warehouse import Warehouse


def test_numbering_follows_the_order(spark):
    df = spark.range(1000).repartition(7).select((999 - F.col("id")).alias("k"))
    out = number_rows(df, scratch_dir(spark, "t"), "id", 11, [F.col("k")])
    assert out.count == 1000
    assert [tuple(r) for r in out.rows.orderBy("k").select("k", "id").collect()] == [
        (k, k + 11) for k in range(1000)
    ]


def test_numbering_without_order_is_dense_and_does_not_shuffle(spark):
    df = spark.range(1000, numPartitions=7).filter("id % 3 = 0")
    out = number_rows(df, scratch_dir(spark, "t"), "n")
    assert sorted(r.n for r in out.rows.collect()) == list(range(1, 335))
    plan = out.rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SinglePartition" not in plan
    assert number_rows(df.limit(0), scratch_dir(spark, "t"), "n").count == 0


def test_sequence_end(spark):
    df = spark.range(10)
    assert number_rows(df, scratch_dir(spark, "t"), "n", 91, max_id=100).count == 10
    with pytest.raises(SequenceOverflow):
        number_rows(df, scratch_dir(spark, "t"), "n", 92, max_id=100)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_of_hot_and_null_keys(spark, how):
    """Half of the rows under one key and a third under null, with and without broadcast."""
    rows = spark.range(6000, numPartitions=4).select(
        "id", F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 3 != 0, F.col("id") % 997).alias("a"),
        F.when(F.col("id") % 5 != 0, "x").alias("b"),
    )
    dim = spark.createDataFrame(
        [(n, a, b) for n, (a, b) in enumerate((a, b) for a in [None, *range(900)] for b in ("x", None))],
        "v bigint, k1 bigint, k2 string",
    )
    keys = {"a": "k1", "b": "k2"}
    known = {(d.k1, d.k2): d.v for d in dim.collect()}
    want = {r.id: known.get((r.a, r.b)) for r in rows.collect()}
    if how == "inner":
        want = {k: v for k, v in want.items() if v is not None}
    for size in (0, 1 << 60):
        out = lookup(
            rows, dim, keys, "v", "found", dim_bytes=size, row_id="id", how=how
        )
        assert {r.id: r.found for r in out.collect()} == want
        assert out.columns == ["id", "a", "b", "found"]


def _far(spark, rows, key, counted=None):
    """A look-up of ``key`` in a dimension beyond the broadcast limit that lacks key 7."""
    dim = spark.range(900).filter("id <> 7").select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    return lookup(
        rows, dim, {key: "k"}, "v", f"found_{key}", dim_bytes=1 << 60, row_id="id", counted=counted
    )


def test_salt_is_part_of_the_partitioning(spark):
    rows = spark.range(1000).withColumn("a", F.col("id") % 9)
    plan = _far(spark, rows, "a")._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "__salt" in line]
    assert exchanges and "SortMergeJoin" in plan


def test_hot_key_spreads_though_the_dimension_lacks_it(spark):
    rows = spark.range(20_000).withColumn("a", F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 900))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        sizes = sorted(
            r["count"] for r in _far(spark, rows, "a").groupBy(F.spark_partition_id()).count().collect()
        )
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]


def test_chain_of_lookups_grows_linearly(spark):
    base = spark.range(100).selectExpr("id", *[f"id % {n + 3} AS c{n}" for n in range(5)])
    joins, rows = [], base
    for n in range(5):
        rows = _far(spark, rows, f"c{n}", counted=base)
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        joins.append(plan.count("Join "))
    steps = {b - a for a, b in zip(joins, joins[1:])}
    assert len(steps) == 1


def test_impossible_time_of_day(spark):
    df = spark.createDataFrame([(996199,)], "time_id bigint")
    with pytest.raises(Exception):
        expand_time_ids(df, {"time_id": "time_id"}).collect()


def test_hot_keys_are_few_by_construction(spark):
    assert HOT_KEYS <= 1024
    assert broadcast_limit(spark) == 10 << 20
    assert fits_broadcast(spark, 2 << 20) and not fits_broadcast(spark, 3 << 20)


def test_first_wins_is_a_greedy_choice(spark):
    """No two taken rows share a key, none is already there, and none could be added."""
    rng = random.Random(7)
    data = [(rng.randrange(40), rng.randrange(35), rng.randrange(30), n % 9) for n in range(300)]
    data.append((5, None, None, 1))
    there = [(1, 2, 3, 0)]
    ddl = "a int, b int, c int, d int"
    unique = [("a",), ("b", "c"), ("c",)]
    taken = [
        tuple(r) for r in first_wins(
            spark.createDataFrame(data, ddl), spark.createDataFrame(there, ddl), unique
        ).collect()
    ]

    def clash(p, q):
        keys = [((p[0],), (q[0],)), ((p[1], p[2]), (q[1], q[2])), ((p[2],), (q[2],))]
        return any(None not in u and u == v for u, v in keys)

    assert not any(clash(p, q) for n, p in enumerate(taken) for q in [*taken[:n], *there])
    assert all(any(clash(p, q) for q in [*taken, *there]) for p in set(data) - set(taken))


def test_first_wins_one_key_takes_the_smallest(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (2, "z"), (3, "q")], "k int, v string")
    there = spark.createDataFrame([(3, "old")], "k int, v string")
    assert sorted(map(tuple, first_wins(df, there, [("k",)]).collect())) == [(1, "a"), (2, None)]


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse.create(spark, scratch_dir(spark, "wh"))


VESSELS = "mmsi bigint, imo bigint, mid int, radio_service_type string, is_valid_mmsi boolean, " \
    "is_valid_imo boolean, in_eu_mrv_db boolean"


def _load(wh, rows, dim, roles=({},)):
    batch = wh.next_batch()
    dims.load_dimension(wh, batch, rows, dim, roles)
    wh.publish(batch)


def test_surrogate_merge(spark, wh):
    rows = [(2, None, 1, "ship", True, False, None), (1, 5, 1, "ship", True, True, True)]
    df = spark.createDataFrame(rows, VESSELS)
    _load(wh, df.unionAll(df), dims.VESSEL)
    assert [(r.vessel_id, r.mmsi) for r in wh.table("vessel_dim").orderBy("vessel_id").collect()] == [(1, 1), (2, 2)]
    # the same keys add nothing, also the null one, and nothing is changed
    changed = df.withColumn("mid", F.lit(9)).unionAll(
        spark.createDataFrame([(2, 7, 1, "ship", True, True, None)], VESSELS)
    )
    _load(wh, changed, dims.VESSEL)
    got = wh.table("vessel_dim").orderBy("vessel_id").collect()
    assert [(r.vessel_id, r.mmsi, r.imo, r.mid) for r in got] == [(1, 1, 5, 1), (2, 2, None, 1), (3, 2, 7, 1)]
    found = dims.attach_surrogate(wh, None, changed, dims.VESSEL, {}, row_id="mmsi")
    assert sorted((r.mmsi, r.imo or 0, r.vessel_id) for r in found.collect()) == [(1, 5, 1), (2, 0, 2), (2, 7, 3)]


@pytest.mark.parametrize("imo", [77, None])
def test_one_key_with_two_attribute_sets(spark, wh, imo):
    rows = [(99, imo, 1, "ship", True, True, None), (99, imo, 2, "ship", True, True, None)]
    with pytest.raises(KeyConflict, match="mmsi=99"):
        dims.load_dimension(wh, wh.next_batch(), spark.createDataFrame(rows, VESSELS), dims.VESSEL)
    assert wh.table("vessel_dim").filter("mmsi = 99").isEmpty()


def test_null_in_a_required_column(spark, wh):
    df = spark.createDataFrame([(None,), ("b",)], "vessel_name string")
    with pytest.raises(Exception, match="vessel_name must not be null"):
        dims.load_dimension(wh, wh.next_batch(), df, dims.VESSEL_NAME)


def test_float_keys(spark, wh):
    names = dims.VESSEL_CONFIG.keys
    ddl = ", ".join(f"{c} float" for c in names)
    rest = [1.0] * 10
    data = [(None, 0.0, *rest), (None, -0.0, *rest), (None, float("nan"), *rest), (0.1, 0.0, *rest)]
    df = spark.createDataFrame(data, ddl)
    for _ in range(2):
        _load(wh, df, dims.VESSEL_CONFIG)
    assert wh.count("vessel_config_dim") == 3
    found = dims.attach_surrogate(wh, None, df, dims.VESSEL_CONFIG, {}, row_id="length")
    assert found.filter("vessel_config_id IS NULL").isEmpty() and found.count() == 4


def test_roles_share_a_dimension(spark, wh):
    df = spark.createDataFrame([(1, "A", "B"), (2, "B", "unknown")], "n int, s string, e string")
    roles = [{"org_msg": "s", "destination_id": "s_id"}, {"org_msg": "e", "destination_id": "e_id"}]
    _load(wh, df, dims.DESTINATION, roles)
    for role in roles:
        df = dims.attach_surrogate(wh, None, df, dims.DESTINATION, role, row_id="n")
    assert sorted(map(tuple, df.collect())) == [(1, "A", "B", 2, 3), (2, "B", "unknown", 3, 1)]


def test_own_processor_and_strategy(spark, wh):
    seen = []

    def upper(batch, names):
        return batch.withColumn(names["nav_status"], F.upper(names["nav_status"]))

    def only_long(warehouse, batch_id, rows, dim):
        seen.append(dim.table)
        dims.merge_surrogate(warehouse, batch_id, rows.filter(F.length("nav_status") > 3), dim)

    dim = dims.Dimension(
        "nav_status_dim", ["nav_status"], [], "nav_status_id", (upper,), only_long
    )
    _load(wh, spark.createDataFrame([("moored",), ("x",)], "status string"), dim, [{"nav_status": "status"}])
    assert seen == ["nav_status_dim"]
    assert {r.nav_status for r in wh.table("nav_status_dim").collect()} == {"unknown", "MOORED"}


# -- shapes ------------------------------------------------------------------


@pytest.fixture(scope="module")
def jts(spark):
    jvm = spark._jvm
    try:
        jvm.org.locationtech.jts.geom.GeometryFactory()
    except TypeError:
        pytest.skip("no JTS at hand")
    return jvm


def _lines(count, seed=3):
    rng = np.random.default_rng(seed)
    out = []
    for n in range(count):
        size = int(rng.integers(2, 40))
        if n % 3 == 0:  # a wandering track
            pts = np.cumsum(rng.normal(0, 0.05, (size, 2)), axis=0)
        elif n % 3 == 1:  # scattered points, many crossings
            pts = rng.random((size, 2))
        else:  # points on a coarse lattice: repeats and collinear runs
            pts = rng.integers(0, 5, (size, 2)) / 20.0
        out.append(pts.astype(float))
    return out


def _jts_line(jvm, gw, pts):
    coords = gw.new_array(jvm.org.locationtech.jts.geom.Coordinate, len(pts))
    for n, (x, y) in enumerate(pts):
        coords[n] = jvm.org.locationtech.jts.geom.Coordinate(float(x), float(y))
    return jvm.org.locationtech.jts.geom.GeometryFactory().createLineString(coords)


def _points(geometry):
    return [(c.getX(), c.getY()) for c in geometry.getCoordinates()]


def test_shapes_against_jts(spark, jts):
    gw = spark.sparkContext._gateway
    lines = _lines(90)
    df = spark.createDataFrame(
        [(n, [(float(x), float(y)) for x, y in pts]) for n, pts in enumerate(lines)],
        "n int, line array<struct<x: double, y: double>>",
    )
    centres = {r.n: r.c for r in df.select("n", centroid("line").alias("c")).collect()}
    for n, pts in enumerate(lines):
        line = _jts_line(jts, gw, pts)
        c = line.getCentroid()
        assert centres[n].x == pytest.approx(c.getX(), abs=1e-9), n
        assert centres[n].y == pytest.approx(c.getY(), abs=1e-9), n
        assert {tuple(p) for p in hull_ring(pts).tolist()} == set(_points(line.convexHull())), n
        kept = [tuple(p) for p in simplify_line(pts, 0.1).tolist()]
        simplifier = jts.org.locationtech.jts.simplify.TopologyPreservingSimplifier
        assert kept == _points(simplifier.simplify(line, 0.1)), n


def test_degenerate_lines():
    same = np.array([[1.0, 1.0]] * 3)
    assert hull_ring(same).tolist() == [[1.0, 1.0]]
    straight = np.array([[0.0, 0.0], [1.0, 1.0], [2.0, 2.0]])
    assert hull_ring(straight).tolist() == [[0.0, 0.0], [2.0, 2.0]]
    assert simplify_line(straight, 0.1).tolist() == [[0.0, 0.0], [2.0, 2.0]]


def test_wkb_both_byte_orders(spark):
    import struct

    little = struct.pack("<BII4d", 1, 2, 2, 1.5, 2.5, 3.5, 4.5)
    big = struct.pack(">BII4d", 0, 2, 2, 1.5, 2.5, 3.5, 4.5)
    tagged = struct.pack("<BIII4d", 1, 2 | 0x20000000, 4326, 2, 1.5, 2.5, 3.5, 4.5)
    point = struct.pack("<BI2d", 1, 1, 9.0, 8.0)
    df = spark.createDataFrame(
        [(bytearray(b) if b else None,) for b in (little, big, tagged, None)], "b binary"
    ).coalesce(1)
    got = [r[0] for r in df.select(wkb.wkb_to_line("b")).collect()]
    assert got[3] is None
    assert [[tuple(p) for p in line] for line in got[:3]] == [[(1.5, 2.5), (3.5, 4.5)]] * 3
    points = spark.createDataFrame([(bytearray(point),)], "b binary").select(wkb.wkb_to_point("b"))
    assert tuple(points.first()[0]) == (9.0, 8.0)
    with pytest.raises(Exception, match="linestring"):
        bad = spark.createDataFrame([(bytearray(struct.pack("<BII", 1, 3, 0)),)], "b binary")
        bad.select(wkb.wkb_to_line("b")).collect()


@pytest.mark.parametrize("scale", [1.0, 0.1, 1e-7, 1e-200])
def test_hull_is_that_of_exact_numbers(scale):
    draw = np.random.default_rng(5)
    for n in (3, 8, 100, 700):
        pts = draw.integers(-9, 9, (n, 2)) * scale
        exact = {tuple(p): (Fraction(p[0]), Fraction(p[1])) for p in pts.tolist()}

        def chain(order, exact=exact):
            out = []
            for p in order:
                while len(out) > 1:
                    (ax, ay), (bx, by), (px, py) = exact[out[-2]], exact[out[-1]], exact[p]
                    if (bx - ax) * (py - ay) > (by - ay) * (px - ax):
                        break
                    out.pop()
                out.append(p)
            return out[:-1]

        ring = chain(sorted(exact)) + chain(sorted(exact, reverse=True))
        got = [tuple(p) for p in hull_ring(pts).tolist()]
        assert got == (ring + ring[:1] if len(ring) > 2 else ring)
    with pytest.raises(ValueError):
        hull_ring(np.array([[0.0, 0.0], [1.0, np.nan], [2.0, 5.0]]))


def _simplified_plainly(pts, tolerance):
    """The same sections, each tested against every other segment."""
    line, flat, kept, todo = set(range(len(pts) - 1)), [], [0], [(0, len(pts) - 1)]
    while todo:
        i, j = todo.pop()
        away = geometry._distances(pts[i + 1:j], pts[i], pts[j]) if j > i + 1 else np.zeros(1)
        if j == i + 1:
            kept.append(j)
            continue
        others = [(k, k + 1) for k in sorted(line - set(range(i, j)))] + flat
        ends = np.array(others, int).reshape(-1, 2)
        if away.max() <= tolerance and not geometry._interior_hit(pts[i], pts[j], pts[ends[:, 0]], pts[ends[:, 1]]):
            line -= set(range(i, j))
            flat.append((i, j))
            kept.append(j)
        else:
            middle = i + 1 + int(away.argmax())
            todo += [(middle, j), (i, middle)]
    return pts[kept]


def test_simplification_of_long_lines(monkeypatch):
    rng = np.random.default_rng(8)
    angle = np.linspace(0, 40, 900)
    lines = [
        np.cumsum(rng.normal(0, 0.05, (900, 2)), axis=0),
        np.cumsum(rng.normal(0, 0.005, (900, 2)), axis=0),
        rng.integers(0, 40, (500, 2)) / 20.0,
        np.stack([np.cos(angle), np.sin(angle)], axis=1) * angle[:, None] / 20,  # a spiral, turns close together
        np.repeat([[0.0, 0.0], [1.0, 1.0]], 200, axis=0),
    ]
    for n, pts in enumerate(lines):
        want = _simplified_plainly(pts, 0.1).tolist()
        for few in (-1, 24, 10_000):
            with monkeypatch.context() as patch:
                patch.setattr(geometry, "_FEW", few)
                assert simplify_line(pts, 0.1).tolist() == want, (n, few)


def test_wkb_buffers():
    import struct

    kind = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
    lines = pa.array([[{"x": 1.0, "y": 2.0}, {"x": 3.0, "y": 4.0}], None, [], [{"x": -1.5, "y": 0.0}]], kind)
    for part in (lines, lines.slice(1), lines.slice(2, 1), lines.slice(1, 1), lines.slice(4)):
        made = wkb._encoder(wkb.WKB_LINE)(part)
        want = [None if v is None else [(p["x"], p["y"]) for p in v] for v in part.to_pylist()]
        assert made.to_pylist() == [
            None if v is None else struct.pack("<BII", 1, 2, len(v)) + b"".join(struct.pack("<2d", *p) for p in v)
            for v in want
        ]
        sizes, points, null = wkb._decoded(made)
        assert sizes.tolist() == [len(v or ()) for v in want] and null.tolist() == [v is None for v in want]
        assert [tuple(p) for p in points.tolist()] == [p for v in want for p in v or ()]
    big = struct.pack(">BIII4d", 0, 2 | 0x20000000, 4326, 2, 1, 2, 3, 4)
    behind = struct.pack("<BI2d", 1, 1, 5, 6) + b"more"
    sizes, points, _ = wkb._decoded(pa.array([big, None, behind, big], pa.binary()))
    assert sizes.tolist() == [2, 0, 1, 2] and points.ravel().tolist() == [1, 2, 3, 4, 5, 6, 1, 2, 3, 4]
    for short in (b"", b"\x01\x02", struct.pack("<BI", 1, 2), big[:-1], struct.pack("<BII", 1, 2, 4_000_000_000)):
        with pytest.raises(ValueError):
            wkb._decoded(pa.array([big, short], pa.binary()))


def test_first_load_of_a_key_counts(spark, wh):
    rows = [
        (501, None, 2, "ship", True, True, None, 9), (501, None, 1, "ship", True, True, None, 8),
        (501, None, 3, "ship", True, True, None, 9), (502, 6, 4, "ship", True, True, None, 9),
    ]
    _load(wh, spark.createDataFrame(rows, VESSELS + ", load_id bigint"), dims.VESSEL)
    got = wh.table("vessel_dim").filter("mmsi > 500").orderBy("mmsi").collect()
    assert [(r.mmsi, r.mid) for r in got] == [(501, 1), (502, 4)]
    with pytest.raises(KeyConflict, match="mmsi=503"):
        rows = [(503, 1, m, "ship", True, True, None, load) for m, load in ((1, 7), (2, 7), (3, 8))]
        dims.load_dimension(
            wh, wh.next_batch(), spark.createDataFrame(rows, VESSELS + ", load_id bigint"), dims.VESSEL
        )


def test_short_lines_are_simplified_without_arrays(monkeypatch):
    rng = np.random.default_rng(5)
    lines = [rng.integers(0, 6, (n, 2)).astype(float) for n in range(3, 33)]
    lines += [np.cumsum(rng.normal(0, 0.05, (n, 2)), axis=0) for n in range(3, 33)]
    lines += [np.column_stack([x := np.round(rng.normal(0, 1, 12), 1), x / 2]) for _ in range(5)]
    with monkeypatch.context() as patch:
        patch.setattr(geometry, "_SHORT", 0)
        patch.setattr(geometry, "_NEAR", 0)
        want = [simplify_line(pts, 0.1).tolist() for pts in lines]
    with monkeypatch.context() as patch:
        patch.setattr(geometry, "_distances", None)
        patch.setattr(geometry, "_Segments", None)
        assert [simplify_line(pts, 0.1).tolist() for pts in lines] == want


def _reports(spark, folder, rows):
    from datetime import datetime

    data = [(e, datetime(2024, 1, d, 5), u, "view", v, "{}") for e, d, u, v in rows]
    kinds = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(data, kinds).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_objects_group_report_ids_only(spark, tmp_path):
    from vesselmart.samples import objects

    folder = _reports(spark, tmp_path, [
        (9, 1, 4, 2.5), (3, 2, 4, 7.25), (3, 2, 4, 7.25), (1200, 3, 4, 0.5),
        (None, 1, 7, 1.0), (None, 2, 7, 3.0), (5, 1, None, 1.0), (6, 1, None, 2.0),
    ])
    made = objects(spark, folder)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "collect_list(event_id" in plan and "collect_list(struct" not in plan
    got = {r.mmsi: r for r in made.collect()}

    def place(user, event):
        return 8.0 + user % 40 / 10.0 + event * 7919 % 1000 / 10000.0, 54.0 + user % 30 / 10.0 + event * 104729 % 1000 / 10000.0

    assert [tuple(p) for p in got[219000004].geom] == [place(4, e) for e in (3, 3, 9, 1200)]
    assert [tuple(p) for p in got[219000007].geom] == [(None, None)] * 2
    assert [tuple(p) for p in got[None].geom] == [(None, None)] * 2
    assert (str(got[219000004].sog_max), str(got[219000004].sog_min), str(got[219000004].sog_avg)) == ("7.2", "0.5", "4.3")


def test_files_of_every_kind_come_from_several_tasks(spark, tmp_path, monkeypatch):
    from vesselmart.catalog import QUERIES, loads

    folder = _reports(spark, tmp_path, [(e, 1 + e % 28, e % 9, e / 4) for e in range(900)])
    offered = []
    asked = loads.conformance
    monkeypatch.setattr(loads, "conformance", lambda spark, paths: offered.extend(paths) or asked(spark, paths))
    held = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a file a task
    try:
        got = QUERIES["file_conformance"](spark, folder).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.files.openCostInBytes", held)
    assert len([p for p in offered if "/_set aside/" in p]) > 1
    assert {(r.folder, r.compatible, r.missing, r.hidden) for r in got} == {
        ("as it should be", True, 0, False), ("50%20 off+more", True, 0, False), ("lacks two", False, 2, False),
        ("no table", False, 79, False), ("other name", False, 79, False), ("_set aside", True, 0, True),
    }
