"""Loads end to end: files, ledger, failures, upkeep, arrivals."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vesselmart.functions import int_to_quadkey
from vesselmart.operators.audit import audit
from vesselmart.plans import loaders
from vesselmart.plans.maintenance import compact
from vesselmart.plans.reports import batch_report, ingest_rate
from vesselmart.plans.views import register_views, vessel_activity
from vesselmart.samples import objects, write_object_files
from vesselmart.session import scratch_dir
from vesselmart.sources import trajectories
from vesselmart.sources.tables import ingest, read_quadkey, to_tmp_table
from vesselmart.sources.trajectories import conformance, is_traj_file, list_files
from vesselmart.sources.wkb import line_to_wkb, point_to_wkb
from vesselmart.streaming.arrivals import load_arrivals
from vesselmart.warehouse import LoadError, LoadScope, Warehouse
from vesselmart.warehouse.ledger import is_loaded, mark_deleted
from vesselmart.warehouse.schema import TABLES


@pytest.fixture(scope="module")
def files(spark, sf_dir):
    early, late = write_object_files(spark, sf_dir, scratch_dir(spark, "objects"))
    return tuple(
        next(p for p in list_files(spark, f) if p.endswith(".parquet")) for f in (early, late)
    )


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse.create(spark, scratch_dir(spark, "wh"))


def test_new_warehouse(spark, wh):
    again = Warehouse.create(spark, wh.root)  # nothing is written twice
    assert again.count("traj_state_change_dim") == 8 and again.count("country_dim") == 1
    assert again.count("ais_traj_fact") == 0 and again.max_id("vessel_dim") == 0
    assert again.table("depth_grid_dim").first().x == 4294967295
    assert all(set(again.table(n).columns) == set(TABLES[n].columns) for n in TABLES)


def test_file_check(spark, files, sf_dir):
    few = scratch_dir(spark, "few")
    spark.range(3).coalesce(1).write.parquet(few)
    other = f"{sf_dir}/events.parquet"
    found = {
        r.path: r for r in conformance(spark, [files[0], other, f"{sf_dir}/notes.txt"]).collect()
    }
    assert found[files[0]].compatible and not found[files[0]].missing
    assert not found[other].compatible and "mmsi" in found[other].missing
    assert not found[f"{sf_dir}/notes.txt"].compatible
    assert is_traj_file(spark, files[1])


def test_failed_load_leaves_nothing_and_can_be_retried(spark, wh, files, sf_dir):
    def fail():
        raise RuntimeError("stop here")

    with pytest.raises(RuntimeError, match="stop here"):
        loaders.load(wh, [files[0]], before_publish=fail)
    assert [(r.failed, r.deleted) for r in wh.loads().collect()] == [(True, False)] * 2
    assert wh.count("ais_traj_fact") == 0 and wh.count("traj_geom_dim") == 0
    assert wh.count("vessel_dim") == 0
    other = f"{sf_dir}/events.parquet"
    name = files[0].rsplit("/", 1)[1]
    assert loaders.load(wh, [files[0], other]) == [name]
    want = objects(spark, sf_dir).filter("week < 3").groupBy("type").count().collect()
    want = {r["type"]: r["count"] for r in want}
    assert wh.count("ais_traj_fact") == wh.count("traj_geom_dim") == want["in motion"]
    assert wh.count("ais_stop_fact") == wh.count("stop_geom_dim") == want["stationary"]
    assert is_loaded(wh, name, "ais_stop_fact") and not is_loaded(wh, "x", "ais_stop_fact")


def test_second_load_goes_on_where_the_first_ended(spark, wh, files):
    before = wh.count("ais_traj_fact")
    assert len(loaders.load(wh, files)) == 1  # the first file is known
    ids = wh.table("ais_traj_fact").agg(
        F.min("ais_traj_id"), F.max("ais_traj_id"), F.countDistinct("ais_traj_id"),
        F.countDistinct("geom_id"), F.count("*"),
    ).first()
    assert ids[0] == 1 and ids[1] == ids[2] == ids[3] == ids[4] > before
    assert loaders.load(wh, files) == []
    good = wh.loads().filter("NOT failed")
    assert good.count() == 4 and good.filter("end_ts IS NULL OR ingest_per_sec IS NULL").isEmpty()
    assert good.agg(F.sum("no_rows")).first()[0] == ids[4] + wh.count("ais_stop_fact")
    with pytest.raises(LoadError, match="already been loaded"):
        with LoadScope(wh, [(files[0].rsplit("/", 1)[1], "ais_traj_fact")]):
            pass


def test_reports_and_views(spark, wh):
    rates = ingest_rate(wh).collect()
    assert len(rates) == 4 and all(r.seconds > 0 for r in rates)
    last = wh.events().agg(F.max("batch_id")).first()[0]
    report = {r.table_name: r.inserted for r in batch_report(wh, last).collect()}
    assert report["ais_traj_fact"] == report["traj_geom_dim"]
    view = vessel_activity(wh)
    total = wh.count("ais_traj_fact") + wh.count("ais_stop_fact")
    assert view.count() == total and "ais_traj_id" not in view.columns
    register_views(wh)
    assert spark.sql("SELECT count(DISTINCT traj_type) AS n FROM vessel_activity").first().n == 2
    assert spark.sql("SELECT count(*) AS n FROM load_dim WHERE NOT failed").first().n == 4


def test_loaded_tables_keep_their_rules(wh):
    for name in ("vessel_dim", "country_dim", "stop_geom_dim", "ais_stop_fact"):
        assert audit(wh.table(name), name).filter("violations > 0").isEmpty(), name


def test_fact_plans(spark, wh):
    """No one-task step, and small dimensions are broadcast."""
    rows = wh.table("ais_traj_fact")
    vessels = loaders.attach_surrogate(
        wh, None, rows.select("ais_traj_id", F.concat(F.lit("type "), F.col("vessel_id") % 5).alias("vessel_type")), loaders.dims.VESSEL_TYPE,
        {"vessel_type_id": "found"}, row_id="ais_traj_id",
    )
    text = vessels._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SinglePartition" not in text
    seen = wh.table("ais_traj_fact").filter("vessel_id = 3").select("ais_traj_id")
    text = seen._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(vessel_id), EqualTo(vessel_id,3)]" in text
    assert "ReadSchema: struct<ais_traj_id:bigint,vessel_id:bigint>" in text


def test_deleted_load_is_hidden_and_its_file_can_come_again(wh, files):
    total = wh.count("ais_stop_fact")
    name = files[1].rsplit("/", 1)[1]
    row = wh.loads().filter(
        (F.col("src_id") == name) & (F.col("dst_tbl") == "ais_stop_fact") & ~F.col("failed")
    ).first()
    mark_deleted(wh, [row.load_id])
    assert wh.count("ais_stop_fact") == total - row.no_rows
    assert loaders.load(wh, files) == [name]
    assert wh.count("ais_stop_fact") == total


def test_compaction_keeps_the_rows(spark, wh):
    before = wh.table("ais_traj_fact")
    old = sorted(map(str, before.collect()))
    assert compact(wh, "ais_traj_fact") > 0
    assert len(wh.paths("ais_traj_fact")) == 1
    assert sorted(map(str, wh.table("ais_traj_fact").collect())) == old
    assert compact(wh, "ais_traj_fact") == -1
    assert wh.max_id("ais_traj_fact", "ais_traj_id") == len(old)


def test_arrivals_with_binary_geometry(spark, sf_dir):
    """Files in a folder, their geometry as well-known binary and whole numbers as int."""
    folder, check = scratch_dir(spark, "in"), scratch_dir(spark, "check")
    rows = objects(spark, sf_dir).drop("week").withColumns(
        {"geom": line_to_wkb("geom"), "start_point": point_to_wkb("start_point"),
         "end_point": point_to_wkb("end_point"), "no_points": F.col("no_points").cast("int"),
         "extra": F.lit(1)}
    )
    rows.coalesce(1).write.parquet(folder)
    wh = Warehouse.create(spark, scratch_dir(spark, "wh"))
    for _ in range(2):
        load_arrivals(wh, folder, check).awaitTermination()
    want = objects(spark, sf_dir).filter("type = 'in motion'")
    got = wh.table("traj_geom_dim")
    assert got.count() == want.count() == wh.count("ais_traj_fact")
    assert got.select("geom").exceptAll(want.select("geom")).isEmpty()


def test_point_fact_layout(spark, sf_dir):
    from vesselmart.catalog.warehouses import point_warehouse

    points = point_warehouse(spark, sf_dir).table("ais_point_fact")
    rarest = points.groupBy("spatial_part_key").count().orderBy("count", "spatial_part_key").first()
    key = spark.range(1).select(int_to_quadkey(F.lit(rarest.spatial_part_key), F.lit(8))).first()[0]
    some = read_quadkey(points, key)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(spatial_part_key" in plan
    assert some.count() == rarest['count'] < points.count()


def test_ingest_modes(spark):
    path = scratch_dir(spark, "t")
    df = spark.range(100, numPartitions=1)
    with pytest.raises(Exception):
        ingest(df, path, "append")
    ingest(df, path, "create", row_bytes=8, file_bytes=80)
    assert len([p for p in list_files(spark, path) if p.endswith(".parquet")]) == 10
    with pytest.raises(Exception):
        ingest(df, path, "create")
    ingest(df.limit(0), path, "append")
    ingest(df, path, "create_append")
    assert spark.read.parquet(path).count() == 200
    ingest(df, path, "replace")
    to_tmp_table(spark.read.parquet(path), "t_ingested")
    assert spark.table("t_ingested").count() == 100


def test_geometry_goes_with_its_load_and_ids_are_not_given_twice(spark, wh, files):
    geometries, last = wh.count("stop_geom_dim"), wh.max_id("stop_geom_dim")
    name = files[0].rsplit("/", 1)[1]
    row = wh.loads().filter(
        (F.col("src_id") == name) & (F.col("dst_tbl") == "ais_stop_fact") & ~F.col("failed") & ~F.col("deleted")
    ).first()
    mark_deleted(wh, [row.load_id])
    assert wh.count("stop_geom_dim") == geometries - row.no_rows
    assert wh.max_id("stop_geom_dim") == last and wh.max_id("ais_stop_fact", "ais_stop_id") >= last
    assert loaders.load(wh, files) == [name]
    assert wh.count("stop_geom_dim") == geometries == wh.count("ais_stop_fact")
    assert wh.max_id("stop_geom_dim") == last + row.no_rows
    assert "load_id" not in wh.table("stop_geom_dim").columns
    # the log tells as much as the tables would
    fresh = Warehouse(spark, wh.root)
    for table in ("vessel_dim", "call_sign_dim", "traj_geom_dim"):
        top = fresh.read_files(table, fresh.paths(table)).agg(F.max(TABLES[table].primary)).first()[0]
        assert fresh.max_id(table) == top


def test_a_table_whose_batches_do_not_tell_ids_is_scanned(spark):
    wh = Warehouse.create(spark, scratch_dir(spark, "wh"))
    batch = wh.next_batch()
    wh.append("half_degree_grid_dim", spark.createDataFrame([(41, "a")], "half_degree_cell_id bigint, gst_cell_id string"), batch)
    assert wh.max_id("half_degree_grid_dim") == 0
    wh.publish(batch)
    assert wh.max_id("half_degree_grid_dim") == 41


def test_a_load_that_repeats_a_key_stays_unpublished(spark, files, monkeypatch):
    wh = Warehouse.create(spark, scratch_dir(spark, "wh"))

    def careless(wh, batch_id, rows, dim):
        """A strategy of one's own that does not look at what is there."""
        again = rows.limit(1).unionAll(rows.limit(1))
        wh.append(dim.table, again.withColumn(dim.surrogate, F.lit(1)), batch_id)

    dims = loaders.dims
    own = dims.Dimension("vessel_config_dim", dims.VESSEL_CONFIG.keys, [], "vessel_config_id", (), careless)
    roles = tuple((own if d is dims.VESSEL_CONFIG else d, r) for d, r in loaders.ROLES)
    monkeypatch.setattr(loaders, "ROLES", roles)
    with pytest.raises(Exception, match="not unique|must not be null"):
        loaders.load(wh, [files[0]])
    assert wh.count("ais_traj_fact") == 0 and wh.count("vessel_config_dim") == 0


def test_skipped_files_are_told(spark, files, sf_dir):
    wh = Warehouse.create(spark, scratch_dir(spark, "wh"))
    other = f"{sf_dir}/events.parquet"
    done = loaders.load(wh, [files[0], other, f"{sf_dir}/none.txt"])
    reasons = dict(done.skipped)
    assert set(reasons) == {other, f"{sf_dir}/none.txt"} and reasons[other].startswith("lacks")
    assert dict(loaders.load(wh, files).skipped) == {files[0]: "is loaded already"}


def test_a_store_that_tasks_cannot_open_is_asked_through_spark(spark, files):
    odd = files[0].replace("file:", "viewfs:", 1)
    (batch,) = list(trajectories._footers([pa.RecordBatch.from_arrays([pa.array([files[0], odd])], ["path"])]))
    assert batch.column(3).to_pylist() == [False, True]
    asked = trajectories._asked(spark, [files[0]]).first()
    assert set(asked.names) == set(batch.column(1).to_pylist()[0])
