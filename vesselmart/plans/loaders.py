"""Loading trajectory files into the two object facts.

All files of a call go through as one batch: one scan stages the rows of both
facts, each dimension takes in its new members from both, then each fact is
looked up and written, and one log entry makes all of it visible.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dimension as dims
from ..operators.audit import repeated_keys
from ..operators.dimension import Dimension, Names, attach_surrogate, load_dimension, load_keys
from ..operators.ids import number_files
from ..operators.merge import insert_surrogate, side_by_side
from ..session import scratch_dir
from ..sources.trajectories import conformance, file_name, list_files, read_trajectories
from ..warehouse import files
from ..warehouse.ledger import LoadError, LoadScope, not_loaded
from ..warehouse.schema import TABLES
from ..warehouse.store import Warehouse

logger = logging.getLogger(__name__)

MAX_FILES = 20_000  # files per batch; a call with more goes through in several batches


@dataclass(frozen=True)
class ObjectFact:
    """A fact over one type of object."""

    table: str
    key: str
    object_type: str
    geometry: Dimension


TRAJ_FACT = ObjectFact("ais_traj_fact", "ais_traj_id", "in motion", dims.TRAJ_GEOM)
STOP_FACT = ObjectFact("ais_stop_fact", "ais_stop_id", "stationary", dims.STOP_GEOM)
FACTS = (TRAJ_FACT, STOP_FACT)

DATE_ROLES = ({"date_id": "start_date_id"}, {"date_id": "end_date_id"})
TIME_ROLES = ({"time_id": "start_time_id"}, {"time_id": "end_time_id"})
PREV_TYPE = {"traj_type": "prev_obj_type", "traj_type_id": "prev_obj_type_id"}
DESTINATIONS = (
    {"org_msg": "start_destination_msg", "destination_id": "start_destination_id"},
    {"org_msg": "end_destination_msg", "destination_id": "end_destination_id"},
)
# Every dimension with the roles it plays; smart-key ones have nothing to look up.
ROLES: tuple[tuple[Dimension, tuple[Names, ...]], ...] = (
    (dims.DATE, DATE_ROLES),
    (dims.TIME, TIME_ROLES),
    (dims.COUNTRY, ({},)),
    (dims.VESSEL_CONFIG, ({},)),
    (dims.TRAJ_TYPE, (PREV_TYPE,)),
    (dims.STATE_CHANGE, ({},)),
    (dims.TRANSPONDER_TYPE, ({},)),
    (dims.POS_TYPE, ({},)),
    (dims.VESSEL_NAME, ({},)),
    (dims.VESSEL_TYPE, ({},)),
    (dims.VESSEL, ({},)),
    (dims.CALL_SIGN, ({},)),
    (dims.CARGO_TYPE, ({},)),
    (dims.DESTINATION, DESTINATIONS),
)
RENAMED = {"dist_meter_prev_obj": "meters_to_prev_obj", "dist_sec_prev_obj": "seconds_to_prev_obj"}


def with_load(batch: DataFrame, load_map: DataFrame, facts: Sequence[ObjectFact]) -> DataFrame:
    """Keep the facts' object types, add each row's load, default the previous type.

    Rows of a (source, fact) pair that is not in the load map fall away. The map
    has one row per pair and a batch takes at most ``MAX_FILES`` files, so it is
    broadcast and the wide batch is not shuffled.
    """
    targets = F.create_map(
        *[F.lit(v) for f in facts for v in (f.object_type, f.table)]
    )
    types = [f.object_type for f in facts]
    return (
        batch.filter(F.col("type").isin(*types))
        .withColumn("dst_tbl", targets[F.col("type")])
        .join(F.broadcast(load_map), ["src_id", "dst_tbl"])
        .withColumn("prev_obj_type", F.coalesce("prev_obj_type", F.lit("unknown")))
    )


def stage(batch: DataFrame, path: str) -> None:
    """Write the batch once, by fact; no shuffle."""
    batch.write.partitionBy("dst_tbl").parquet(path)


def project_fact(rows: DataFrame, fact: ObjectFact) -> DataFrame:
    """The fact's columns in order, from the names the batch gives them."""
    computed = {"prev_obj_id": F.lit(None)}
    return rows.select(
        *[
            computed.get(f.name, F.col(RENAMED.get(f.name, f.name))).cast(f.dataType).alias(f.name)
            for f in TABLES[fact.table].schema
        ]
    )


def load_dimensions(wh: Warehouse, batch_id: int, batch: DataFrame) -> None:
    """Take new members into every dimension; independent ones run side by side.

    Those of a single key go through together.
    """
    side_by_side(_dimension_loads(wh, batch_id, batch))


def _dimension_loads(wh: Warehouse, batch_id: int, batch: DataFrame) -> list[Callable[[], None]]:
    single = [(dim, roles) for dim, roles in ROLES if dim.is_text or dim.is_derived]
    rest = [(dim, roles) for dim, roles in ROLES if not (dim.is_text or dim.is_derived)]
    return [
        partial(load_keys, wh, batch_id, batch, single),
        *(partial(load_dimension, wh, batch_id, batch, dim, roles) for dim, roles in rest),
    ]


Members = dict[str, tuple[DataFrame, int]]


def open_members(wh: Warehouse, batch_id: int) -> Members:
    """Rows and bytes of every dimension that is looked up, opened once for all facts."""
    tables = [dim.table for dim, _ in ROLES if dim.surrogate]
    return {t: (wh.table(t, batch_id), wh.bytes(t, batch_id)) for t in tables}


def attach_all(
    wh: Warehouse, batch_id: int, rows: DataFrame, row_id: str, members: Members | None = None
) -> DataFrame:
    """All surrogates; hot keys are told from the rows as they come in."""
    counted = rows
    members = members or open_members(wh, batch_id)
    for dim, roles in ROLES:
        if dim.surrogate:
            for role in roles:
                rows = attach_surrogate(
                    wh, batch_id, rows, dim, role, row_id=row_id, counted=counted,
                    members=members[dim.table],
                )
    return rows


def load_fact(
    wh: Warehouse, batch_id: int, rows: DataFrame, fact: ObjectFact, first: int, count: int,
    members: Members | None = None,
) -> None:
    """Look-ups and the fact itself for ``count`` rows that are numbered from ``first`` on."""
    # geometry is in its own table by now and is not carried through the joins
    facts = project_fact(attach_all(wh, batch_id, rows, fact.key, members), fact)
    written = wh.append(fact.table, facts, batch_id, first + count - 1 if count else None)
    if written != count:
        raise LoadError(f"{fact.table}: {count} rows came in, {written} were written")


def load_batch(
    wh: Warehouse, scope: LoadScope, batch: DataFrame, facts: Sequence[ObjectFact] = FACTS,
    before_publish: Callable[[], None] | None = None,
) -> None:
    """Load a batch of objects (with ``src_id``) inside an open scope."""
    spark = wh.spark
    path = scratch_dir(spark, "staged")
    stage(with_load(batch, scope.load_map(), facts), path)
    scope.ingest_started()
    present = {p.rsplit("dst_tbl=", 1)[1] for p, is_dir, _ in files.children(spark, path) if is_dir}
    facts = [f for f in facts if f.table in present]
    if facts:
        staged = spark.read.parquet(path)
        schema = staged.drop("dst_tbl").schema
        numbered: dict[str, tuple[DataFrame, int, int]] = {}

        def geometry(fact: ObjectFact) -> None:
            first = wh.max_id(fact.table, fact.key) + 1
            found = number_files(spark, f"{path}/dst_tbl={fact.table}", schema, fact.key, first)
            rows, _ = insert_surrogate(wh, scope.batch_id, found, fact.geometry, first)
            numbered[fact.table] = rows, first, found.count

        # geometry needs no dimension, and facts need all of both
        side_by_side(
            [*(partial(geometry, f) for f in facts), *_dimension_loads(wh, scope.batch_id, staged)]
        )
        members = open_members(wh, scope.batch_id)
        side_by_side(
            partial(load_fact, wh, scope.batch_id, rows, fact, first, count, members)
            for fact in facts for rows, first, count in [numbered[fact.table]]
        )
    broken = repeated_keys(wh, scope.batch_id)
    if broken:
        raise LoadError("; ".join(f"{t}: {n} keys are not unique: {rule}" for t, rule, n in broken))
    if before_publish:
        before_publish()
    scope.ingest_stopped()


class Loaded(list):
    """Names of the files loaded; ``skipped`` has (path, reason) of the others."""

    def __init__(self, names: Iterable[str], skipped: Iterable[tuple[str, str]]):
        super().__init__(names)
        self.skipped = list(skipped)


def load(
    wh: Warehouse, paths: Iterable[str], facts: Sequence[ObjectFact] = FACTS,
    before_publish: Callable[[], None] | None = None,
) -> Loaded:
    """Load the files that qualify and are not yet loaded; returns their names.

    A file counts by its name: of several with one name only the first is loaded.
    Per fact, a file is skipped if the ledger has a good load of it. Files that
    are left out altogether are told with the reason. A call is one batch, but for
    one of more than ``MAX_FILES`` files, whose batches are published one by one.
    """
    paths = list(paths)
    judged = conformance(wh.spark, paths)
    reason = F.when(~F.col("compatible"), F.concat(F.lit("lacks "), F.array_join("missing", ", "))).when(
        F.col("hidden"), F.lit("has a name that is passed over when reading")
    )
    unfit = judged.withColumn("reason", reason).filter("reason IS NOT NULL").select("path", "reason")
    skipped = {r.path: r.reason for r in unfit.collect()}  # a row a file at most
    named = (
        judged.filter("compatible AND NOT hidden")
        .withColumn("src_id", file_name(F.col("path")))
        .withColumn("dst_tbl", F.explode(F.array(*[F.lit(f.table) for f in facts])))
    )
    # one row per file and fact; a read needs the paths on the driver anyway
    todo = not_loaded(wh, named).select("path", "form", "src_id", "dst_tbl").collect()
    order = {p: n for n, p in enumerate(paths)}
    by_name: dict[str, str] = {}
    for row in todo:
        by_name[row.src_id] = min(by_name.get(row.src_id, row.path), row.path, key=order.get)
    for row in todo:
        if row.path != by_name[row.src_id]:
            skipped[row.path] = f"has the name of {by_name[row.src_id]}"
    todo = [r for r in todo if r.path == by_name[r.src_id]]
    taken = set(by_name.values())
    for path in paths:
        if path not in skipped and path not in taken:
            skipped[path] = "is loaded already"
    for path, why in skipped.items():
        logger.warning("%s skipped: it %s", path, why)
    names = sorted(by_name, key=lambda n: order[by_name[n]])
    turn = {f.table: n for n, f in enumerate(facts)}
    todo.sort(key=lambda r: (order[r.path], turn[r.dst_tbl]))
    for at in range(0, len(names), MAX_FILES):
        chunk = set(names[at : at + MAX_FILES])
        # loads are numbered in this order, which settles who comes first
        rows = [r for r in todo if r.src_id in chunk]
        groups: dict[str, set[str]] = {}
        for row in rows:
            groups.setdefault(row.form, set()).add(row.path)
        batch = read_trajectories(wh.spark, [sorted(g) for _, g in sorted(groups.items())])
        with LoadScope(wh, [(r.src_id, r.dst_tbl) for r in rows]) as scope:
            load_batch(wh, scope, batch, facts, before_publish)
    return Loaded(sorted(names), skipped.items())


def load_dir(wh: Warehouse, folder: str, facts: Sequence[ObjectFact] = FACTS) -> Loaded:
    """Load every qualifying file of a folder."""
    return load(wh, list_files(wh.spark, folder), facts)
