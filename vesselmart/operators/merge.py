"""How a dimension takes in a batch: by smart key, by surrogate key, or insert only."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..warehouse.schema import TABLES
from ..warehouse.store import Warehouse
from .ids import NumberedRows, check_sequence, number_groups, number_rows
from .lookup import fits_broadcast, new_members, null_safe

if TYPE_CHECKING:
    from .dimension import Dimension


PARALLEL_ACTIONS = 10  # jobs the driver keeps in flight
#: Column that tells the first load of a batch that brings a candidate row.
FIRST_LOAD = "__first_load"


class KeyConflict(RuntimeError):
    """One key came with different attributes in the same load."""


def row_order(columns: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def _smallest_per(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """One row per key, the smallest; partial aggregation, no sort of the groups."""
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    # a struct orders nulls first
    winner = df.groupBy(*key).agg(F.min(F.struct(*rest)).alias("__row"))
    return winner.select(*key, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)


def first_wins(
    rows: DataFrame, existing: DataFrame, unique: list[tuple[str, ...]]
) -> DataFrame:
    """Rows an insert-or-ignore would take.

    A row is left out if any unique key is already in ``existing`` or in a row
    taken before it. (Null key parts do not conflict.) With one unique key the
    smallest row of each key is taken. With several, rows are gone through by
    their first load, if that is told, and then in the order of a digest, so that
    rivalries do not form long chains and a few rounds settle all of them.
    """
    columns = rows.columns
    if len(unique) == 1:
        fresh = rows.join(existing.select(*unique[0]), list(unique[0]), "left_anti")
        return _smallest_per(fresh.select(*columns), unique[0])

    def unclaimed(candidates: DataFrame, taken: DataFrame) -> DataFrame:
        for key in unique:
            candidates = candidates.join(taken.select(*key).distinct(), list(key), "left_anti")
        return candidates.select(*columns, "__turn")

    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    load = [FIRST_LOAD] if FIRST_LOAD in columns else []
    turn = F.struct(*load, F.md5(text).alias("digest"), *[c for c in columns if c not in load])
    left, counts = _written(unclaimed(rows.distinct().withColumn("__turn", turn), existing))
    taken: list[DataFrame] = []
    while counts["rows"]:
        # a row that is first under each of its keys meets no earlier rival
        ranked = left
        sure = F.lit(True)
        for n, key in enumerate(unique):
            best = left.groupBy(*[F.col(k).alias(f"__{n}{k}") for k in key]).agg(
                F.min("__turn").alias(f"__best{n}")
            )
            same = reduce(lambda a, b: a & b, (ranked[k] == best[f"__{n}{k}"] for k in key))
            ranked = ranked.join(best, same, "left")
            first = F.coalesce(F.col(f"__best{n}") == F.col("__turn"), F.lit(True))
            sure = sure & first
        judged, counts = _written(
            ranked.select(*columns, "__turn", sure.alias("__sure")), rows=F.count_if(~F.col("__sure"))
        )
        winners = judged.filter("__sure").drop("__sure")
        taken.append(winners.select(*columns))
        if counts["rows"]:
            left, counts = _written(unclaimed(judged.filter("NOT __sure").drop("__sure"), winners))
    return reduce(DataFrame.unionAll, taken) if taken else left.select(*columns)


def _written(df: DataFrame, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """The same rows from a table in the shared folder, so that no lineage builds up,
    and the given counts (default: ``rows``), as observed by the write."""
    path = scratch_dir(df.sparkSession, "rivals")
    counted = Observation()
    wanted = counts or {"rows": F.count(F.lit(1))}
    df.observe(counted, *[c.alias(n) for n, c in wanted.items()]).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), counted.get


def side_by_side(calls: Iterable[Callable[[], None]]) -> None:
    """Jobs the driver keeps in flight together."""
    with ThreadPoolExecutor(PARALLEL_ACTIONS) as pool:
        for job in [pool.submit(call) for call in calls]:
            job.result()


def _with_load(rows: DataFrame) -> DataFrame:
    """Rows that do not tell their first load count as one load."""
    return rows if FIRST_LOAD in rows.columns else rows.withColumn(FIRST_LOAD, F.lit(0).cast("bigint"))


def merge_smart(wh: Warehouse, batch_id: int, rows: DataFrame, dim: Dimension) -> None:
    """Insert rows whose smart key (and every other unique key) is new."""
    table = TABLES[dim.table]
    unique = [(table.primary,), *table.unique]
    # the earliest load first, as the smallest row is taken
    rows = _with_load(rows)
    rows = rows.select(FIRST_LOAD, *[c for c in rows.columns if c != FIRST_LOAD])
    fresh = first_wins(rows, wh.table(dim.table, batch_id), unique)
    wh.append(dim.table, fresh.drop(FIRST_LOAD), batch_id)


def merge_surrogate(wh: Warehouse, batch_id: int, rows: DataFrame, dim: Dimension) -> None:
    """Insert rows whose key is new under the next numbers, in key order.

    Existing rows are not changed. Nulls in a key match nulls. Of several sets of
    attributes for one key the one of the first load is taken, as if the loads
    came one by one; two sets in that load are an error.
    """
    table = TABLES[dim.table]
    known = wh.table(dim.table, batch_id)
    fresh = new_members(_with_load(rows), known, dim.keys).select(
        *dim.keys, *dim.attributes, FIRST_LOAD
    )
    if dim.attributes:
        first_load = fresh.groupBy(*[F.col(k).alias(f"__{k}") for k in dim.keys]).agg(
            F.min(FIRST_LOAD).alias("__least")
        )
        pairs = [(k, f"__{k}") for k in dim.keys]
        fresh = fresh.join(
            first_load, null_safe(fresh, first_load, pairs) & (F.col(FIRST_LOAD) == F.col("__least"))
        ).select(*dim.keys, *dim.attributes, FIRST_LOAD)
    # written before they are sorted, which reads its input twice
    fresh, counts = _written(fresh)
    if not counts["rows"]:
        return
    order = row_order([*dim.keys, *dim.attributes])
    first = wh.max_id(dim.table, including=batch_id) + 1
    numbered = number_rows(
        fresh, scratch_dir(wh.spark, dim.table), dim.surrogate, first, order, table.max_id
    )
    if dim.attributes:
        clash = numbered.rows.groupBy(*dim.keys).count().filter("count > 1").first()
        if clash:
            key = ", ".join(f"{k}={clash[k]}" for k in dim.keys)
            raise KeyConflict(f"{dim.table}: {clash['count']} attribute sets for {key}")
    wh.append(dim.table, numbered.rows.drop(FIRST_LOAD), batch_id, first + numbered.count - 1)


def merge_keys(wh: Warehouse, batch_id: int, offered: DataFrame, dims: Sequence[Dimension]) -> None:
    """Take new members into several dimensions of one key each, in one pass.

    ``offered`` has rows (dimension, value), the key as text. The outcome is that of
    :func:`merge_surrogate` or :func:`merge_smart` on each, but keys of all
    dimensions are matched, and those that get numbers sorted, together.
    """
    known = reduce(
        DataFrame.unionAll,
        (
            wh.table(d.table, batch_id).select(
                F.lit(d.table).alias("__dimension"), F.col(d.keys[0]).cast("string").alias("__value")
            )
            for d in dims
        ),
    )
    if fits_broadcast(wh.spark, sum(wh.bytes(d.table, batch_id) for d in dims)):
        known = F.broadcast(known)
    rows = offered.select("dimension", "value").distinct()
    pairs = [("dimension", "__dimension"), ("value", "__value")]
    fresh, counts = _written(
        rows.join(known, null_safe(rows, known, pairs), "left_anti"),
        **{d.table: F.count_if(F.col("dimension") == d.table) for d in dims},
    )
    grown = [d for d in dims if counts[d.table]]
    first = {d.table: wh.max_id(d.table, including=batch_id) + 1 for d in grown if d.surrogate}
    for name, start in first.items():
        check_sequence(start, counts[name], TABLES[name].max_id)

    def derived(dim: Dimension) -> None:
        kind = TABLES[dim.table].schema[dim.keys[0]].dataType
        keys = fresh.filter(F.col("dimension") == dim.table).select(F.col("value").cast(kind).alias(dim.keys[0]))
        wh.append(dim.table, dim.process(keys, dim.names({})).select(*dim.columns), batch_id)

    def texts() -> None:
        numbered = number_groups(
            fresh.filter(F.col("dimension").isin(*first)), scratch_dir(wh.spark, "keys"), "dimension",
            row_order(["value"]), "id", first,
        )

        def write(dim: Dimension) -> None:
            mine = numbered.filter(F.col("dimension") == dim.table).select(
                F.col("id").alias(dim.surrogate), F.col("value").alias(dim.keys[0])
            )
            wh.append(dim.table, mine, batch_id, first[dim.table] + counts[dim.table] - 1)

        side_by_side(partial(write, d) for d in grown if d.surrogate)

    side_by_side([*([texts] if first else []), *(partial(derived, d) for d in grown if not d.surrogate)])


def insert_surrogate(
    wh: Warehouse, batch_id: int, numbered: NumberedRows, dim: Dimension, first_row: int
) -> tuple[DataFrame, int]:
    """Insert every row of a numbered batch under a new surrogate.

    The surrogate is the row's own number moved to the end of the sequence, so
    nothing is matched or joined back. Returns the batch with the surrogate, and
    the first surrogate.
    """
    table = TABLES[dim.table]
    first = wh.max_id(dim.table, including=batch_id) + 1
    check_sequence(first, numbered.count, table.max_id)
    rows = numbered.rows.withColumn(
        dim.surrogate, F.col(dim.keys[0]) - F.lit(first_row) + F.lit(first)
    )
    processed = dim.process(rows, dim.names({}))
    if numbered.count:
        wh.append(dim.table, processed, batch_id, first + numbered.count - 1)
    return rows, first
