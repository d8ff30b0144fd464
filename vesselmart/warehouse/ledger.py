"""Load ledger: which source went into which table, when, and how it ended."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Warehouse


class LoadError(RuntimeError):
    """The source is already loaded, or a load broke a rule."""


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def good_loads(wh: Warehouse) -> DataFrame:
    """(src_id, dst_tbl) of loads that neither failed nor were deleted."""
    return wh.loads().filter("NOT failed AND NOT deleted").select("src_id", "dst_tbl").distinct()


def is_loaded(wh: Warehouse, src_id: str, dst_tbl: str) -> bool:
    wanted = (F.col("src_id") == src_id) & (F.col("dst_tbl") == dst_tbl)
    return not good_loads(wh).filter(wanted).isEmpty()


def not_loaded(wh: Warehouse, sources: DataFrame) -> DataFrame:
    """Rows of ``sources`` (src_id, dst_tbl, ...) without a good load."""
    return sources.join(good_loads(wh), ["src_id", "dst_tbl"], "left_anti")


def mark_deleted(wh: Warehouse, load_ids: Sequence[int]) -> None:
    """Hide the loads' rows, geometry included, and let their sources be loaded again.

    Members they brought into other dimensions stay, as later loads use them.
    """
    wh.log([{"kind": "delete", "load_id": i, "deleted": True} for i in load_ids])


class LoadScope:
    """Loads that begin, publish and fail together.

    Entering registers every (source, table) pair as failed until shown
    otherwise and opens a batch; leaving without an error publishes the batch
    and marks the loads good in one log entry. After an error the batch stays
    unpublished, so none of its rows are seen.
    """

    def __init__(self, wh: Warehouse, pairs: Sequence[tuple[str, str]]):
        self.wh = wh
        self.pairs = list(dict.fromkeys(pairs))  # loads are numbered in the order given
        self.batch_id = -1
        self.load_ids: dict[tuple[str, str], int] = {}
        self._ingest: list[dt.datetime | None] = [None, None]

    def __enter__(self) -> LoadScope:
        wanted = self.wh.spark.createDataFrame(self.pairs, "src_id string, dst_tbl string")
        done = wanted.join(good_loads(self.wh), ["src_id", "dst_tbl"], "left_semi").first()
        if done:
            raise LoadError(f'source "{done.src_id}" has already been loaded into {done.dst_tbl}')
        used = self.wh.events().agg(F.max("load_id").alias("load"), F.max("batch_id").alias("batch")).first()
        self.batch_id = self.wh.next_batch(used.batch or 0)
        first = (used.load or 0) + 1
        self.load_ids = {pair: n for n, pair in enumerate(self.pairs, first)}
        start = _now()
        self.wh.log(
            [
                {"kind": "register", "batch_id": self.batch_id, "load_id": n, "src_id": src,
                 "dst_tbl": dst, "start_ts": start, "failed": True, "deleted": False}
                for (src, dst), n in self.load_ids.items()
            ]
        )
        return self

    def load_map(self) -> DataFrame:
        """(src_id, dst_tbl, load_id) of the scope."""
        return self.wh.spark.createDataFrame(
            [(src, dst, n) for (src, dst), n in self.load_ids.items()],
            "src_id string, dst_tbl string, load_id bigint",
        )

    def ingest_started(self) -> None:
        self._ingest = [_now(), None]

    def ingest_stopped(self) -> None:
        """The end of ingest; rows per second follow from the counts when the scope closes."""
        self._ingest[1] = _now()

    def _counts(self) -> dict[int, int]:
        """Rows of the loads that wrote any: one entry a load, as the scope has itself."""
        parts = [
            self.wh.batch(dst, self.batch_id).select("load_id") for dst in sorted({dst for _, dst in self.pairs})
        ]
        written = reduce(DataFrame.unionAll, parts).groupBy("load_id").count()
        return {r["load_id"]: r["count"] for r in written.collect()}

    def __exit__(self, kind, error, trace) -> None:
        if error is None:
            self.wh.log(self._closing_entries())
        else:
            self.wh.log(
                [{"kind": "failure", "load_id": n, "end_ts": _now(), "no_rows": 0, "failed": True}
                 for n in self.load_ids.values()]
            )

    def _closing_entries(self) -> list[dict]:
        """What makes the batch visible, and each load's outcome."""
        start, stop = self._ingest
        seconds = (stop - start).total_seconds() if start and stop else None
        counts, end = self._counts(), _now()
        loads = [
            {"kind": "success", "load_id": n, "no_rows": counts.get(n, 0), "failed": False, "end_ts": end,
             "ingest_start_ts": start, "ingest_end_ts": stop,
             "ingest_per_sec": counts.get(n, 0) / seconds if seconds else None}
            for n in self.load_ids.values()
        ]
        publish = {"kind": "publish", "batch_id": self.batch_id}
        return [*loads, publish, *self.wh.written(self.batch_id)]
