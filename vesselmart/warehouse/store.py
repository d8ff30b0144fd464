"""Parquet tables that become visible batch by batch.

Layout below the root: ``events/`` is the append-only log, ``<table>/batch=<n>/``
holds what one batch added. A table's visible rows are those of published
batches, so a load either shows up whole, when its one closing log entry is
written, or not at all. One writer at a time is assumed.

The entry that publishes a batch also tells, for each table, how many rows it
got, in what time and up to which id. So ids go on from the log: the tables are
not read for them, and no id is given out twice, whatever is deleted later.
"""

from __future__ import annotations

import datetime as dt
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import files
from .schema import EVENTS, LOAD_DIM, TABLES, Table

SEED_BATCH = 0


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._log: tuple[set[int], dict[str, set[int]], bool] | None = None
        self._last_ids: dict[str, int] | None = None
        self._written: dict[int, list[dict]] = {}  # what was written into batches not yet published

    @classmethod
    def create(cls, spark: SparkSession, root: str) -> Warehouse:
        """Open the warehouse, first writing the unknown members if it is new."""
        wh = cls(spark, root)
        if not files.exists(spark, f"{wh.root}/events"):
            seeded = [t for t in TABLES.values() if t.seeds]
            with ThreadPoolExecutor(len(seeded)) as pool:
                list(pool.map(wh._seed, seeded))
            wh.publish(SEED_BATCH)
        return wh

    def _seed(self, table: Table) -> None:
        ids = [s[0] for s in table.seeds if isinstance(s[0], int)]
        self.append(table.name, self.seed_rows(table), SEED_BATCH, last_id=max(ids, default=None))

    def seed_rows(self, table: Table) -> DataFrame:
        fields = {f.name: f for f in table.schema}
        rows = [tuple(dict(zip(table.seed_columns, s)).get(c) for c in fields) for s in table.seeds]
        return self.spark.createDataFrame(rows, table.schema).coalesce(1)

    # -- log -----------------------------------------------------------------

    def events(self) -> DataFrame:
        return self.spark.read.schema(EVENTS.schema).parquet(f"{self.root}/events")

    def log(self, entries: list[dict]) -> None:
        """Append entries that the driver knows."""
        self.log_frame(
            self.spark.createDataFrame(
                [tuple(e.get(f) for f in EVENTS.columns) for e in entries], EVENTS.schema
            )
        )

    def log_frame(self, entries: DataFrame) -> None:
        """Append entries as one file; they take effect together."""
        have = set(entries.columns)
        entries = entries.select(
            *[
                (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in EVENTS.schema
            ]
        ).withColumn("seq", F.lit(time.time_ns()))
        entries.coalesce(1).write.mode("append").parquet(f"{self.root}/events")
        self.refresh()

    def refresh(self) -> None:
        """Look at the log again; needed only when another process has written."""
        self._log = self._last_ids = None

    def _published(self) -> tuple[set[int], dict[str, set[int]], bool]:
        if self._log is None:
            marks = self.events().filter("kind IN ('publish', 'compact', 'delete')").select(
                "kind", "batch_id", "table_name", "replaces"
            ).collect()  # one row per batch
            replaced: dict[str, set[int]] = {}
            for m in marks:
                if m.kind == "compact":
                    replaced.setdefault(m.table_name, set()).update(m.replaces)
            published = {m.batch_id for m in marks if m.kind != "delete"}
            self._log = published, replaced, any(m.kind == "delete" for m in marks)
        return self._log

    def next_batch(self, used: int | None = None) -> int:
        """A batch number nothing has been written under, also not by a failed load;
        ``used`` is the last one in the log, if known."""
        if used is None:
            used = self.events().agg(F.max("batch_id")).first()[0] or 0
        for path, is_dir, _ in files.children(self.spark, self.root):
            if is_dir and not path.endswith("/events"):
                used = max([used, *(n for n, _ in self._batches(path))])
        return used + 1

    def publish(self, batch_id: int) -> None:
        self.log([{"kind": "publish", "batch_id": batch_id}, *self.written(batch_id)])

    def written(self, batch_id: int) -> list[dict]:
        """Log entries on what this session wrote into a batch, a row for each write."""
        return self._written.get(batch_id, [])

    # -- tables --------------------------------------------------------------

    def _batches(self, path: str) -> list[tuple[int, str]]:
        return [
            (int(p.rsplit("batch=", 1)[1]), p)
            for p, is_dir, _ in files.children(self.spark, path) if is_dir and "batch=" in p
        ]

    def paths(self, name: str, including: int | None = None) -> list[str]:
        """Folders of the table's visible batches, and of one still open batch."""
        published, replaced, _ = self._published()
        hidden = replaced.get(name, set())
        return [
            p for n, p in self._batches(f"{self.root}/{name}")
            if (n in published and n not in hidden) or n == including
        ]

    def table(self, name: str, including: int | None = None) -> DataFrame:
        df = self.read_files(name, self.paths(name, including))
        if "load_id" in df.columns and self._published()[2]:
            # one row a deleted load
            gone = self.events().filter("kind = 'delete'").select("load_id")
            df = df.join(gone, "load_id", "left_anti")
        return df.select(*TABLES[name].columns)

    def read_paths(self, name: str, paths: list[str]) -> DataFrame:
        return self.read_files(name, paths).select(*TABLES[name].columns)

    def read_files(self, name: str, paths: list[str]) -> DataFrame:
        """All columns of the files, deleted rows included."""
        schema = TABLES[name].file_schema
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema)
        return reader.option("basePath", f"{self.root}/{name}").parquet(*paths).select(*schema.names)

    def batch(self, name: str, batch_id: int) -> DataFrame:
        """What one batch added, published or not."""
        return self.read_paths(
            name, [p for n, p in self._batches(f"{self.root}/{name}") if n == batch_id]
        )

    def bytes(self, name: str, including: int | None = None) -> int:
        return files.total_bytes(self.spark, self.paths(name, including))

    def append(self, name: str, df: DataFrame, batch_id: int, last_id: int | None = None) -> int:
        """Write rows into a batch and return their number; columns are matched by
        name and cast.

        A null in a required column or a row that breaks a check ends the write
        with an error, in the same pass. ``last_id`` is the last id of the table's
        sequence that the rows take up.
        """
        table = TABLES[name]
        values = {f.name: F.col(f.name).cast(f.dataType) for f in table.schema}
        for field in table.schema:
            if not field.nullable:
                error = F.raise_error(F.lit(f"{name}.{field.name} must not be null"))
                values[field.name] = F.coalesce(values[field.name], error.cast(field.dataType))
        first = table.columns[0]
        for rule, condition in table.checks.items():
            error = F.raise_error(F.lit(f"{name}: not so: {rule}"))
            values[first] = F.when(
                F.coalesce(F.expr(condition), F.lit(True)), values[first]
            ).otherwise(error.cast(table.schema[first].dataType))
        if table.by_load:
            values["load_id"] = F.col("load_id") if "load_id" in df.columns else F.lit(None).cast("bigint")
        counted = Observation()
        df = df.select(*[v.alias(c) for c, v in values.items()]).observe(
            counted, F.count(F.lit(1)).alias("rows")
        )
        start = _now()
        writer = df.write
        if table.partition_by:
            # REBALANCE keeps each partition's rows together but splits the big ones
            writer = df.hint("rebalance", *[F.col(c) for c in table.partition_by]).write.partitionBy(
                *table.partition_by
            )
        writer.mode("append").parquet(f"{self.root}/{name}/batch={batch_id}")
        rows = counted.get["rows"]
        self._written.setdefault(batch_id, []).append(
            {"kind": "table", "batch_id": batch_id, "table_name": name, "no_rows": rows,
             "last_id": last_id, "ingest_start_ts": start, "ingest_end_ts": _now()}
        )
        return rows

    def count(self, name: str) -> int:
        return self.table(name).count()

    def max_id(self, name: str, column: str | None = None, including: int | None = None) -> int:
        """Largest id given out so far, 0 for none; deleted rows keep theirs.

        It is read from the log. Only a table whose batches do not tell it, as
        written without ``last_id``, is scanned for it.
        """
        if self._last_ids is None:
            told = self.events().filter("kind = 'table' AND last_id IS NOT NULL")
            marks = told.groupBy("table_name").agg(F.max("last_id").alias("last_id")).collect()
            self._last_ids = {m.table_name: m.last_id for m in marks}  # a row for each table
        open_ids = [
            e["last_id"] for e in self.written(including) if e["table_name"] == name and e["last_id"]
        ] if including is not None else []
        if name in self._last_ids or open_ids:
            return max([self._last_ids.get(name, 0), *open_ids])
        paths = self.paths(name, including)
        key = column or TABLES[name].primary
        rows = self.read_files(name, paths)
        return rows.agg(F.coalesce(F.max(key), F.lit(0))).first()[0] if paths else 0

    # -- ledger --------------------------------------------------------------

    def loads(self) -> DataFrame:
        """The load ledger: one row per load, its latest known values."""
        events = self.events().filter(F.col("load_id").isNotNull())
        names = [n for n in LOAD_DIM.columns if n != "load_id"]
        state = events.groupBy("load_id").agg(
            *[
                F.max_by(n, F.when(F.col(n).isNotNull(), F.col("seq"))).alias(n)
                for n in names
            ]
        )
        return state.withColumns(
            {
                "total_duration": F.col("end_ts") - F.col("start_ts"),
                "ingest_duration": F.col("ingest_end_ts") - F.col("ingest_start_ts"),
            }
        )
