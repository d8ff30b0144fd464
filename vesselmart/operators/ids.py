"""Consecutive ids without a one-task window.

Rows are written once; a row's id is then the number of rows in the files before
its own plus its position in the file. Written files do not change, so the ids
stay the same however often a reading task is retried.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lookup import broadcast_limit

START_BYTES = 64  # a file's entry in the broadcast of row offsets
_PART = re.compile(r"part-(\d+)-.*?-c(\d+)|part-(\d+)")


class SequenceOverflow(RuntimeError):
    """A sequence has no number left for a new row."""


@dataclass
class NumberedRows:
    rows: DataFrame
    count: int


def _file_order(name: str) -> tuple:
    found = _PART.search(name)
    if not found:
        return (0, 0, name)
    part, chunk, plain = found.groups()
    return (int(part or plain), int(chunk or 0), name)


def number_files(
    spark: SparkSession, path: str, schema: T.StructType, id_column: str, first_id: int = 1
) -> NumberedRows:
    """Number the rows of the Parquet files below ``path`` consecutively.

    The files must come from one write, which gives each its own name.
    """
    staged = spark.read.schema(schema).parquet(path)
    file_key = F.xxhash64("_metadata.file_name")
    # per-file counts: as many driver rows as there are files
    sizes = (
        staged.select(file_key.alias("key"), F.col("_metadata.file_name").alias("name"))
        .groupBy("key", "name").agg(F.count(F.lit(1)).alias("n")).collect()
    )
    if len({s.key for s in sizes}) < len(sizes):
        raise RuntimeError(f"two file names below {path} share a hash; write the rows again")
    offsets, total = [], 0
    for size in sorted(sizes, key=lambda s: _file_order(s.name)):
        offsets.append((size.key, first_id + total))
        total += size.n
    starts = spark.createDataFrame(offsets, "__file bigint, __start bigint")
    if len(offsets) * START_BYTES <= broadcast_limit(spark):
        starts = F.broadcast(starts)  # else a plain join: files are of like size
    rows = (
        staged.select("*", file_key.alias("__file"), F.col("_metadata.row_index").alias("__row"))
        .join(starts, "__file")
        .select(
            (F.col("__start") + F.col("__row")).cast("bigint").alias(id_column), *schema.names
        )
    )
    return NumberedRows(rows, total)


def number_groups(
    df: DataFrame, path: str, group: str, order_by: list[Column], id_column: str, first_ids: dict[str, int]
) -> DataFrame:
    """Write ``df`` to ``path``, and number the rows of each group in order.

    All groups go through one range-partitioned write and one count. A file holds
    a group's rows side by side, so that each of its groups has one offset: what
    the driver gets is a row for each file and group.
    """
    spark = df.sparkSession
    order = [F.col(group), *order_by]
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    row = F.col("_metadata.row_index")
    runs = written.groupBy(group, F.col("_metadata.file_name").alias("name")).agg(
        F.count(F.lit(1)).alias("n"), F.min(row).alias("first_row")
    ).collect()
    counts: dict[str, int] = {}
    offsets = []
    for run in sorted(runs, key=lambda r: _file_order(r["name"])):
        before = counts.get(run[group], 0)
        offsets.append((run[group], run["name"], first_ids[run[group]] + before - run["first_row"]))
        counts[run[group]] = before + run["n"]
    starts = spark.createDataFrame(offsets, "__group string, __file string, __start bigint")
    if len(offsets) * START_BYTES <= broadcast_limit(spark):
        starts = F.broadcast(starts)
    rows = written.select("*", F.col("_metadata.file_name").alias("__name"), row.alias("__row"))
    same = (rows[group] == F.col("__group")) & (F.col("__name") == F.col("__file"))
    return rows.join(starts, same).select(
        (F.col("__start") + F.col("__row")).alias(id_column), *df.columns
    )


def number_rows(
    df: DataFrame, path: str, id_column: str, first_id: int = 1,
    order_by: list[Column] | None = None, max_id: int | None = None,
) -> NumberedRows:
    """Write ``df`` to ``path`` and number its rows from ``first_id`` on.

    With ``order_by`` the ids follow that order: the rows are range-partitioned
    and sorted within partitions. Without it no shuffle takes place.
    """
    if order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    df.write.parquet(path)
    numbered = number_files(df.sparkSession, path, df.schema, id_column, first_id)
    check_sequence(first_id, numbered.count, max_id)
    return numbered


def check_sequence(first_id: int, count: int, max_id: int | None) -> None:
    if max_id is not None and count and first_id + count - 1 > max_id:
        raise SequenceOverflow(f"{count} new rows from {first_id} exceed the sequence end {max_id}")
