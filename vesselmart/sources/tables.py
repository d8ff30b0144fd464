"""Plain table reads and writes, by Spark's own sources."""

from __future__ import annotations

import math
from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.quadkey import compute_qkey_range

FILE_BYTES = 256 << 20
_MODES = {
    "create": "errorifexists", "append": "append", "replace": "overwrite",
    "create_append": "append",
}


def ingest(
    df: DataFrame, path: str,
    mode: Literal["create", "append", "replace", "create_append"] = "create",
    row_bytes: int | None = None, file_bytes: int = FILE_BYTES,
) -> None:
    """Bulk write; with a row width, files are split so each stays below ``file_bytes``.

    ``append`` needs the target to be there; an empty batch is fine.
    """
    writer = df.write.mode(_MODES[mode])
    if mode == "append":
        df.sparkSession.read.parquet(path)  # an absent target is an error
    if row_bytes:
        writer = writer.option("maxRecordsPerFile", max(1, math.floor(file_bytes / row_bytes)))
    writer.parquet(path)


def to_tmp_table(df: DataFrame, name: str) -> None:
    """Name a query's result for later SQL in the session."""
    df.createOrReplaceTempView(name)


def query_database(spark: SparkSession, url: str, sql: str, **options: str) -> DataFrame:
    """Rows of a statement that a remote database runs."""
    return spark.read.format("jdbc").options(url=url, query=sql, **options).load()


def read_quadkey(df: DataFrame, quadkey: str, depth: int = 8) -> DataFrame:
    """Rows whose spatial partition lies below a quadkey; other partitions are not listed."""
    bounds = df.sparkSession.range(1).select(
        compute_qkey_range(F.lit(quadkey), depth).alias("r")
    ).first().r
    return df.filter(F.col("spatial_part_key").between(bounds.lo, bounds.hi))
