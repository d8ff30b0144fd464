"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

#: Bytes of text a Python task works on at a time; bounds its memory, not its input.
SLICE_BYTES = 1 << 20
#: Words are runs of anything but these (ASCII white space).
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialised(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a cut in the lineage
    that outlives the loss of executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_bytes(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch holding about ``most`` bytes of text each.

    A single longer text is a slice of its own.
    """
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(sizes) - sizes) // most
    cuts = np.flatnonzero(np.diff(group)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for start, end in zip(edges[:-1], edges[1:]):
        yield batch.slice(start, end - start)


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column's strings, nulls as empty ones."""
    return [t or "" for t in batch.column(column).to_pylist()]


def word_array(text: Column) -> Column:
    """Words of a text in order, as an array; null gives an empty array."""
    words = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.array_remove(words, "")


#: Most rows of ids that are broadcast, counted before each join.
FEW_IDS = 500_000


def without_ids(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """``documents`` but for the rows whose ``doc_id`` is in ``ids``, nulls included.

    The ids are written first. Up to ``FEW_IDS`` of them are broadcast, so that
    texts are not shuffled; more are joined by a shuffle.
    """
    ids = materialised(ids.select("doc_id").distinct(), "ids").withColumnRenamed("doc_id", "gone_id")
    few = ids.limit(FEW_IDS + 1).count() <= FEW_IDS
    return documents.join(
        F.broadcast(ids) if few else ids, documents["doc_id"].eqNullSafe(F.col("gone_id")), "left_anti"
    )
