"""Loading files as they arrive in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from ..plans.loaders import load
from ..warehouse.store import Warehouse

FILE_ENTRY = "path string, modificationTime timestamp, length bigint, content binary"


def load_arrivals(
    wh: Warehouse, folder: str, checkpoint: str, files_per_batch: int = 1000,
    available_now: bool = True,
) -> StreamingQuery:
    """Load each file that turns up, once.

    The stream only tells which files are new; a file offered again after a
    restart is turned away by the ledger.
    """
    stream = (
        wh.spark.readStream.format("binaryFile").schema(FILE_ENTRY).option("maxFilesPerTrigger", files_per_batch)
        .load(folder).select("path")  # one row per file; the content column is not read
    )

    def load_files(batch: DataFrame, _: int) -> None:
        load(wh, [r.path for r in batch.collect()])

    writer = stream.writeStream.foreachBatch(load_files).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
