"""Table upkeep."""

from __future__ import annotations

import math

from ..sources.tables import FILE_BYTES
from ..warehouse import files
from ..warehouse.schema import TABLES
from ..warehouse.store import Warehouse


def compact(wh: Warehouse, name: str, file_bytes: int = FILE_BYTES) -> int:
    """Rewrite a table's small files into files of about the given size.

    Batches whose files are already of half that size on average are left alone,
    so what was compacted once is not read again. The others become one new
    batch; the log entry that publishes it also retires them, so readers see one
    or the other. Returns the new batch, or -1 if there was nothing to gain.
    """
    small: list[str] = []
    size = count = 0
    for path in wh.paths(name):
        parts = _data_files(wh, path)
        total = sum(parts)
        if parts and total / len(parts) < file_bytes / 2:
            small.append(path)
            size, count = size + total, count + len(parts)
    wanted = max(1, math.ceil(size / file_bytes))
    if count <= wanted:
        return -1
    rows = wh.read_files(name, small)
    if not TABLES[name].partition_by:
        rows = rows.repartition(wanted)
    batch = wh.next_batch()
    wh.append(name, rows, batch)
    old = [int(p.rsplit("batch=", 1)[1]) for p in small]
    # what was moved is not counted as loaded again
    wh.log([{"kind": "compact", "batch_id": batch, "table_name": name, "replaces": old}])
    return batch


def _data_files(wh: Warehouse, path: str) -> list[int]:
    """Sizes of the data files at any depth."""
    found: list[int] = []
    for child, is_dir, size in files.children(wh.spark, path):
        if is_dir:
            found += _data_files(wh, child)
        elif child.endswith(".parquet"):
            found.append(size)
    return found
