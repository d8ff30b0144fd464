"""Trajectory files: what one must hold, which files qualify, and reading them."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..warehouse import files
from ..warehouse.schema import CONFIG_COLUMNS, LINE, MEASURE, MEASURES, POINT
from .wkb import decode_geometry

# Columns every file must have, by the type they are read as.
COLUMN_TYPES: dict[str, tuple[str, ...]] = {
    "bigint": (
        "traj_id", "mmsi", "imo", "start_date_id", "start_time_id", "end_date_id", "end_time_id",
        "seconds", "no_points", "meters_to_prev_obj", "seconds_to_prev_obj",
    ),
    "int": (
        "mid", "country_code", "region_code", "sub_region_code", "intermediate_region_code",
    ),
    "string": (
        "type", "prev_obj_type", "state_change", "radio_service_type", "vessel_name",
        "vessel_type", "call_sign", "cargo_type", "transponder_type", "pos_type",
        "start_destination_msg", "end_destination_msg", "alpha2", "alpha3", "country_name",
        "region", "sub_region", "intermediate_region",
    ),
    "boolean": (
        "is_valid_mmsi", "is_valid_imo", "in_eu_mrv_db", "is_simple_geom", "is_valid_geom",
    ),
    "float": (*CONFIG_COLUMNS, "tortuosity"),
    MEASURE: ("meters", *MEASURES),
    LINE: ("geom",),
    POINT: ("start_point", "end_point"),
}
REQUIRED = {name: kind for kind, names in COLUMN_TYPES.items() for name in names}
GEOMETRY = {n: k for n, k in REQUIRED.items() if k in (LINE, POINT)}
SUFFIXES = (".parquet", ".pq")
FOOTERS = 16  # footers a task reads at least, and the driver asks for at a time
HIDDEN = r"^\.|^_[^=]*$"  # names that Spark's readers pass over


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Entries of a folder, whatever their kind."""
    return [p for p, is_dir, _ in files.children(spark, folder) if not is_dir]


def file_name(path: Column) -> Column:
    """Last part of a path, as it stands."""
    return F.element_at(F.split(path, "/"), -1)


JUDGED = "path string, names array<string>, form string, unread boolean"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path in it; a folder path is taken as it stands."""
    local = re.sub(r"^file:/+", "/", path)
    if local.startswith("/"):
        return pafs.LocalFileSystem(), local
    return pafs.FileSystem.from_uri(quote(path, safe=":/@"))


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns of each file, or that the task could not get at it."""
    for batch in batches:
        rows = []
        for path in batch.column(0).to_pylist():
            names, form, unread = [], "", False
            if path.endswith(SUFFIXES):
                try:
                    store, place = _open(path)
                    with store.open_input_file(place) as file:
                        schema = pq.read_schema(file)
                    names = schema.names
                    form = ",".join(f"{f.name}:{f.type}" for f in sorted(schema, key=lambda f: f.name) if f.name in REQUIRED)
                except (FileNotFoundError, NotImplementedError, PermissionError):
                    unread = True
                except pa.ArrowInvalid as problem:
                    # no store of that name, or no Parquet
                    unread = "filesystem type" in str(problem) or "URI" in str(problem)
                except OSError as problem:
                    unread = "thrift" not in str(problem).lower()
            rows.append((path, names, form, unread))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.list_(pa.string()), pa.string(), pa.bool_()))],
            ["path", "names", "form", "unread"],
        )


def conformance(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """(path, compatible, missing, form, hidden) per file: its suffix and its columns are judged.

    Footers are read in tasks over the table of paths. Only those of files in a
    store that a task cannot open are asked of Spark's reader, a few at a time.
    Extra columns and types do not matter; ``form`` tells the types of the
    required columns, for reading like files together. A file that is no Parquet
    has no columns. ``hidden`` tells names that Spark's readers pass over.
    """
    paths = list(paths)
    parts = max(1, min(len(paths) // FOOTERS, spark.sparkContext.defaultParallelism * 4))
    table = spark.createDataFrame([(p,) for p in paths], "path string").repartition(parts)
    path = scratch_dir(spark, "footers")
    table.mapInArrow(_footers, JUDGED).write.parquet(path)
    judged = spark.read.schema(JUDGED).parquet(path)
    unread = [r.path for r in judged.filter("unread").select("path").collect()]
    if unread:
        judged = judged.filter("NOT unread").unionAll(_asked(spark, unread))
    missing = F.array_except(F.array(*[F.lit(c) for c in sorted(REQUIRED)]), "names")
    return judged.select(
        "path", (F.size(missing) == 0).alias("compatible"), missing.alias("missing"), "form",
        file_name(F.col("path")).rlike(HIDDEN).alias("hidden"),
    )


def _asked(spark: SparkSession, paths: list[str]) -> DataFrame:
    """As the tasks do, by Spark's reader from the driver: one row a file."""

    def footer(path: str) -> list[tuple[str, str]]:
        try:
            return spark.read.parquet(literal_path(path)).dtypes
        except Exception as problem:
            if "CANNOT_READ_FILE_FOOTER" in str(problem) or "UNABLE_TO_INFER_SCHEMA" in str(problem):
                return []
            raise

    with ThreadPoolExecutor(FOOTERS) as pool:
        columns = list(pool.map(footer, paths))
    rows = [
        (p, [n for n, _ in c], ",".join(f"{n}:{k}" for n, k in sorted(c) if n in REQUIRED), False)
        for p, c in zip(paths, columns)
    ]
    return spark.createDataFrame(rows, JUDGED)


def literal_path(path: str) -> str:
    """A path in which no character is taken as a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def is_traj_file(spark: SparkSession, path: str) -> bool:
    return conformance(spark, [path]).first().compatible


def read_trajectories(spark: SparkSession, groups: Iterable[Sequence[str]]) -> DataFrame:
    """All files as one batch of the required columns, with the file's name as ``src_id``.

    Each group of files shares its column types; they are cast to the common
    ones, and binary geometry is decoded.
    """
    parts = []
    for paths in groups:
        # the name Spark reports has its special characters percent-encoded
        encoded = F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))
        raw = spark.read.parquet(*map(literal_path, paths)).select(
            *REQUIRED, F.url_decode(encoded).alias("src_id")
        )
        shaped = decode_geometry(raw, GEOMETRY)
        parts.append(
            shaped.select("src_id", *[F.col(c).cast(k).alias(c) for c, k in REQUIRED.items()])
        )
    return reduce(DataFrame.unionAll, parts)
