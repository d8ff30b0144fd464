"""Whitening of embeddings by a bit-sliced scatter matrix.

Entries become integers, ``floor(64 * c) + 1000000``. Equal vectors count once:
these distinct vectors are the fit list. Its cross-products are found bit by bit.
In a block of rows, each dimension is shifted by its least value there, and each
bit plane of the rest is packed over the rows into 64-bit words. The product sum
of two dimensions is then the sum of ``2 ** (a + b)`` times the number of bits set
in plane a of one AND plane b of the other, which is exact. Block sums are whole
numbers, added up by Spark. The driver gets one number for each pair of
dimensions, centres them as integers (``n * sum(xy) - sum(x) * sum(y)``) and
takes eigenvectors of the covariance.

Skew. Equal vectors are first put together within a task, so that one held by a
third of all rows is one row of a task in the shuffle. The fit list is written
once. Rows are whitened where they are read, with a model of some ``dimensions *
components`` numbers.

Defined results: vectors that are null or empty, or hold a null, NaN or infinite
entry, are left out, as are vectors of another length than the most frequent one
(the shorter, if two are as frequent). Every other row is whitened, repeated rows and
ids and null ids included. Components without variance (below ``FLAT`` of the
largest eigenvalue) do not exist, so a table of equal vectors, or an empty one,
gives no rows. An entry of 2**25 or more in absolute value is an error. A
deviation beyond 64 bits is null. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialised

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
#: Rows whose bit planes are packed and paired at a time.
BLOCK = 1 << 14
#: Least eigenvalue of a component, as a part of the largest.
FLAT = 1e-10
#: Entries are below this after scaling, so that sums over a block fit 64 bits.
WIDEST = 1 << 31
_WORDS = BLOCK // 64


def _integers(vector: str) -> Column:
    def entry(c: Column) -> Column:
        scaled = F.floor(c.cast("double") * SCALE)
        wide = F.raise_error(F.lit("an embedding holds an entry of 2**25 or more"))
        return F.when(F.abs(scaled) < WIDEST, scaled).otherwise(wide.cast("bigint"))

    return F.transform(vector, entry)


def integer_vectors(df: DataFrame, vector: str = "embedding", keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep..., x): usable vectors as integers less ``SHIFT``, all of one length."""
    infinite = float("inf")
    usable = F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(infinite))
    )
    rows = df.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & usable)
    lengths = rows.groupBy(F.size(vector).alias("length")).count()
    most = lengths.orderBy(F.desc("count"), "length").first()
    length = most["length"] if most else 0
    return rows.filter(F.size(vector) == length).select(*keep, _integers(vector).alias("x"))


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    """Column ``x`` of a batch as rows of a matrix."""
    lists = batch.column(batch.schema.get_field_index("x"))
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def cross_products(rows: np.ndarray) -> np.ndarray:
    """Sums over the rows of every product of two columns, as Python integers."""
    count, width = rows.shape
    low = rows.min(axis=0)
    shifted = rows - low
    planes, owner, weight = [], [], []
    for bit in range(int(shifted.max()).bit_length()):
        packed = np.packbits(((shifted >> bit) & 1).T.astype(np.uint8), axis=1)
        words = np.zeros((width, _WORDS * 8), np.uint8)
        words[:, :packed.shape[1]] = packed
        used = np.flatnonzero(packed.any(axis=1))
        planes.append(words.view(np.uint64)[used])
        owner.append(used)
        weight.append(np.full(len(used), bit))
    total = np.zeros((width, width), object)
    if planes:
        planes, owner, weight = map(np.concatenate, (planes, owner, weight))
        wide = int(weight.max()) > 23  # 2 * 23 bits and 14 for the rows fit 64
        spread = np.zeros((len(owner), width), object if wide else np.int64)
        spread[np.arange(len(owner)), owner] = [1 << w for w in weight.tolist()]
        shared = np.zeros((len(owner), len(owner)), np.int64)
        for k in range(len(owner)):
            shared[k, k:] = np.bitwise_count(planes[k] & planes[k:]).sum(axis=1, dtype=np.int64)
        shared += np.triu(shared, 1).T
        total = total + spread.T @ (shared.astype(object) if wide else shared) @ spread
    # back from the shift
    low, sums = low.astype(object), shifted.sum(axis=0).astype(object)
    return total + np.outer(low, sums) + np.outer(sums, low) + count * np.outer(low, low)


PARTS = "i int, j int, amount decimal(38,0)"


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's sums: (i, j) products, (i, -1) values, (-1, -1) rows."""
    count, values, products = 0, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = matrix(batch)
        for at in range(0, len(rows), BLOCK):
            block = rows[at:at + BLOCK]
            count += len(block)
            more = block.sum(axis=0).astype(object)
            values = more if values is None else values + more
            pairs = cross_products(block)
            products = pairs if products is None else products + pairs
    if not count:
        return
    i, j = np.triu_indices(len(values))
    width = len(values)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([*i.tolist(), *range(width), -1], pa.int32()),
            pa.array([*j.tolist(), *[-1] * width, -1], pa.int32()),
            pa.array([Decimal(int(v)) for v in (*products[i, j], *values, count)], pa.decimal128(38, 0)),
        ],
        ["i", "j", "amount"],
    )


@dataclass(frozen=True)
class Model:
    """Sums of the fit list (less ``SHIFT``), and its components by falling variance."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray  # one column each
    variances: np.ndarray
    trace: float

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """``n * x - S`` of each row and dimension, exact."""
        span = self.n * (int(np.abs(rows).max(initial=0)) + 1) + max(map(abs, self.sums), default=0)
        if span >= 1 << 62:
            return rows.astype(object) * self.n - np.array(self.sums, object)
        return rows * self.n - np.array(self.sums, np.int64)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return centred.astype(np.float64) / self.n @ self.components / np.sqrt(self.variances)

    def deviations(self, centred: np.ndarray) -> list[int | None]:
        span = int(np.abs(centred).max(initial=0))
        if span * span * centred.shape[1] < 1 << 62:
            return (centred * centred).sum(axis=1).tolist()
        wide = centred.astype(object)
        return [d if d < 1 << 63 else None for d in map(int, (wide * wide).sum(axis=1))]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Model:
    """Components of the distinct vectors ``x`` of a fit list."""
    parts = vectors.select("x").mapInArrow(_scatter, PARTS)
    # a row for each pair of dimensions, whatever the number of vectors
    sums = parts.groupBy("i", "j").agg(F.sum("amount").alias("amount")).collect()
    found = {(r["i"], r["j"]): int(r["amount"]) for r in sums}
    n = found.get((-1, -1), 0)
    width = sum(1 for i, j in found if i >= 0 > j)
    total = [found[i, -1] for i in range(width)]
    covariance = np.zeros((width, width))
    for i in range(width):
        for j in range(i, width):
            # a quotient of integers is rounded once
            covariance[i, j] = covariance[j, i] = (n * found[i, j] - total[i] * total[j]) / (n * n)
    if not width:
        return Model(0, (), np.zeros((0, 0)), np.zeros(0), 0.0)
    variances, vectors_ = np.linalg.eigh(covariance)
    order = np.argsort(-variances, kind="stable")[:components]
    order = order[variances[order] > max(FLAT * variances.max(), 0.0)]
    return Model(n, tuple(total), vectors_[:, order], variances[order], float(np.trace(covariance)))


def identity_error(vectors: DataFrame, model: Model) -> float:
    """Largest entry of the covariance of the whitened fit list, less the identity."""
    width = len(model.variances)
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, products = np.zeros(width), np.zeros((width, width))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                rows = shared.value.whitened(shared.value.centred(matrix(batch.slice(at, BLOCK))))
                values += rows.sum(axis=0)
                products += rows.T @ rows
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(width + 1), width), pa.int32()),
                pa.array(np.tile(np.arange(width), width + 1), pa.int32()),
                pa.array(np.concatenate([products.ravel(), values])),
            ],
            ["i", "j", "amount"],
        )

    parts = vectors.select("x").mapInArrow(moments, "i int, j int, amount double")
    grid = np.zeros((width + 1, width))
    for row in parts.groupBy("i", "j").agg(F.sum("amount").alias("amount")).collect():
        grid[row["i"], row["j"]] = row["amount"]
    grid /= model.n
    return float(np.abs(grid[:width] - np.outer(grid[width], grid[width]) - np.eye(width)).max())


def whiten(
    df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of each
    usable row and component."""
    rows = integer_vectors(df, vector, (id_column,))
    fit_list = materialised(rows.select("x").distinct(), "vectors")
    model = fit(fit_list, components)
    width = len(model.variances)
    schema = (
        f"`{id_column}` {df.schema[id_column].dataType.simpleString()}, component int, n long, "
        "deviation long, whitened double, explained double, identity_error double"
    )
    if not width:
        return df.sparkSession.createDataFrame([], schema)
    error = identity_error(fit_list, model)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                centred = model.centred(matrix(part))
                count = part.num_rows
                which = pa.array(np.repeat(np.arange(count), width))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(which),
                        pa.array(np.tile(np.arange(1, width + 1), count), pa.int32()),
                        pa.array(np.full(count * width, model.n, np.int64)),
                        pa.array(model.deviations(centred), pa.int64()).take(which),
                        pa.array(model.whitened(centred).ravel()),
                        pa.array(np.tile(model.variances / model.trace, count)),
                        pa.array(np.full(count * width, error)),
                    ],
                    [id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(project, schema)
