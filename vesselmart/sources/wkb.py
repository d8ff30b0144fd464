"""Well-known binary at the file edge: points and linestrings to and from arrays."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._columns import Arg, col
from ..operators.geometry import line_array
from ..warehouse.schema import LINE, POINT

# fixed values of the format
WKB_POINT, WKB_LINE = 1, 2
_FLAGS = 0xE0000000  # extended form: z, m and reference-system marks in the type word
_HAS_SRID = 0x20000000


def _words(data: np.ndarray, at: np.ndarray, little: np.ndarray) -> np.ndarray:
    """The 32-bit numbers at places of a byte buffer, each in its byte order."""
    four = data[at[:, None] + np.arange(4)]
    return np.where(little, four.view("<u4")[:, 0], four.view(">u4")[:, 0]).astype(np.int64)


def _decoded(blobs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points per value, all coordinates in order, and which values are null.

    Works on the value buffer as a whole: headers are read at the offsets, then
    masked out, and what is left are the coordinates. An empty line has none.
    """
    null = ~blobs.is_valid().to_numpy(zero_copy_only=False)
    sizes = np.zeros(len(blobs), np.int32)
    if null.all():
        return sizes, np.empty((0, 2)), null
    blobs = blobs.cast(pa.large_binary())
    _, offsets, values = blobs.buffers()
    edges = np.frombuffer(offsets, np.int64)[blobs.offset:blobs.offset + len(blobs) + 1]
    data = np.frombuffer(values, np.uint8)[edges[0]:edges[-1]] if values else np.empty(0, np.uint8)
    start, length = (edges[:-1] - edges[0])[~null], np.diff(edges)[~null]
    if (length < 5).any():
        raise ValueError("a geometry of less than five bytes")
    little = data[start] == 1
    word = _words(data, start + 1, little)
    kind, srid = word & ~_FLAGS, word & _HAS_SRID > 0
    odd = (word & ~_HAS_SRID & _FLAGS > 0) | ~np.isin(kind, (WKB_POINT, WKB_LINE))
    if odd.any():
        raise ValueError(f"expected a two-dimensional point or linestring, got type {word[odd][0]:#x}")
    line = kind == WKB_LINE
    head = 5 + 4 * srid + 4 * line
    if (length < head).any():
        raise ValueError("a geometry ends within its header")
    count = np.ones(len(start), np.int64)
    count[line] = _words(data, (start + head - 4)[line], little[line])
    if (length < head + 16 * count).any():
        raise ValueError("a geometry holds fewer points than it says")
    inside = np.zeros(len(data) + 1, np.int8)
    some = count > 0
    # +1 where coordinates begin and -1 where they end: nulls and bytes behind a value stay out
    np.add.at(inside, (start + head)[some], 1)
    np.add.at(inside, (start + head + 16 * count)[some], -1)
    numbers = data[np.cumsum(inside[:-1], dtype=np.int8).view(bool)].view("<f8")
    if not little.all():
        big = np.repeat(~little, 2 * count)
        numbers = np.where(big, numbers.byteswap(), numbers)
    sizes[~null] = count
    return sizes, numbers.reshape(-1, 2).astype(float), null


def wkb_to_line(wkb: Arg) -> Column:
    @F.arrow_udf(LINE)
    def decode(blobs: pa.Array) -> pa.Array:
        return line_array(*_decoded(blobs))

    return decode(col(wkb))


def wkb_to_point(wkb: Arg) -> Column:
    return F.try_element_at(wkb_to_line(wkb), F.lit(1))


def _encoder(kind: int) -> Callable[[pa.Array], pa.Array]:
    """Lines to little-endian values, written into one buffer."""

    def encode(lines: pa.Array) -> pa.Array:
        valid = lines.is_valid().to_numpy(zero_copy_only=False)
        count = pc.fill_null(pc.list_value_length(lines), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        head = np.zeros((int(valid.sum()), 5 if kind == WKB_POINT else 9), np.uint8)
        head[:, 0] = 1
        head[:, 1:5] = np.frombuffer(np.array([kind], "<u4").tobytes(), np.uint8)
        if kind == WKB_LINE:
            head[:, 5:9] = count[valid].astype("<u4").view(np.uint8).reshape(-1, 4)
        size = np.where(valid, head.shape[1] + 16 * count, 0)
        ends = np.cumsum(size)
        place = (ends - size)[valid][:, None] + np.arange(head.shape[1])
        out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
        coordinates = np.ones(len(out), bool)
        coordinates[place] = False
        out[place] = head
        xy = [c.to_numpy(zero_copy_only=False).astype("<f8") for c in lines.flatten().flatten()]
        out[coordinates] = np.stack(xy, axis=1).ravel().view(np.uint8)
        buffers = [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(out)]
        made = pa.Array.from_buffers(pa.large_binary(), len(lines), buffers).cast(pa.binary())
        return pc.if_else(lines.is_valid(), made, pa.scalar(None, pa.binary()))

    return encode


def line_to_wkb(line: Arg) -> Column:
    encode = _encoder(WKB_LINE)

    @F.arrow_udf(T.BinaryType())
    def to_wkb(lines: pa.Array) -> pa.Array:
        return encode(lines)

    return to_wkb(col(line))


def point_to_wkb(point: Arg) -> Column:
    encode = _encoder(WKB_POINT)

    @F.arrow_udf(T.BinaryType())
    def to_wkb(lines: pa.Array) -> pa.Array:
        return encode(lines)

    p = col(point)
    return to_wkb(F.when(p.isNotNull(), F.array(p)))


def decode_geometry(df: DataFrame, target: dict[str, str]) -> DataFrame:
    """Decode the binary ones among the columns; ``target`` maps column to type text."""
    decoders = {LINE: wkb_to_line, POINT: wkb_to_point}
    return df.withColumns(
        {
            c: decoders[kind](c) for c, kind in target.items()
            if isinstance(df.schema[c].dataType, T.BinaryType)
        }
    )
