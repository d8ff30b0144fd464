"""Linestrings as arrays of points: summaries in Catalyst, shapes in Arrow batches."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._columns import Arg, col
from ..warehouse.schema import LINE


def _segment_lengths(pts: Column) -> Column:
    """struct(x, y, w) per segment: its middle and its length."""
    head = F.slice(pts, F.lit(1), F.size(pts) - 1)
    tail = F.slice(pts, F.lit(2), F.size(pts) - 1)
    return F.zip_with(
        head, tail,
        lambda a, b: F.struct(
            ((a["x"] + b["x"]) / 2).alias("x"), ((a["y"] + b["y"]) / 2).alias("y"),
            F.sqrt(
                (b["x"] - a["x"]) * (b["x"] - a["x"]) + (b["y"] - a["y"]) * (b["y"] - a["y"])
            ).alias("w"),
        ),
    )


def _weighted_sums(parts: Column) -> Column:
    zero = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("w"))
    return F.aggregate(
        parts, zero,
        lambda acc, p: F.struct(
            (acc["x"] + p["x"] * p["w"]).alias("x"), (acc["y"] + p["y"] * p["w"]).alias("y"),
            (acc["w"] + p["w"]).alias("w"),
        ),
    )


def centroid(line: Arg) -> Column:
    """Length-weighted centre; the mean of the points when the line has no length."""
    pts = col(line)
    n = F.size(pts)
    by_length = F.when(n > 1, _weighted_sums(_segment_lengths(pts)))
    by_point = _weighted_sums(
        F.transform(pts, lambda p: F.struct(p["x"], p["y"], F.lit(1.0).alias("w")))
    )
    sums = F.when(by_length["w"] > 0, by_length).otherwise(by_point)
    return F.when(
        n > 0, F.struct((sums["x"] / sums["w"]).alias("x"), (sums["y"] / sums["w"]).alias("y"))
    )


def line_length(line: Arg) -> Column:
    """Planar length of the line."""
    pts = col(line)
    return F.when(F.size(pts) > 1, _weighted_sums(_segment_lengths(pts))["w"]).otherwise(0.0)


def point_x(point: Arg) -> Column:
    return col(point)["x"]


def point_y(point: Arg) -> Column:
    return col(point)["y"]


def start_point(line: Arg) -> Column:
    return F.try_element_at(col(line), F.lit(1))


def end_point(line: Arg) -> Column:
    return F.try_element_at(col(line), F.lit(-1))


def is_linestring(line: Arg) -> Column:
    return F.size(col(line)) >= 2


def line_wkt(line: Arg) -> Column:
    """Text form, for reading and comparing."""
    pts = F.transform(
        col(line), lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))
    )
    return F.concat(F.lit("LINESTRING ("), F.array_join(pts, ", "), F.lit(")"))


# -- shapes of one line ------------------------------------------------------


def hull_ring(pts: np.ndarray) -> np.ndarray:
    """Convex hull: a closed ring, or the segment or point it collapses to.

    Turns are judged in floating point; only where rounding leaves the sign in
    doubt are the three points compared as whole numbers.
    """
    if len(pts) > 64:
        pts = _outer(pts)
    corners = sorted(set(map(tuple, pts.tolist())))
    if len(corners) < 3:
        return np.array(corners, float).reshape(-1, 2)
    if not np.isfinite(pts).all():
        raise ValueError("a hull needs finite coordinates")

    def chain(points: list) -> list:
        out: list = []
        for px, py in points:
            while len(out) > 1:
                (ax, ay), (bx, by) = out[-2], out[-1]
                left, right = (bx - ax) * (py - ay), (by - ay) * (px - ax)
                turn = left - right
                if abs(turn) <= _ROUNDING * (abs(left) + abs(right)) + _TINY:
                    turn = _turn(*_whole([out[-2], out[-1], (px, py)]))
                if turn > 0:
                    break
                out.pop()
            out.append((px, py))
        return out

    ring = chain(corners)[:-1] + chain(corners[::-1])[:-1]
    return np.array(ring if len(ring) < 3 else [*ring, ring[0]])


def _outer(pts: np.ndarray) -> np.ndarray:
    """The points but for those clearly inside the octagon of the outermost ones."""
    x, y = pts[:, 0], pts[:, 1]
    at = [np.argmax(v) for v in (x, x + y, y, y - x, -x, -x - y, -y, x - y)]
    inside = np.ones(len(pts), bool)
    for a, b in zip(at, [*at[1:], at[0]]):
        if (x[a], y[a]) == (x[b], y[b]):
            continue
        left, right = (x[b] - x[a]) * (y - y[a]), (y[b] - y[a]) * (x - x[a])
        inside &= left - right > _ROUNDING * (np.abs(left) + np.abs(right)) + _TINY
    # all in one place: nothing is clear
    return pts[~inside] if len(set(at)) > 2 else pts


_ROUNDING = 4e-16  # bound on the relative rounding error of an orientation sum
_TINY = 1e-290  # below this, products may have lost digits whatever their size


def _whole(points: list) -> list[tuple[int, int]]:
    """The points on a common whole-number scale, without rounding."""
    ratios = [(x.as_integer_ratio(), y.as_integer_ratio()) for x, y in points]
    scale = max(d for pair in ratios for _, d in pair)  # powers of two divide each other
    return [(nx * (scale // dx), ny * (scale // dy)) for (nx, dx), (ny, dy) in ratios]


def _turn(a, b, c) -> int:
    """1 if c is left of a-b, -1 if right, 0 if on the line."""
    left, right = (b[0] - a[0]) * (c[1] - a[1]), (b[1] - a[1]) * (c[0] - a[0])
    return (left > right) - (left < right)


def _turns(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """As :func:`_turn`, over rows (any argument may be a single point).

    Where rounding could hide the sign, it is worked out on whole numbers.
    """
    a, b, c = np.broadcast_arrays(a, b, c)
    left = (b[:, 0] - a[:, 0]) * (c[:, 1] - a[:, 1])
    right = (b[:, 1] - a[:, 1]) * (c[:, 0] - a[:, 0])
    signs = np.sign(left - right).astype(int)
    for n in np.flatnonzero(np.abs(left - right) <= _ROUNDING * (np.abs(left) + np.abs(right))):
        signs[n] = _turn(*_whole([a[n].tolist(), b[n].tolist(), c[n].tolist()]))
    return signs


def _distances(pts: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of each point to the segment a-b."""
    d, v = b - a, pts - a
    # written out: a library's product may round otherwise than _farthest
    square = float(d[0] * d[0] + d[1] * d[1])
    to_a = np.sqrt((v * v).sum(axis=1))
    if square == 0:
        return to_a
    along = (v[:, 0] * d[0] + v[:, 1] * d[1]) / square
    to_b = np.sqrt(((pts - b) ** 2).sum(axis=1))
    across = np.abs(v[:, 1] * d[0] - v[:, 0] * d[1]) / square * np.sqrt(square)
    return np.where(along <= 0, to_a, np.where(along >= 1, to_b, across))


def _sign(a: tuple, b: tuple, c: tuple) -> int:
    """As :func:`_turn`, on floating-point numbers without their rounding."""
    if c == a or c == b:
        return 0
    left, right = (b[0] - a[0]) * (c[1] - a[1]), (b[1] - a[1]) * (c[0] - a[0])
    if abs(left - right) > _ROUNDING * (abs(left) + abs(right)) + _TINY:
        return 1 if left > right else -1
    return _turn(*_whole([a, b, c]))


def _within(p: tuple, q: tuple, r: tuple) -> bool:
    """r lies on p-q, apart from the ends (r known to be on the line)."""
    return (
        r != p and r != q and min(p[0], q[0]) <= r[0] <= max(p[0], q[0])
        and min(p[1], q[1]) <= r[1] <= max(p[1], q[1])
    )


def _meet(a: tuple, b: tuple, p: tuple, q: tuple) -> bool:
    """:func:`_interior_hit` of one segment p-q."""
    if (a, b) == (p, q) or (a, b) == (q, p):
        return True
    d1, d2, d3, d4 = _sign(a, b, p), _sign(a, b, q), _sign(p, q, a), _sign(p, q, b)
    if d1 * d2 < 0 and d3 * d4 < 0:
        return True
    return (
        d1 == 0 and _within(a, b, p) or d2 == 0 and _within(a, b, q)
        or d3 == 0 and _within(p, q, a) or d4 == 0 and _within(p, q, b)
    )


_FEW = 24  # segments up to which one by one is faster than as arrays


def _interior_hit(a, b, starts: np.ndarray, ends: np.ndarray) -> bool:
    """Is a-b one of the segments, or does it meet one at a point inside either of the two?

    Sharing just an end point is no hit.
    """
    if len(starts) <= _FEW:
        one, two = tuple(a.tolist()), tuple(b.tolist())
        return any(_meet(one, two, tuple(p), tuple(q)) for p, q in zip(starts.tolist(), ends.tolist()))
    forth = (starts == a).all(axis=1) & (ends == b).all(axis=1)
    back = (starts == b).all(axis=1) & (ends == a).all(axis=1)
    if (forth | back).any():
        return True
    box = (
        (np.minimum(starts, ends) <= np.maximum(a, b)).all(axis=1)
        & (np.maximum(starts, ends) >= np.minimum(a, b)).all(axis=1)
    )
    starts, ends = starts[box], ends[box]
    d1, d2 = _turns(a, b, starts), _turns(a, b, ends)
    d3, d4 = _turns(starts, ends, a), _turns(starts, ends, b)
    proper = (d1 * d2 < 0) & (d3 * d4 < 0)
    if proper.any():
        return True

    def inside(p, q, r):
        """r lies on p-q, apart from the ends (r known to be on the line)."""
        within = (r >= np.minimum(p, q)).all(axis=-1) & (r <= np.maximum(p, q)).all(axis=-1)
        return within & (r != p).any(axis=-1) & (r != q).any(axis=-1)

    touch = (
        ((d1 == 0) & inside(a, b, starts)) | ((d2 == 0) & inside(a, b, ends))
        | ((d3 == 0) & inside(starts, ends, a)) | ((d4 == 0) & inside(starts, ends, b))
    )
    return bool(touch.any())


_SPAN = 128  # segments under one box


class _Segments:
    """Segments by number, with the box of every ``_SPAN`` neighbours.

    Neighbours on a line lie close together, so a search by box looks at few spans.
    """

    def __init__(self, size: int):
        spans = -(-size // _SPAN)
        self.starts, self.ends = np.zeros((2, spans * _SPAN, 2))
        self.low, self.high = np.full((spans * _SPAN, 2), np.inf), np.full((spans * _SPAN, 2), -np.inf)
        self.span_low, self.span_high = np.full((spans, 2), np.inf), np.full((spans, 2), -np.inf)

    @classmethod
    def of_line(cls, pts: np.ndarray) -> _Segments:
        made, n = cls(len(pts) - 1), len(pts) - 1
        made.starts[:n], made.ends[:n] = pts[:-1], pts[1:]
        made.low[:n], made.high[:n] = np.minimum(pts[:-1], pts[1:]), np.maximum(pts[:-1], pts[1:])
        made.span_low = made.low.reshape(-1, _SPAN, 2).min(axis=1)
        made.span_high = made.high.reshape(-1, _SPAN, 2).max(axis=1)
        return made

    def put(self, k: int, a: np.ndarray, b: np.ndarray) -> None:
        self.starts[k], self.ends[k] = a, b
        self.low[k], self.high[k] = np.minimum(a, b), np.maximum(a, b)
        span = k // _SPAN
        self.span_low[span] = np.minimum(self.span_low[span], self.low[k])
        self.span_high[span] = np.maximum(self.span_high[span], self.high[k])

    def drop(self, i: int, j: int) -> None:
        self.low[i:j] = np.inf

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Numbers of the segments whose box meets that of a-b."""
        low, high = np.minimum(a, b), np.maximum(a, b)
        spans = np.flatnonzero(((self.span_low <= high) & (self.span_high >= low)).all(axis=1))
        at = (spans[:, None] * _SPAN + np.arange(_SPAN)).ravel()
        return at[((self.low[at] <= high) & (self.high[at] >= low)).all(axis=1)]


class _Sections:
    """The original segments not yet replaced, and the ones that replaced a section."""

    def __init__(self, pts: np.ndarray):
        self.pts = pts
        self.line = _Segments.of_line(pts)
        self.flat = _Segments(len(pts) - 1)  # by the section's first point

    def meet(self, i: int, j: int) -> bool:
        """Does the segment from point i to j meet any other than those it would replace?"""
        a, b = self.pts[i], self.pts[j]
        others = self.line.near(a, b)
        others = others[(others < i) | (others >= j)]
        before = self.flat.near(a, b)
        return _interior_hit(a, b, self.line.starts[others], self.line.ends[others]) or _interior_hit(
            a, b, self.flat.starts[before], self.flat.ends[before]
        )

    def replace(self, i: int, j: int) -> None:
        self.line.drop(i, j)
        self.flat.put(i, self.pts[i], self.pts[j])


class _FewSections:
    """As :class:`_Sections`, gone through one by one; for short lines of finite points."""

    def __init__(self, points: list[tuple]):
        self.points = points
        self.line = [*zip(points, points[1:])]
        self.flat: list[tuple] = []

    def meet(self, i: int, j: int) -> bool:
        a, b = self.points[i], self.points[j]
        (left, right), (low, high) = sorted((a[0], b[0])), sorted((a[1], b[1]))
        for some in (self.line[:i], self.line[j:], self.flat):
            for p, q in some:
                if (
                    (p[0] <= right or q[0] <= right) and (p[0] >= left or q[0] >= left)
                    and (p[1] <= high or q[1] <= high) and (p[1] >= low or q[1] >= low)
                    and _meet(a, b, p, q)
                ):
                    return True
        return False

    def replace(self, i: int, j: int) -> None:
        # a point stands for the segment that is gone; it meets nothing
        self.line[i:j] = [((math.inf, math.inf),) * 2] * (j - i)
        self.flat.append((self.points[i], self.points[j]))


def _farthest(points: list[tuple], i: int, j: int) -> tuple[int, float]:
    """As the largest of :func:`_distances` to the segment i-j, its first place and value."""
    (ax, ay), (bx, by) = points[i], points[j]
    dx, dy = bx - ax, by - ay
    square = dx * dx + dy * dy
    root = math.sqrt(square)
    at, most = i + 1, -1.0
    for k in range(i + 1, j):
        x, y = points[k]
        vx, vy = x - ax, y - ay
        along = (vx * dx + vy * dy) / square if square else 0.0
        if along <= 0:
            off = math.sqrt(vx * vx + vy * vy)
        elif along >= 1:
            ux, uy = x - bx, y - by
            off = math.sqrt(ux * ux + uy * uy)
        else:
            off = abs(vy * dx - vx * dy) / square * root
        if off > most:
            at, most = k, off
    return at, most


_SHORT = 256  # points of a line up to which its segments are gone through one by one
_NEAR = 32  # points of a section up to which their distances are


def simplify_line(pts: np.ndarray, tolerance: float) -> np.ndarray:
    """Points kept so that the line stays within the tolerance and gains no crossing.

    Sections are flattened as in the Douglas-Peucker method, but only if the new
    segment meets neither the line kept so far nor a section still to come.
    """
    n = len(pts)
    if n < 3:
        return pts
    points = [*map(tuple, pts.tolist())]
    # beyond these bounds products are no plain numbers
    plain = bool((np.abs(pts) < 1e100).all())
    sections = _FewSections(points) if n <= _SHORT and plain else _Sections(pts)
    kept = [0]
    todo = [(0, n - 1)]
    while todo:
        i, j = todo.pop()
        if j == i + 1:
            kept.append(j)
            continue
        if plain and j - i <= _NEAR:
            middle, most = _farthest(points, i, j)
        else:
            away = _distances(pts[i + 1 : j], pts[i], pts[j])
            far = int(away.argmax())
            middle, most = i + 1 + far, away[far]
        if most <= tolerance and not sections.meet(i, j):
            sections.replace(i, j)
            kept.append(j)
            continue
        todo += [(middle, j), (i, middle)]
    return pts[kept]


def _reshape(lines: pa.Array, shape: Callable[[np.ndarray], np.ndarray]) -> pa.Array:
    """Apply ``shape`` to each line of an Arrow column; nulls stay null."""
    flat = lines.flatten()
    xy = np.column_stack(
        [flat.field(n).to_numpy(zero_copy_only=False) for n in ("x", "y")]
    ).astype(float)
    lengths = np.nan_to_num(lines.value_lengths().to_numpy(zero_copy_only=False)).astype(int)
    ends = np.cumsum(lengths)
    parts = [shape(xy[e - n : e]) for e, n in zip(ends, lengths)]
    sizes = np.array([len(p) for p in parts], dtype=np.int32)
    joined = np.vstack([p.reshape(-1, 2) for p in parts]) if parts else np.empty((0, 2))
    return line_array(sizes, joined, ~lines.is_valid().to_numpy(zero_copy_only=False))


def line_array(sizes: np.ndarray, xy: np.ndarray, null: np.ndarray) -> pa.Array:
    """Arrow column of lines from their point counts and all points in a row."""
    offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
    points = pa.StructArray.from_arrays(
        [pa.array(np.ascontiguousarray(xy[:, 0])), pa.array(np.ascontiguousarray(xy[:, 1]))],
        names=["x", "y"],
    )
    return pa.ListArray.from_arrays(offsets, points, mask=pa.array(null))


def convex_hull(line: Arg) -> Column:
    """Corners of the hull as a closed ring; a point or segment where it has no area."""

    @F.arrow_udf(LINE)
    def hull(lines: pa.Array) -> pa.Array:
        return _reshape(lines, hull_ring)

    return hull(col(line))


def simplify_preserve_topology(line: Arg, tolerance: float) -> Column:
    """Fewer points, at most ``tolerance`` off the line, with no crossing added."""

    @F.arrow_udf(LINE)
    def simplify(lines: pa.Array) -> pa.Array:
        return _reshape(lines, lambda pts: simplify_line(pts, tolerance))

    return simplify(col(line))


def with_stop_shapes(
    df: DataFrame, line: str, hull: str, simplified: str, tolerance: float
) -> DataFrame:
    """Add convex hull and simplification of each line."""
    return df.withColumns(
        {hull: convex_hull(line), simplified: simplify_preserve_topology(line, tolerance)}
    )
