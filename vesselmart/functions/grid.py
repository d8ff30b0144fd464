"""Planar and geographic grid cells.

Bounds and cell sizes may be numbers or columns (per-row bounds).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import Arg, big, col, dbl, idiv, positive

INFINITY = float("inf")
QUADRANTS = (3, 4, 2, 1)  # fixed values: south-west, south-east, north-west, north-east
QUADRANT_STRIDE = 100000  # fixed value: geographic ids are quadrant * stride + cell


def _count(low: Column, high: Column, size: Column) -> Column:
    return F.floor((high - low) / size)


def _check_sizes(cell_width: Arg, cell_height: Arg) -> None:
    positive(cell_width, "cell_width")
    positive(cell_height, "cell_height")


def coord_to_grid_id(
    x: Arg, y: Arg, x_min: Arg, y_min: Arg, x_max: Arg, y_max: Arg, cell_width: Arg,
    cell_height: Arg, nonfinite: str = "outside",
) -> Column:
    """Row-major cell number, -1 outside; the upper edges are outside.

    ``nonfinite`` says what NaN and infinite coordinates give: ``"outside"`` (-1)
    or ``"null"``. With ``"null"``, a null coordinate also wins over an
    out-of-range partner.
    """
    _check_sizes(cell_width, cell_height)
    px, py = dbl(x), dbl(y)
    x0, y0, w, h = dbl(x_min), dbl(y_min), dbl(cell_width), dbl(cell_height)
    cols, rows = _count(x0, dbl(x_max), w), _count(y0, dbl(y_max), h)
    i, j = (px - x0) / w, (py - y0) / h
    # compared before rounding down; what is not finite is out of range as well
    outside = (i < 0) | (i >= cols.cast("double")) | (j < 0) | (j >= rows.cast("double"))
    inside = (cols * F.floor(j) + F.floor(i)).cast("bigint")
    cell = F.when(outside, F.lit(-1).cast("bigint")).otherwise(inside)
    if nonfinite == "outside":
        return cell
    if nonfinite == "null":
        finite = (F.abs(px) < INFINITY) & (F.abs(py) < INFINITY)
        return F.when(finite, cell)
    raise ValueError("nonfinite must be 'outside' or 'null'")


def point_to_grid_id(
    point: Arg, x_min: Arg, y_min: Arg, x_max: Arg, y_max: Arg, cell_width: Arg, cell_height: Arg
) -> Column:
    """As :func:`coord_to_grid_id` for a struct(x, y)."""
    p = col(point)
    return coord_to_grid_id(p["x"], p["y"], x_min, y_min, x_max, y_max, cell_width, cell_height)


def grid_id_to_coord(
    grid_id: Arg, x_min: Arg, y_min: Arg, x_max: Arg, y_max: Arg, cell_width: Arg, cell_height: Arg
) -> Column:
    """Lower-left corner as struct(x, y); both null when the id is not in the grid."""
    _check_sizes(cell_width, cell_height)
    g, x0, y0, w, h = big(grid_id), dbl(x_min), dbl(y_min), dbl(cell_width), dbl(cell_height)
    cols, rows = _count(x0, dbl(x_max), w), _count(y0, dbl(y_max), h)
    known = g.between(F.lit(0), cols * rows - 1)
    return F.struct(
        F.when(known, (g % cols) * w + x0).alias("x"),
        F.when(known, idiv(g, cols) * h + y0).alias("y"),
    )


def box(x_min: Column, y_min: Column, x_max: Column, y_max: Column) -> Column:
    """Axis-parallel rectangle; all four parts null stands for the empty polygon."""
    return F.struct(
        x_min.alias("x_min"), y_min.alias("y_min"), x_max.alias("x_max"), y_max.alias("y_max")
    )


def box_wkt(rectangle: Arg) -> Column:
    """Text form of a rectangle; ``POLYGON EMPTY`` for the empty one, null for null."""
    b = col(rectangle)
    ring = F.format_string(
        "POLYGON ((%s %s, %s %s, %s %s, %s %s, %s %s))",
        *[b[c].cast("string") for c in (
            "x_min", "y_min", "x_min", "y_max", "x_max", "y_max", "x_max", "y_min", "x_min", "y_min"
        )],
    )
    return F.when(b.isNull(), None).when(b["x_min"].isNull(), "POLYGON EMPTY").otherwise(ring)


def grid_id_to_envelope(
    grid_id: Arg, x_min: Arg, y_min: Arg, x_max: Arg, y_max: Arg, cell_width: Arg, cell_height: Arg
) -> Column:
    """Rectangle of the cell, the empty one when the id is not in the grid."""
    c = grid_id_to_coord(grid_id, x_min, y_min, x_max, y_max, cell_width, cell_height)
    return box(c["x"], c["y"], c["x"] + dbl(cell_width), c["y"] + dbl(cell_height))


def coord_to_quadrant(lon: Arg, lat: Arg) -> Column:
    """1 north-east, 2 north-west, 3 south-west, 4 south-east; zero counts as positive."""
    place = (dbl(lon) >= 0).cast("int") + (dbl(lat) >= 0).cast("int") * 2
    return F.element_at(F.array(*map(F.lit, QUADRANTS)), place + 1)


def _check_quadrant(cell_width: Arg, cell_height: Arg) -> None:
    """Ids of neighbouring quadrants overlap if one holds more cells than the stride."""
    if isinstance(cell_width, (int, float)) and isinstance(cell_height, (int, float)):
        _check_sizes(cell_width, cell_height)
        if (180 // cell_width) * (90 // cell_height) > QUADRANT_STRIDE:
            raise ValueError(f"a quadrant would hold more than {QUADRANT_STRIDE} cells")


def wgs84_coord_to_grid_id(lon: Arg, lat: Arg, cell_width: Arg, cell_height: Arg) -> Column:
    """Cell number within the quadrant plus quadrant * 100000; -1 outside.

    Longitude 180 is taken as -180; latitude 90 is outside.
    """
    _check_quadrant(cell_width, cell_height)
    x = F.when(dbl(lon) == 180, -180.0).otherwise(dbl(lon)) + 180
    y = dbl(lat) + 90
    west, south = x < 180, y < 90
    x0 = F.when(west, 0.0).otherwise(180.0)
    y0 = F.when(south, 0.0).otherwise(90.0)
    cell = coord_to_grid_id(x, y, x0, y0, x0 + 180, y0 + 90, cell_width, cell_height)
    return F.when(cell == -1, cell).otherwise(
        cell + coord_to_quadrant(x - 180, y - 90) * QUADRANT_STRIDE
    )


def grid_id_to_wgs84_coord(grid_id: Arg, cell_width: Arg, cell_height: Arg) -> Column:
    """Lower-left corner of a geographic cell as struct(x, y); nulls for a bad quadrant."""
    _check_sizes(cell_width, cell_height)
    g = big(grid_id)
    quadrant = F.floor(g / QUADRANT_STRIDE)
    x0 = F.when(quadrant.isin(1, 4), 180.0).when(quadrant.isin(2, 3), 0.0)
    y0 = F.when(quadrant.isin(1, 2), 90.0).when(quadrant.isin(3, 4), 0.0)
    c = grid_id_to_coord(
        g % QUADRANT_STRIDE, x0, y0, x0 + 180, y0 + 90, cell_width, cell_height
    )
    return F.struct((c["x"] - 180).alias("x"), (c["y"] - 90).alias("y"))


def grid_id_to_wgs84_envelope(grid_id: Arg, cell_width: Arg, cell_height: Arg) -> Column:
    """Rectangle of a geographic cell; null (not empty) for a bad id."""
    c = grid_id_to_wgs84_coord(grid_id, cell_width, cell_height)
    return F.when(
        c["x"].isNotNull() & c["y"].isNotNull(),
        box(c["x"], c["y"], c["x"] + dbl(cell_width), c["y"] + dbl(cell_height)),
    )


def modulo_int(a: Arg, b: Arg, kind: str = "bigint") -> Column:
    """As :func:`modulo` for whole numbers, exact over all 64 bits; over 38 digits
    if worked out in the ``kind`` ``decimal(38,0)``."""
    n, d = col(a).cast(kind), col(b).cast(kind)
    rest = n % d
    return F.when((rest != 0) & ((rest < 0) != (d < 0)), rest + d).otherwise(rest)


def modulo(a: Arg, b: Arg) -> Column:
    """a - b * floor(a / b): the result has the divisor's sign."""
    n, d = dbl(a), dbl(b)
    return n - d * F.floor(n / d)


def gid_to_coord(
    grid_id: Arg, x_min: Arg, y_min: Arg, x_max: Arg, y_max: Arg, cell_width: Arg, cell_height: Arg
) -> Column:
    """Struct(id, x, y) of the corner; x and y null when the id is not in the grid."""
    c = grid_id_to_coord(grid_id, x_min, y_min, x_max, y_max, cell_width, cell_height)
    return F.struct(big(grid_id).alias("id"), c["x"].alias("x"), c["y"].alias("y"))


def coord_to_gid(
    x: Arg, y: Arg, x_min: Arg, y_min: Arg, x_max: Arg, y_max: Arg, cell_width: Arg,
    cell_height: Arg,
) -> Column:
    """As :func:`coord_to_grid_id`, but NaN and infinite coordinates give null."""
    return coord_to_grid_id(
        x, y, x_min, y_min, x_max, y_max, cell_width, cell_height, nonfinite="null"
    )
