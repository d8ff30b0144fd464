"""Hierarchical decimal cell keys.

A key is a leading 1 followed by one two-digit cell (10 * row + column) per
factor-ten refinement of a base cell.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import Arg, big, col, dbl, digits, idiv
from .grid import grid_id_to_coord

MAX_DEPTH = 9  # a 64-bit key has room for the leading 1 and nine cells


def gchain_levels(base_size: int | float) -> int:
    """Refinements below a base cell: 2 for a base size of 1000."""
    levels, size = -1, float(base_size)
    while size > 1 and size % 10 == 0:
        size, levels = size / 10, levels + 1
    if size != 1 or levels < 0:
        raise ValueError(f"base size must be a power of ten above 1, got {base_size}")
    if levels > MAX_DEPTH:
        raise ValueError(f"a key has room for {MAX_DEPTH} levels, base size {base_size} has {levels}")
    return levels


def to_gchain_key(
    x: Arg, y: Arg, x_min: Arg, y_min: Arg, x_max: Arg, y_max: Arg, base_size: int | float
) -> Column:
    """Key of the finest cell that holds the point, -1 outside the base grid.

    The base cell itself is not part of the key. Along each axis the place within
    the base cell is counted once in finest cells, and every level is a digit of
    that number, so the expression grows with the number of levels.
    """
    levels = gchain_levels(base_size)
    size = float(base_size)
    key = F.lit(100**levels).cast("bigint")
    inside = []
    for place, value, low, high in ((1, dbl(x), x_min, x_max), (10, dbl(y), y_min, y_max)):
        base = (value - dbl(low)) / size
        # compared as they are, cells need not be rounded down; NaN is above every number
        inside += [base >= 0, base < F.floor((dbl(high) - dbl(low)) / size).cast("double")]
        steps = _steps(value - (F.floor(base) * size + dbl(low)), levels)
        key = key + (_every_second(steps, levels) * place if place > 1 else _every_second(steps, levels))
    return F.when(reduce(lambda a, b: a & b, inside), key).otherwise(F.lit(-1).cast("bigint"))


def _steps(rest: Column, levels: int) -> Column:
    """Finest cells before a place within its base cell, along one axis.

    The finest cells are ten units wide. Rounding on fractional bounds cannot
    carry a place past the base cell.
    """
    last = 10**levels - 1
    return F.floor(F.greatest(F.lit(0.0), F.least(F.lit(float(last)), rest / 10.0)))


def _every_second(number: Column, levels: int) -> Column:
    """The number with a zero before each digit: 123 becomes 10203.

    With q(n) for the number without its last n digits, digit n is q(n) - 10 q(n + 1).
    """
    if levels < 2:
        return number
    parts = [idiv(number, 10**n) for n in reversed(range(1, levels))]
    return number + reduce(lambda a, b: a * 100 + b, parts) * 90


def gchain_depth(key: Arg) -> Column:
    return ((F.length(digits(key)) - 1) / 2).cast("int")


def gchain_trim_key(key: Arg, level: Arg) -> Column:
    """The key's ancestor at a level; a level below the key gives the key."""
    return F.substring(digits(key), F.lit(1), col(level) * 2 + 1).cast("bigint")


def gchain_segment(key: Arg, level: Arg) -> Column:
    """Two-digit cell at one level (1 is the coarsest), null below the key."""
    text = F.substring(digits(key), col(level) * 2, F.lit(2))
    return F.when(text != "", text.cast("int"))


def segment_gchain_key(key: Arg) -> Column:
    """All cells of the key, coarsest first. Keys of different depth may be mixed."""
    depth = gchain_depth(key)
    return F.when(depth == 0, F.array().cast("array<int>")).otherwise(
        F.transform(F.sequence(F.lit(1), depth), lambda level: gchain_segment(key, level))
    )


def assert_one_depth(key: Arg) -> Column:
    """Aggregate that fails when the keys differ in depth, and else gives the depth."""
    depth = gchain_depth(key)
    return F.when(F.min(depth) == F.max(depth), F.min(depth)).when(
        F.min(depth).isNotNull(), F.raise_error(F.lit("keys differ in depth")).cast("int")
    )


def gchain_key_to_bounds(
    key: Arg, ref_id: Arg, ref_x_min: Arg, ref_y_min: Arg, ref_x_max: Arg, ref_y_max: Arg,
    ref_size: Arg, depth: int | None = None,
) -> Column:
    """Struct(ref_id, gchain_key, x_min, y_min, x_max, y_max) of a key below a base cell.

    With ``depth``, every key must have that depth; without it keys of any depth
    may be mixed. Either way the key's digits give one whole number of finest
    cells along each axis, which is scaled once, so that the generated code stays
    small enough to be compiled.
    """
    k = big(key)
    start = grid_id_to_coord(
        ref_id, ref_x_min, ref_y_min, ref_x_max, ref_y_max, ref_size, ref_size
    )
    if depth is None:
        parts = F.pow(F.lit(10.0), gchain_depth(k))
        cell = dbl(ref_size) / parts
        # the leading 1 counts as a digit of the x axis
        column = _digits_of_axis(k, MAX_DEPTH + 1, 0) - parts.cast("bigint")
        row = _digits_of_axis(k, MAX_DEPTH, 1)
    else:
        cell = F.when(k.between(100**depth, 2 * 100**depth - 1), dbl(ref_size) / 10.0**depth).when(
            k.isNotNull(), F.raise_error(F.lit(f"a key is not {depth} levels deep")).cast("double")
        )
        column, row = _digits_of_axis(k, depth, 0), _digits_of_axis(k, depth, 1)
    corner_x, corner_y = start["x"] + column * cell, start["y"] + row * cell
    return F.struct(
        big(ref_id).alias("ref_id"), k.alias("gchain_key"),
        corner_x.alias("x_min"), corner_y.alias("y_min"),
        (corner_x + cell).alias("x_max"), (corner_y + cell).alias("y_max"),
    )


def _digits_of_axis(key: Column, levels: int, place: int) -> Column:
    """Number made of every second digit of the key: from the last (0) or last but one (1) on."""
    parts = [
        (idiv(key, 10**place * 100**n) if place or n else key) % 10 * 10**n for n in range(levels)
    ]
    return reduce(lambda a, b: a + b, parts) if parts else key * 0
