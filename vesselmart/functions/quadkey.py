"""Tile quadkeys: text, tile and integer forms.

A quadkey is a base-4 number, so every form is a change of base; no digit loop
is needed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import Arg, big, col, dbl

MAX_DIGITS = 32  # of a 64-bit key
NARROW = 18  # decimal digits that surely fit a 64-bit integer


def _clean(quadkey: Arg) -> Column:
    q = col(quadkey)
    return F.when(q.rlike("[^0-3]"), F.regexp_replace(q, "[^0-3]", "")).otherwise(q)


def _bits(quadkey: Arg) -> Column:
    """Last 64 bits of the cleaned key as a signed number, null for an empty one.

    One expression for all encoders, so that a query with several of them works it
    out once a row.
    """
    return F.conv(F.substring(_clean(quadkey), -MAX_DIGITS, MAX_DIGITS), 4, -10).cast("bigint")


def quadkey_bit_encode(quadkey: Arg) -> Column:
    """Two bits per digit as text; other characters are skipped, empty gives null."""
    clean = _clean(quadkey)
    text = F.lpad(F.bin(_bits(quadkey)), F.length(clean) * 2, F.lit("0"))
    longer = F.translate(clean, "0123", "abcd")
    for letter, pair in (("a", "00"), ("b", "01"), ("c", "10"), ("d", "11")):
        longer = F.replace(longer, F.lit(letter), F.lit(pair))
    return F.when(F.length(clean) <= MAX_DIGITS, text).otherwise(longer)


def _encode(quadkey: Arg, width: int, signed: bool) -> Column:
    clean, bits = _clean(quadkey), _bits(quadkey)
    too_wide = F.raise_error(
        F.concat(F.lit("quadkey does not fit "), F.lit(str(width)), F.lit(" bits: "), clean)
    )
    # added, as both sides of a sum are worked out in any case and so can be shared
    fits = F.when(F.length(clean) > width // 2, too_wide.cast("bigint")).otherwise(0)
    if signed and width < 64:
        bits = F.shiftright(F.shiftleft(bits, 64 - width), 64 - width)
    elif not signed and width == 64:
        wrapped = F.when(bits < 0, F.lit(str(2**64))).otherwise("0").cast("decimal(20,0)")
        return (bits.cast("decimal(20,0)") + wrapped + fits).cast("decimal(20,0)")
    return bits + fits


def quadkey_int16_encode(quadkey: Arg) -> Column:
    return _encode(quadkey, 16, True).cast("smallint")


def quadkey_int32_encode(quadkey: Arg) -> Column:
    return _encode(quadkey, 32, True).cast("int")


def quadkey_int64_encode(quadkey: Arg) -> Column:
    return _encode(quadkey, 64, True)


def quadkey_uint16_encode(quadkey: Arg) -> Column:
    return _encode(quadkey, 16, False).cast("int")


def quadkey_uint32_encode(quadkey: Arg) -> Column:
    return _encode(quadkey, 32, False)


def quadkey_uint64_encode(quadkey: Arg) -> Column:
    """Decimal(20,0): a full-depth key needs 64 unsigned bits."""
    return _encode(quadkey, 64, False)


def quadkey_to_zxy(quadkey: Arg) -> Column:
    """Struct(z, x, y); null for an empty key. Other characters count as 0."""
    q = F.regexp_replace(col(quadkey), "[^0-3]", "0")
    return F.when(
        F.length(q) > 0,
        F.struct(
            F.length(q).alias("z"),
            F.conv(F.translate(q, "0123", "0101"), 2, 10).cast("bigint").alias("x"),
            F.conv(F.translate(q, "0123", "0011"), 2, 10).cast("bigint").alias("y"),
        ),
    )


def zxy_to_quadkey(z: Arg, x: Arg, y: Arg) -> Column:
    """Interleave tile numbers; bits above the zoom level are ignored.

    Binary texts read as decimal numbers are added, the row's twice: no digit is
    above 3, so nothing is carried.
    """
    zoom = col(z).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), zoom) - 1
    column, row = big(x).bitwiseAND(mask), big(y).bitwiseAND(mask)

    def woven(a: Column, b: Column) -> Column:
        return (F.bin(a).cast("bigint") + F.bin(b).cast("bigint") * 2).cast("string")

    low = woven(column.bitwiseAND(2**NARROW - 1), row.bitwiseAND(2**NARROW - 1))
    high = woven(F.shiftright(column, NARROW), F.shiftright(row, NARROW))
    # levels above what one integer holds are worked out apart
    return F.when(zoom <= NARROW, F.lpad(low, zoom, F.lit("0"))).otherwise(
        F.concat(
            F.lpad(high, zoom - NARROW, F.lit("0")), F.lpad(low, F.lit(NARROW), F.lit("0"))
        )
    )


def int_to_quadkey(value: Arg, z: Arg) -> Column:
    """Last 2*z bits of the two's complement as z digits (at most 32); null for z below 1."""
    zoom = F.least(col(z).cast("int"), F.lit(32))
    mask = F.when(zoom >= 32, F.lit(-1).cast("bigint")).otherwise(
        F.call_function("shiftleft", F.lit(1).cast("bigint"), zoom * 2) - 1
    )
    digits = F.lpad(F.conv(big(value).bitwiseAND(mask).cast("string"), 10, 4), zoom, F.lit("0"))
    return F.when(zoom >= 1, digits)


def get_zxy(lon: Arg, lat: Arg, zoom: Arg) -> Column:
    """Web-Mercator tile as struct(z, x, y); null where the projection has no value."""
    z = col(zoom).cast("int")
    n = F.pow(F.lit(2.0), z)
    rad = F.radians(dbl(lat))
    x = (dbl(lon) + 180.0) / 360.0 * n
    y = (F.lit(1.0) - F.ln(F.tan(rad) + F.lit(1.0) / F.cos(rad)) / math.pi) / 2.0 * n
    # NaN compares above every number, so it fails the bound as well
    return F.when(
        (F.abs(x) < 2.0**62) & (F.abs(y) < 2.0**62),
        F.struct(z.alias("z"), x.cast("bigint").alias("x"), y.cast("bigint").alias("y")),
    )


def _checked(quadkey: Column) -> Column:
    """The key itself; a character that is no digit of base 4 is an error."""
    bad = F.raise_error(F.concat(F.lit("not a quadkey: "), quadkey)).cast("string")
    return F.when(quadkey.rlike("[^0-3]"), bad).otherwise(quadkey)


def quadkey_to_int(quadkey: Arg) -> Column:
    """Unsigned base-4 value; the empty key is 0, any other character an error."""
    q = col(quadkey)
    return F.when(q == "", F.lit(0)).otherwise(F.conv(_checked(q), 4, 10).cast("bigint"))


def int_to_quadkey_bytes(value: Arg, zoom: Arg) -> Column:
    """Digits of the value's whole bytes: 4*ceil(zoom/4) of them.

    A value that does not fit that many signed bytes is an error.
    """
    depth = (F.ceil(col(zoom) / 4) * 4).cast("int")
    v = big(value)
    half = F.pow(F.lit(4.0), depth) / 2
    fits = (v.cast("double") >= -half) & (v.cast("double") < half) | (depth >= 32)
    return F.when(fits, int_to_quadkey(v, depth)).otherwise(
        F.raise_error(F.concat(F.lit("integer does not fit the zoom level: "), digits_of(v)))
    )


def digits_of(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("null"))


def compute_qkey_range(quadkey: Arg, partition_depth: int = 8) -> Column:
    """Struct(lo, hi): partition keys at the given depth that a quadkey covers."""
    q = F.substring(_checked(col(quadkey)), 1, partition_depth)
    return F.struct(
        quadkey_to_int(F.rpad(q, partition_depth, "0")).alias("lo"),
        quadkey_to_int(F.rpad(q, partition_depth, "3")).alias("hi"),
    )
