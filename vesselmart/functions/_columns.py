"""Argument helpers shared by the column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Arg = Column | str | int | float


def col(value: Arg) -> Column:
    """Column as given, string as a column name, number as a literal."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.col(value)
    return F.lit(value)


def dbl(value: Arg) -> Column:
    return col(value).cast("double")


def big(value: Arg) -> Column:
    return col(value).cast("bigint")


def idiv(a: Column, b: Column | int) -> Column:
    """Whole-number division (truncates), kept in integer arithmetic."""
    return F.call_function("div", a, F.lit(b) if isinstance(b, int) else b)


def digits(value: Arg) -> Column:
    """Text of a whole number."""
    return col(value).cast("string")


def positive(value: Arg, name: str) -> None:
    """Reject a literal zero or negative size when the plan is built."""
    if isinstance(value, (int, float)) and not value > 0:
        raise ValueError(f"{name} must be positive, got {value}")
