"""Checks and classifications of vessel identifiers (MMSI, IMO)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import Arg, big, digits, idiv

# Service types by the digit that follows the identifier's prefix.
COAST_BY_DIGIT = {
    "1": "cost station",
    "2": "port station",
    "3": "pilot station",
    "4": "ais repeater station",
    "5": "ais base station",
}
AIRCRAFT_BY_DIGIT = {"1": "fixed-wing aircraft", "5": "helicopter"}
ATON_BY_DIGIT = {"1": "physical ais aton", "6": "virtual ais aton", "8": "mobile aton"}
SPECIAL_BY_PREFIX = {
    "970": "ais-sart",
    "972": "man overboard",
    "974": "epirb-ais",
    "979": "amrd group b",
}
SHIP = "ship"
SHIP_GROUP = "ship group"
CHILD_CRAFT = "deployable child craft"
HANDHELD = "handheld vhf transceiver with dsc and integral gnss receiver"
UNKNOWN = "unknown"


def is_valid_mmsi(mmsi: Arg) -> Column:
    """At most nine digits; null stays null."""
    return F.length(digits(mmsi)) <= 9


def _padded(mmsi: Arg) -> Column:
    return F.lpad(digits(mmsi), 9, "0")


def _choose(key: Column, names: dict[str, str]) -> Column:
    chain = None
    for value, name in names.items():
        chain = F.when(key == value, name) if chain is None else chain.when(key == value, name)
    return chain.otherwise(UNKNOWN)


def mmsi_to_radio_service_type(mmsi: Arg) -> Column:
    """Kind of radio service the number range is set aside for."""
    m = _padded(mmsi)
    one, two, three = F.substring(m, 1, 1), F.substring(m, 1, 2), F.substring(m, 1, 3)
    return (
        F.when(two == "00", _choose(F.substring(m, 6, 1), COAST_BY_DIGIT))
        .when(one == "0", SHIP_GROUP)
        .when(one.between("2", "7"), SHIP)
        .when(three == "111", _choose(F.substring(m, 7, 1), AIRCRAFT_BY_DIGIT))
        .when(two == "99", _choose(F.substring(m, 6, 1), ATON_BY_DIGIT))
        .when(two == "98", CHILD_CRAFT)
        .when(one == "8", HANDHELD)
        .otherwise(_choose(three, SPECIAL_BY_PREFIX))
    )


def mmsi_to_mid(mmsi: Arg) -> Column:
    """Country digits of the number, null where the range carries none."""
    m = _padded(mmsi)
    one, two, three = F.substring(m, 1, 1), F.substring(m, 1, 2), F.substring(m, 1, 3)
    start = (
        F.when(two.isin("00", "98", "99"), 3)
        .when(one.isin("0", "8"), 2)
        .when(three == "111", 4)
        .when(one.between("2", "7"), 1)
    )
    return F.substring(m, start, F.lit(3)).try_cast("int")


def imo_checksum(imo: Arg) -> Column:
    """Struct(check_digit, comp_check_digit); null unless the number has seven digits."""
    n = big(imo)
    weighted = sum((idiv(n, 10 ** (w - 1)) % 10 * w for w in range(3, 8)), idiv(n, 10) % 10 * 2)
    return F.when(
        n.between(1000000, 9999999),
        F.struct(
            (n % 10).cast("int").alias("check_digit"),
            (weighted % 10).cast("int").alias("comp_check_digit"),
        ),
    )


def is_valid_imo(imo: Arg) -> Column:
    """Seven digits with a right check digit; null counts as false."""
    c = imo_checksum(imo)
    return F.coalesce(c["check_digit"] == c["comp_check_digit"], F.lit(False))
