"""Degree-minute-second coordinates such as ``402443N`` or ``0034049W``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two or three degree digits are both published for longitudes.
_SHAPES = {"latitude": r"^(\d{2})(\d{2})(\d{2})([NS])$", "longitude": r"^(\d{2,3})(\d{2})(\d{2})([EW])$"}
_LIMITS = {"latitude": 90.0, "longitude": 180.0}


def _part(text: Column, axis: str, group: int) -> Column:
    return F.regexp_extract(F.upper(F.trim(text)), _SHAPES[axis], group)


def _number(text: Column, axis: str, group: int) -> Column:
    return _part(text, axis, group).try_cast("double")


def _size(text: Column, axis: str) -> Column:
    return _number(text, axis, 1) + _number(text, axis, 2) / 60 + _number(text, axis, 3) / 3600


def dms_is_valid(text: Column, axis: str) -> Column:
    """True for the shape of the axis, minutes < 60, seconds <= 60 and degrees in range; never NULL."""
    checks = (
        F.upper(F.trim(text)).rlike(_SHAPES[axis]) & (_number(text, axis, 2) < 60)
        & (_number(text, axis, 3) <= 60) & (_size(text, axis) <= _LIMITS[axis])
    )
    return F.coalesce(checks, F.lit(False))


def dms_to_degrees(text: Column, axis: str) -> Column:
    """Signed decimal degrees; south and west are negative; text invalid for the axis -> NULL."""
    size = _size(text, axis)
    signed = F.when(_part(text, axis, 4).isin("S", "W"), -size).otherwise(size)
    return F.when(dms_is_valid(text, axis), signed)
