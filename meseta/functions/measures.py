"""Numeric rules: directions, power and energy, fallbacks, bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Below this resultant length the directions cancel out and no mean exists.
CANCELLED = 1e-9


def circular_mean(degrees: Column) -> Column:
    """Aggregate: mean direction in [0, 360); NULL when the directions cancel out.

    Two plain averages, so Spark combines partial results before the shuffle.
    """
    angle = F.radians(degrees.cast("double"))
    east, north = F.avg(F.sin(angle)), F.avg(F.cos(angle))
    turned = F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0))
    # a tiny negative angle wraps to exactly 360.0 in floating point
    wrapped = F.when(turned >= 360.0, F.lit(0.0)).otherwise(turned)
    return F.when(F.hypot(east, north) >= CANCELLED, wrapped)


def power_to_energy(megawatts: Column, minutes: int) -> Column:
    """Energy of one interval in MWh; the sign of the power is kept."""
    return megawatts * F.lit(minutes / 60.0)


def fallback(options: list[tuple[str, Column]]) -> tuple[Column, Column]:
    """First non-NULL value and the name of the source that supplied it."""
    value = F.coalesce(*[column for _, column in options])
    source = F.lit(None).cast("string")
    for name, column in reversed(options):
        source = F.when(column.isNotNull(), F.lit(name)).otherwise(source)
    return value, source


def bin_floor(value: Column, width: float) -> Column:
    """Lower edge of the bin of ``width`` that holds ``value``."""
    return F.floor(value / F.lit(width)) * F.lit(width)


def sector(degrees: Column, sectors: int = 8) -> Column:
    """Sector number 0..sectors-1, sector 0 centred on north."""
    span = 360.0 / sectors
    centred = F.pmod(degrees.cast("double") + F.lit(span / 2), F.lit(360.0))
    return F.floor(centred / F.lit(span)).cast("int")
