"""Column -> Column building blocks; everything stays in built-in expressions."""

from meseta.functions.coordinates import dms_is_valid, dms_to_degrees
from meseta.functions.measures import (
    bin_floor,
    circular_mean,
    fallback,
    power_to_energy,
    sector,
)
from meseta.functions.text import (
    blank_to_null,
    decimal_comma,
    parse_double,
    plain_name,
    surrogate_key,
    windows_1252,
)
from meseta.functions.time import (
    calendar_parts,
    civil_month,
    day,
    floor_grain,
    instant,
    instant_with,
    minutes_between,
    month_label,
    shift_hours,
    solar_clock,
)

__all__ = [
    "bin_floor",
    "blank_to_null",
    "calendar_parts",
    "circular_mean",
    "civil_month",
    "day",
    "decimal_comma",
    "dms_is_valid",
    "dms_to_degrees",
    "fallback",
    "floor_grain",
    "instant",
    "instant_with",
    "minutes_between",
    "month_label",
    "parse_double",
    "plain_name",
    "power_to_energy",
    "sector",
    "shift_hours",
    "solar_clock",
    "surrogate_key",
    "windows_1252",
]
