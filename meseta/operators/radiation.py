"""Radiation network report: free text to one row per station, type and solar time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meseta.catalog import RADIATION_TYPES
from meseta.functions import instant_with, parse_double, solar_clock

_CELL_BREAK = "\x01"


def _slots(first: float, last: float, step: float) -> int:
    return int((last - first) / step) + 1


def _by_type(code: Column, value_of) -> Column:
    choice = F.lit(None)
    for name, rule in RADIATION_TYPES.items():
        choice = F.when(code == name, F.lit(value_of(rule))).otherwise(choice)
    return choice


def _width(code: Column) -> Column:
    return _by_type(code, lambda rule: _slots(*rule[1:4]))


def _cells(line: Column) -> Column:
    """Cells of a ``;`` separated line; quotes protect separators and are removed.

    Splitting at quotes alternates text outside and inside of them. Only outside
    text separates cells; an empty outside piece between two inside pieces is a
    doubled, hence literal, quote.
    """
    pieces = F.split(line, '"')
    last = F.size(pieces) - 1

    def unquote(piece: Column, at: Column) -> Column:
        outside = F.replace(piece, F.lit(";"), F.lit(_CELL_BREAK))
        literal = (piece == "") & (at > 0) & (at < last)
        return F.when(at % 2 == 1, piece).when(literal, F.lit('"')).otherwise(outside)

    return F.split(F.array_join(F.transform(pieces, unquote), ""), _CELL_BREAK)


def _cell(cells: Column, at: Column) -> Column:
    return F.trim(F.get(cells, at))


def _block_starts(cells: Column) -> Column:
    """Zero-based positions of the blocks of one line.

    A block is its code, one cell per solar time and the daily total. The walk
    over the cells that hold a code skips what a block covers, so a start
    depends on the blocks before it; a block cut off by the end of the line ends
    the walk. A line without station name or id has no blocks.
    """
    named = (_cell(cells, F.lit(0)) != "") & (_cell(cells, F.lit(1)) != "")
    positions = F.when(named & (F.size(cells) >= 3), F.sequence(F.lit(2), F.size(cells) - 1))
    codes = F.filter(positions, lambda at: _cell(cells, at).isin(*RADIATION_TYPES))
    nothing = F.struct(F.lit(2).alias("free"), F.array().cast("array<int>").alias("starts"))

    def step(state: Column, at: Column) -> Column:
        end = at + _width(_cell(cells, at)) + 1
        taken = F.struct(
            (end + 1).alias("free"), F.array_append(state["starts"], at).alias("starts"))
        stopped = F.struct((F.size(cells) + 1).alias("free"), state["starts"].alias("starts"))
        return F.when(at < state["free"], state).when(end < F.size(cells), taken).otherwise(stopped)

    return F.aggregate(codes, nothing, step)["starts"]


def parse_radiation(df: DataFrame, text: str = "value", carried: tuple[str, ...] = ()) -> DataFrame:
    """Long table of all reports in ``df``, one report per row.

    A report needs a title, a readable date, a header of three columns or more and at
    least one station line; anything else stops the query.
    """
    lines = F.split(F.regexp_replace(F.col(text), r"[\r\n]+$", ""), r"\r?\n")
    reported = instant_with(_cell(_cells(F.get("_lines", F.lit(1))), F.lit(0)), "dd-MM-yy").cast("date")
    header = F.size(_cells(F.get("_lines", F.lit(2))))

    def refuse(why: str) -> Column:
        return F.raise_error(F.lit(f"Radiation report with {why}")).cast("array<string>")

    # on the lines themselves, so that no selection of columns prunes the checks away
    checked = F.when(F.coalesce(F.size("_lines"), F.lit(0)) < 4, refuse("fewer than 4 lines")).when(
        reported.isNull(), refuse("an unreadable date")).when(
        F.coalesce(header, F.lit(0)) < 3, refuse("a header of fewer than 3 columns")).otherwise(F.col("_lines"))
    stations = df.select(*carried, lines.alias("_lines")).select(
        *carried,
        reported.alias("observation_date"),
        F.explode(F.slice(checked, F.lit(4), F.greatest(F.size("_lines") - 3, F.lit(0)))).alias("_line"),
    ).select(*carried, "observation_date", _cells(F.col("_line")).alias("_cells"))

    kept = [*carried, "observation_date"]
    blocks = stations.select(*kept, "_cells", F.explode(_block_starts(F.col("_cells"))).alias("_at"))
    code = _cell(F.col("_cells"), F.col("_at"))
    total = F.get("_cells", F.col("_at") + _width(code) + 1)
    labels = ["station_name", "station_id", "radiation_type", "daily_total"]
    slots = blocks.select(
        *kept,
        _cell(F.col("_cells"), F.lit(0)).alias("station_name"),
        _cell(F.col("_cells"), F.lit(1)).alias("station_id"),
        code.alias("radiation_type"),
        parse_double(total).alias("daily_total"),
        F.slice("_cells", F.col("_at") + 2, _width(code)).alias("_values"),
    ).select(*kept, *labels, F.posexplode("_values").alias("_slot", "_raw"))
    code = F.col("radiation_type")
    clock = _by_type(code, lambda rule: rule[1]) + F.col("_slot") * _by_type(code, lambda rule: rule[3])
    return slots.select(
        *carried, "station_name", "station_id", "observation_date", "radiation_type",
        solar_clock(clock).alias("solar_time"),
        parse_double(F.col("_raw")).alias("value"),
        _by_type(code, lambda rule: rule[0]).alias("unit"),
        "daily_total",
        _by_type(code, lambda rule: rule[4]).alias("temporal_granularity"),
    )
