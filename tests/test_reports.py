import datetime as dt

import pytest
from pyspark.sql import functions as F

from meseta.operators import radiation, ranges


def report(*stations):
    header = '"Estación";"Indicativo";"Tipo";' + ";".join(f'"{h}"' for h in range(5, 21)) + ';"SUMA"'
    return "\n".join(['"RADIACION SOLAR"', '"13-08-26"', header, *stations]) + "\n"


def cells(*values):
    return ";".join(f'"{v}"' for v in values)


def parse(spark, text):
    return radiation.parse_radiation(spark.createDataFrame([(text,)], "value string"))


def test_one_hourly_block(spark):
    rows = parse(spark, report(cells("Test Station", "TEST", "GL", *range(16), 120))).orderBy("solar_time").collect()
    assert len(rows) == 16
    assert rows[0].asDict() == {
        "station_name": "Test Station", "station_id": "TEST", "observation_date": dt.date(2026, 8, 13),
        "radiation_type": "GL", "solar_time": "05:00", "value": 0.0, "unit": "10*kJ/m2", "daily_total": 120.0,
        "temporal_granularity": "1h"}
    assert (rows[-1]["solar_time"], rows[-1]["value"]) == ("20:00", 15.0)


def test_blocks_repeat_along_the_row(spark):
    line = cells("S;1", "ID", "GL", *range(16), 1, "UVB", *range(32), 2, "", "IR", *range(24), 3)
    found = parse(spark, report(line)).groupBy("radiation_type").agg(
        F.count(F.lit(1)), F.min("solar_time"), F.max("solar_time"), F.first("daily_total"), F.first("station_name"))
    assert {tuple(r) for r in found.collect()} == {
        ("GL", 16, "05:00", "20:00", 1.0, "S;1"), ("UVB", 32, "04:30", "20:00", 2.0, "S;1"),
        ("IR", 24, "01:00", "24:00", 3.0, "S;1")}


def test_cut_off_block_ends_the_row(spark):
    line = cells("S", "ID", "DF", *range(16), 1, "IR", *range(10))
    assert parse(spark, report(line)).count() == 16
    # a cut-off block in front hides what follows, even another code
    assert parse(spark, report(cells("S", "ID", "IR", *range(3), "DF", *range(16), 1))).count() == 0


def test_odd_cells(spark):
    blank = cells("S", "ID", "GL", *["" if h % 2 else "x" for h in range(16)], "")
    rows = parse(spark, report(blank, cells("", "ID", "GL", *range(16), 1), cells("S", "ID"))).collect()
    assert len(rows) == 16 and all(r["value"] is None and r["daily_total"] is None for r in rows)
    quoted = parse(spark, report('"A ""B"" C";"ID";' + cells("GL", *range(16), 1))).first()
    assert quoted["station_name"] == 'A "B" C'


@pytest.mark.parametrize("second, third, why", [
    ("no date", '"a";"b";"c"', "unreadable date"), ('"13-08-26"', '"a";"b"', "fewer than 3 columns")])
def test_unreadable_report_is_rejected(spark, second, third, why):
    line = cells("S", "ID", "GL", *range(16), 1)
    with pytest.raises(Exception, match=why):
        parse(spark, "\n".join(["title", second, third, line])).select("value").collect()


@pytest.mark.parametrize("text", ["", "a\nb\nc", "a\nb\nc\n\n"])
def test_short_report_is_rejected(spark, text):
    with pytest.raises(Exception, match="fewer than 4 lines"):
        parse(spark, text).collect()


def tiles(spark, start, end, days):
    frame = spark.createDataFrame([("e", start, end)], "entity string, first date, last date")
    return [tuple(r) for r in ranges.tile_ranges(frame, "first", "last", days).orderBy("window_index").collect()]


def test_tiling(spark):
    d = dt.date
    assert tiles(spark, d(2026, 1, 1), d(2026, 3, 5), 31) == [
        ("e", 0, d(2026, 1, 1), d(2026, 1, 31)), ("e", 1, d(2026, 2, 1), d(2026, 3, 3)),
        ("e", 2, d(2026, 3, 4), d(2026, 3, 5))]
    assert tiles(spark, d(2026, 1, 1), d(2026, 1, 1), 1) == [("e", 0, d(2026, 1, 1), d(2026, 1, 1))]
    with pytest.raises(ValueError):
        tiles(spark, d(2026, 1, 1), d(2026, 1, 1), 0)
    with pytest.raises(Exception, match="after its end"):
        tiles(spark, d(2026, 1, 2), d(2026, 1, 1), 5)


def test_window_coverage(spark):
    d = dt.date
    frame = spark.createDataFrame([("e", d(2026, 1, 1), d(2026, 1, 7))], "entity string, first date, last date")
    windows = ranges.tile_ranges(frame, "first", "last", 3)
    seen = spark.createDataFrame([("e", d(2026, 1, 2)), ("e", d(2026, 1, 2)), ("e", d(2026, 1, 7))], "entity string, at date")
    found = ranges.window_coverage(windows, seen, ["entity"], "at", 3).orderBy("window_index").collect()
    assert [r["n_observations"] for r in found] == [2, 0, 1]
