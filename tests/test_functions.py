import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from meseta import functions as fn


def values(spark, rows, expression, schema="v string"):
    frame = spark.createDataFrame([(row,) for row in rows], schema)
    return [row[0] for row in frame.select(expression(F.col("v"))).collect()]


def test_decimal_comma(spark):
    texts = ["12,5", "3.25", "", "   ", None, "Ip", "1994,5872", "-2,5"]
    assert values(spark, texts, fn.decimal_comma) == [12.5, 3.25, None, None, None, None, 1994.5872, -2.5]


def test_blank_to_null(spark):
    assert values(spark, ["abc", "", "   ", None, " xyz "], fn.blank_to_null) == ["abc", None, None, None, "xyz"]


@pytest.mark.parametrize("name, plain", [
    ("Almería", "ALMERIA"), (" Ávila ", "AVILA"), ("Castelló/Castellón", "CASTELLO/CASTELLON"),
    ("Araba/Álava", "ARABA/ALAVA"), ("Logroño", "LOGRONO"), ("Barça", "BARCA"), ("Güímar", "GUIMAR"),
    ("Jaén", "JAEN"), ("Łódź", "ŁODZ"), ("Šibenik", "SIBENIK"), ("Ệ", "E"),
])
def test_plain_name(spark, name, plain):
    assert values(spark, [name], fn.plain_name) == [plain]


@pytest.mark.parametrize("text, degrees", [
    ("402443N", 40 + 24 / 60 + 43 / 3600), ("0034049W", -(3 + 40 / 60 + 49 / 3600)), ("9990000N", None),
    ("910000N", None), ("1810000E", None), ("0402443N", None),
    ("394924S", -39.82333333333334), ("025309E", 2.8858333333333333), ("025309W", -2.8858333333333333),
    ("364460N", 36.75), ("", None), ("394924X", None), ("3949N", None), ("396024N", None),
    ("394961N", None), (None, None),
])
def test_dms(spark, text, degrees):
    axis, other = ("longitude", "latitude") if text and text[-1] in "EW" else ("latitude", "longitude")
    found, valid, crossed = spark.createDataFrame([(text,)], "v string").select(
        fn.dms_to_degrees(F.col("v"), axis), fn.dms_is_valid(F.col("v"), axis),
        fn.dms_is_valid(F.col("v"), other)).first()
    assert not crossed
    assert valid is (degrees is not None)
    assert found == (None if degrees is None else pytest.approx(degrees))


def test_instants_are_lenient(spark):
    texts = ["2026-08-18T14:00:00+02:00", "2026-08-18T12:00:00Z", "2026-08-18T14:00", "bad", None]
    noon = dt.datetime(2026, 8, 18, 12)
    found = values(spark, texts, lambda c: fn.instant(c).cast("timestamp_ntz"))
    assert found == [noon, noon, dt.datetime(2026, 8, 18, 14), None, None]
    assert values(spark, ["2026-08-17", "17/08/2026", None], fn.day) == [dt.date(2026, 8, 17), None, None]


@pytest.mark.parametrize("grain, floor", [
    ("FIVE_MINUTES", (14, 40)), ("FIFTEEN_MINUTES", (14, 30)), ("HOUR", (14, 0)),
])
def test_floor_grain(spark, grain, floor):
    found = values(spark, ["2026-08-18 14:44:59.999"], lambda c: fn.floor_grain(
        c.cast("timestamp"), grain).cast("timestamp_ntz"))
    assert found == [dt.datetime(2026, 8, 18, *floor)]


def test_civil_month_starts_in_the_previous_utc_month(spark):
    found = values(spark, ["2026-06-30T22:00:00Z", "2026-12-31T23:00:00Z"],
                   lambda c: fn.civil_month(fn.instant(c)))
    assert found == ["2026-07", "2027-01"]


def test_solar_clock(spark):
    assert values(spark, [5.0, 5.5, 20.0, 24.0], fn.solar_clock, "v double") == ["05:00", "05:30", "20:00", "24:00"]


def circular(spark, degrees):
    frame = spark.createDataFrame([(float(d),) for d in degrees], "v double")
    return frame.agg(fn.circular_mean(F.col("v"))).first()[0]


def test_circular_mean(spark):
    assert circular(spark, [350, 10, 30]) == pytest.approx(10)
    assert circular(spark, [0, 180]) is None
    assert circular(spark, [90]) == pytest.approx(90)
    mean = circular(spark, [359.9999999, 0.0000001])
    assert 0 <= mean < 360 and min(mean, 360 - mean) == pytest.approx(0, abs=1e-6)


@pytest.mark.parametrize("turn", [0, 45, 123.4, 300])
def test_circular_mean_turns_with_its_input(spark, turn):
    base = circular(spark, [10, 50, 80])
    turned = circular(spark, [(d + turn) % 360 for d in (10, 50, 80)])
    assert math.isclose((turned - base) % 360, turn % 360, abs_tol=1e-6)


def test_fallback_keeps_zero(spark):
    frame = spark.createDataFrame([(None, 21.5), (0.0, 3.0), (None, None)], "a double, b double")
    value, source = fn.fallback([("AEMET", F.col("a")), ("OPEN_METEO", F.col("b"))])
    assert [tuple(r) for r in frame.select(value, source).collect()] == [
        (21.5, "OPEN_METEO"), (0.0, "AEMET"), (None, None)]


def test_energy_keeps_sign(spark):
    assert values(spark, [-60.0, 120.0], lambda c: fn.power_to_energy(c, 5), "v double") == pytest.approx([-5, 10])


def test_surrogate_key_needs_all_parts(spark):
    found = values(spark, ["08", None], lambda c: fn.surrogate_key(F.lit("PROVINCE"), c))
    assert found == ["PROVINCE|08", None]


def test_sector(spark):
    assert values(spark, [0.0, 359.0, 22.5, 90.0, 337.4], fn.sector, "v double") == [0, 0, 1, 2, 7]
