import datetime as dt

import pytest
from pyspark.sql import functions as F

from meseta import catalog
from meseta.operators import aggregate
from meseta.plans import gold

CREATED = dt.datetime(2026, 9, 1)
NOON = "2026-08-18 12:00:00"


def frame(spark, rows, schema):
    """Rows with text instants in the column ``observation_timestamp``."""
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("observation_timestamp", F.col("observation_timestamp").cast("timestamp"))


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def provinces(spark):
    return spark.createDataFrame(
        [("28", "Madrid", "13", "Comunidad de Madrid"), ("08", "Barcelona", "09", "Cataluña/Catalunya")],
        "province_code string, province_name string, autonomous_community_code string, autonomous_community_name string")


def points(spark, rows, **columns):
    """(station, province, instant) rows plus measures; missing measures are NULL."""
    names = {"temperature_2m": "double", "relative_humidity_2m": "bigint", "precipitation": "double",
             "shortwave_radiation": "double", "direct_normal_irradiance": "double", "wind_speed_80m": "double",
             "wind_speed_120m": "double", "wind_direction_80m": "bigint", "wind_direction_120m": "bigint"}
    data = [(*row[:3], *[(row[3] or {}).get(n) for n in names]) for row in rows]
    return frame(spark, data, "station_id string, province_code string, observation_timestamp string, "
                 + ", ".join(f"{n} {t}" for n, t in names.items()))


def energy(spark, rows):
    return frame(spark, rows, "indicator_id bigint, esios_geo_id bigint, province_code string, "
                 "observation_timestamp string, value double")


def test_province_hourly(spark, provinces):
    current = frame(spark, [
        ("A", "2026-08-18 12:10:00", 30.0, 40.0, None), ("B", "2026-08-18 12:50:00", 34.0, None, None),
        ("X", "2026-08-18 12:00:00", 99.0, 99.0, 99.0),
    ], "station_id string, observation_timestamp string, ta double, hr double, prec double")
    stations = spark.createDataFrame([("A", "28"), ("B", "28")], "station_id string, province_code string")
    hourly = points(spark, [
        ("P", "28", NOON, {"temperature_2m": 10.0, "relative_humidity_2m": 50, "precipitation": 0.0,
                           "shortwave_radiation": 100.0}),
        ("Q", "28", NOON, {"temperature_2m": 20.0, "relative_humidity_2m": 60, "precipitation": 2.0,
                           "shortwave_radiation": 300.0}),
        ("R", "08", NOON, {"temperature_2m": 21.5}),
    ])
    quarter = points(spark, [
        ("P", "28", "2026-08-18 12:00:00", {"wind_speed_80m": 1.0, "wind_direction_80m": 350}),
        ("P", "28", "2026-08-18 12:15:00", {"wind_speed_80m": 3.0, "wind_direction_80m": 10}),
        ("Q", "28", "2026-08-18 12:30:00", {"wind_speed_80m": 10.0, "wind_direction_80m": 20}),
    ])
    series = energy(spark, [
        (1161, 28, "28", "2026-08-18 11:00:00", 5.0), (10035, 28, "28", "2026-08-18 11:00:00", -4.0),
        (10195, 28, "28", "2026-08-18 11:00:00", 77.0), (1161, 8, "08", "2026-08-18 20:00:00", 1.0),
    ])
    fact = gold.fact_province_hourly(
        current, stations, hourly, quarter, series, provinces, created_at=CREATED)
    assert len(fact.columns) == 30
    at_noon = fact.filter((F.hour("gold_timestamp") == 12))
    madrid = at_noon.filter("province_code = '28'").drop("gold_timestamp", "gold_created_at").collect()
    assert len(madrid) == 1
    row = madrid[0].asDict()
    assert (row["temperature"], row["temperature_source"]) == (32.0, "AEMET")
    assert (row["humidity"], row["humidity_source"]) == (40.0, "AEMET")
    assert (row["precipitation"], row["precipitation_source"]) == (1.0, "OPEN_METEO")
    # per point first: (mean(1, 3) + 10) / 2, not the mean of the three samples
    assert row["wind_speed_80m"] == 6.0
    assert row["wind_direction_80m"] == pytest.approx(10)
    assert row["solar_radiation"] == 200.0
    assert (row["solar_photovoltaic_generation_mwh"], row["hydraulic_generation_mwh"]) == (5.0, -4.0)
    assert row["total_generation_mwh"] is None
    assert row["geography_key"] == "PROVINCE|28"
    assert rows_of(at_noon.filter("province_code = '08'"), "temperature", "temperature_source") == [
        (21.5, "OPEN_METEO")]
    # the late energy value has no weather and is still there, one hour later
    late = fact.filter(F.hour("gold_timestamp") == 21)
    assert rows_of(late, "province_code", "solar_photovoltaic_generation_mwh", "temperature") == [("08", 1.0, None)]
    assert fact.count() == 3


def test_two_values_for_one_metric_stop_the_build(spark):
    rows = spark.createDataFrame([(1, 7, 1.0), (1, 7, 2.0)], "k int, indicator int, v double")
    with pytest.raises(Exception, match="Several values"):
        aggregate.pivot_metrics(rows, ["k"], "indicator", "v", {7: "m"}, strict=True).collect()
    assert aggregate.pivot_metrics(rows, ["k"], "indicator", "v", {7: "m"}).first()["m"] == 2.0


def test_installed_capacity(spark):
    capacity = frame(spark, [
        (1475, 4, "Andalucía", "2026-06-30 22:00:00", 10.0), (1485, 4, "Andalucía", "2026-06-30 22:00:00", 20.0),
        (1475, 9, "Cataluña", "2026-06-30 22:00:00", 30.0), (1475, 9, "Cataluña", "2026-07-31 22:00:00", 31.0),
        (99, 9, "Cataluña", "2026-07-31 22:00:00", 1.0),
    ], "indicator_id bigint, esios_geo_id bigint, esios_geo_name string, observation_timestamp string, value double")
    communities = spark.createDataFrame(
        [("01", "Andalucía"), ("09", "Cataluña/Catalunya")],
        "autonomous_community_code string, autonomous_community_name string")
    fact = gold.fact_installed_capacity_monthly(capacity, communities, created_at=CREATED)
    assert rows_of(
        fact, "autonomous_community_code", "year_month", "hydraulic_installed_capacity_mw",
        "wind_installed_capacity_mw",
    ) == [("01", "2026-07", 10.0, 20.0), ("09", "2026-07", 30.0, None), ("09", "2026-08", 31.0, None)]
    months = fact.select(F.date_format("gold_month_timestamp", "yyyy-MM-dd").alias("m"), "year_month")
    assert all(r["m"] == f"{r['year_month']}-01" for r in months.collect())


def power(spark, rows):
    return frame(spark, rows, "indicator_id bigint, esios_geo_id bigint, observation_timestamp string, value double")


def test_five_minutes(spark):
    fact = gold.fact_country_5min(power(spark, [
        (1293, 8741, "2026-08-18 11:05:00", 120.0), (2065, 3, "2026-08-18 11:05:00", -60.0),
        (2042, 3, "2026-08-18 11:05:00", -12.0), (10004, 3, "2026-08-18 11:05:00", 5.0),
    ]), created_at=CREATED)
    assert len(fact.columns) == 28
    assert rows_of(fact, "geography_key", "geography_level", "real_demand_mw", "real_demand_energy_mwh_5min",
                   "pumping_consumption_power_mw", "pumping_consumption_energy_mwh_5min") == [
        ("COUNTRY|ES", "COUNTRY", None, None, -60.0, -5.0),
        ("PENINSULA|PENINSULA", "PENINSULA", 120.0, 10.0, None, None)]
    assert fact.filter((F.hour("gold_timestamp") == 12) & (F.minute("gold_timestamp") == 5)).count() == 2


def test_quarter_hours(spark):
    quarter = points(spark, [
        ("P1", "28", NOON, {"temperature_2m": 1.0, "wind_direction_80m": 350}),
        ("P2", "28", NOON, {"temperature_2m": 3.0, "wind_direction_80m": 10}),
        ("P3", "08", NOON, {"temperature_2m": 10.0, "wind_direction_80m": 20}),
    ])
    samples = [(2038, 3, f"2026-08-18 11:0{m}:00", v) for m, v in ((0, 120.0), (5, 240.0))]
    samples += [(2038, 3, "2026-08-18 11:10:00", 360.0), (2039, 3, "2026-08-18 11:00:00", 12.0),
                (1293, 8741, "2026-08-18 11:00:00", 12.0), (2038, 42, "2026-08-18 11:00:00", 12.0)]
    fact = gold.fact_country_15min(quarter, power(spark, samples), created_at=CREATED)
    assert len(fact.columns) == 25
    spain = fact.filter("geography_level = 'COUNTRY'").drop("gold_timestamp", "gold_created_at").collect()
    assert len(spain) == 1
    # mean of the provinces' means, not of the points
    assert spain[0]["temperature"] == 6.0
    assert spain[0]["wind_direction_80m"] == pytest.approx(10)
    assert spain[0]["wind_generation_energy_mwh_15min"] == pytest.approx(60)
    assert spain[0]["nuclear_generation_energy_mwh_15min"] is None
    peninsula = fact.filter("geography_level = 'PENINSULA'")
    assert rows_of(peninsula, "geography_name", "temperature", "real_demand_energy_mwh_15min") == [
        ("Peninsula", None, None)]
    # an id that is neither scope is kept without a level, for the level check to report
    unknown = fact.filter("geography_level IS NULL")
    assert rows_of(unknown, "geography_key", "geography_name") == [("UNKNOWN|42", None)]
    assert fact.count() == 3


def test_dim_time(spark):
    five = spark.createDataFrame([("2026-08-18 12:05:00",)] * 2, "t string").select(
        F.col("t").cast("timestamp").alias("gold_timestamp"))
    months = spark.createDataFrame([("2026-08",), ("2026-08",)], "year_month string")
    dim = gold.dim_time({"FIVE_MINUTES": five, "MONTH": months}, created_at=CREATED)
    assert rows_of(dim, "time_key", "year", "month", "hour", "minute", "day_of_week") == [
        ("FIVE_MINUTES|2026-08-18T12:05:00", 2026, 8, 12, 5, 3), ("MONTH|2026-08", 2026, 8, None, None, None)]


def test_dim_geography(spark, provinces):
    communities = provinces.select("autonomous_community_code", "autonomous_community_name")
    seen = spark.createDataFrame([("AUTONOMOUS_COMMUNITY|13", 8)], "geography_key string, esios_geo_id bigint")
    dim = gold.dim_geography(provinces, communities, created_at=CREATED, esios_ids=seen)
    found = {r["geography_key"]: (r["province_code"], r["country_code"], r["esios_geo_id"]) for r in dim.drop(
        "gold_created_at").collect()}
    assert found == {
        "PROVINCE|28": ("28", "ES", None), "PROVINCE|08": ("08", "ES", None),
        "AUTONOMOUS_COMMUNITY|13": (None, "ES", 8), "AUTONOMOUS_COMMUNITY|09": (None, "ES", None),
        "COUNTRY|ES": (None, "ES", 3), "PENINSULA|PENINSULA": (None, None, 8741)}
    assert set(catalog.GEOGRAPHY_LEVELS) == {r["geography_level"] for r in dim.collect()}


def test_excluded_indicators_have_no_metric():
    mapped = {*catalog.HOURLY_METRICS, *catalog.CAPACITY_METRICS, *catalog.NATIONAL_SERIES}
    assert not mapped & catalog.EXCLUDED_FROM_GOLD
    configured = {
        *catalog.HOURLY_ENERGY_DATASETS, *catalog.FIVE_MINUTE_POWER_DATASETS, *catalog.MONTHLY_CAPACITY_DATASETS}
    assert configured == mapped | catalog.EXCLUDED_FROM_GOLD and len(configured) == 35


@pytest.mark.parametrize("column", ["a", "b"])
def test_guards_survive_column_pruning(spark, column):
    """Reading one column of a pivot or a merge still meets a repeated value, whichever column it is."""
    from meseta.operators.aggregate import pivot_metrics
    from meseta.operators.joins import merge_on_grain

    long = spark.createDataFrame(
        [("k", 1, 1.0), ("k", 1, 2.0), ("k", 2, 3.0), ("k", 2, 4.0)], "k string, i int, v double")
    wide = pivot_metrics(long, ["k"], "i", "v", {1: "a", 2: "b"}, strict=True)
    with pytest.raises(Exception, match="Several values"):
        wide.select(column).collect()
    frames = {"x": spark.createDataFrame([("k", 1), ("k", 2)], "k string, a int"),
              "y": spark.createDataFrame([("k", 1)], "k string, b int")}
    with pytest.raises(Exception, match="repeats a key"):
        merge_on_grain(frames, ["k"]).select(column).collect()


def test_energy_needs_exactly_one_sample_in_each_step(spark):
    from meseta.operators.aggregate import energy_rollup

    def energy(*minutes):
        rows = spark.createDataFrame([(f"2026-08-18 11:{m}", 120.0) for m in minutes], "t string, v double").select(
            F.to_timestamp("t").alias("t"), "v")
        return energy_rollup(rows, [], "t", {"e": F.col("v")}).first()["e"]

    assert energy("00:00", "05:00", "10:00") == pytest.approx(30.0)
    assert energy("00:00", "05:00") is None
    with pytest.raises(Exception, match="Several samples"):
        energy("00:00", "05:00", "10:00", "11:00")
