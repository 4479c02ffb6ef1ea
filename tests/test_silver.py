import datetime as dt

import pytest
from pyspark.sql import functions as F

from meseta import catalog, schemas
from meseta.plans import silver

STATION = ("3195", "MADRID, RETIRO", "MADRID", "667", "402443N", "0034049W", "08222")


def ntz(df, column):
    return df.select(F.col(column).cast("timestamp_ntz")).first()[0]


def station_frame(spark, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in catalog.STATION_FIELDS))


def test_stations(spark):
    row = silver.stations(station_frame(spark, STATION, STATION)).collect()
    assert len(row) == 1
    assert row[0]["altitud"] == 667.0 and row[0]["source"] == "aemet"
    assert row[0]["latitude"] == pytest.approx(40 + 24 / 60 + 43 / 3600)
    assert row[0]["longitude"] == pytest.approx(-(3 + 40 / 60 + 49 / 3600))
    with pytest.raises(ValueError, match="latitud"):
        silver.stations(station_frame(spark, STATION).select("indicativo", "nombre"))


def test_six_digit_longitude_is_kept(spark):
    short = (*STATION[:5], "025309W", STATION[6])
    assert silver.stations(station_frame(spark, short)).first()["longitude"] == pytest.approx(-2.8858333)


DAILY = dict(
    altitud="667", dir="180", fecha="2026-08-17", horaHrMax="14:00", horaHrMin="06:00", horaPIntMax="12:30",
    horaPresMax="15:00", horaPresMin="05:00", horaracha="15:10", horatmax="15:00", horatmin="05:30",
    hrMax="80", hrMedia="55", hrMin="30", indicativo="3195", nombre="MADRID, RETIRO", pintMax="0,0",
    prec="Ip", presMax="950,2", presMin="940,1", provincia="MADRID", racha="12,5", sol="10,2", tmax="32,1",
    tmed="24,3", tmin="16,5", velmedia="3,4")


def test_daily_climatology(spark):
    frame = spark.createDataFrame([tuple(DAILY.values())] * 2, ", ".join(f"{c} string" for c in DAILY))
    rows = silver.daily_climatology(frame).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row["observation_date"], row["tmed"], row["presMax"], row["prec"]) == (
        dt.date(2026, 8, 17), 24.3, 950.2, None)
    assert row["horaHrMax"] == "14:00"
    assert silver.daily_climatology(frame).columns == [
        "station_id", "observation_date", *catalog.DAILY_FIELD_ORDER, "source", "ingestion_timestamp"]
    with pytest.raises(ValueError):
        silver.daily_climatology(frame.drop("tmed"))


def test_current_observations(spark):
    names = ("idema", "fint", "lat", "lon", *catalog.CURRENT_MEASURES)
    given = {"idema": "3195", "fint": "2026-08-18T14:00:00", "lat": "40.411", "lon": "-3.678", "ta": "31.2",
             "hr": "45.0", "prec": "0.0"}
    frame = spark.createDataFrame(
        [tuple(given.get(n) for n in names)] * 2, ", ".join(f"{n} string" for n in names))
    built = silver.current_observations(frame)
    assert built.count() == 1
    assert ntz(built, "observation_timestamp") == dt.datetime(2026, 8, 18, 14)
    row = built.drop("observation_timestamp", "ingestion_timestamp").first()
    assert (row["station_id"], row["latitude"], row["longitude"], row["ta"]) == ("3195", 40.411, -3.678, "31.2")
    assert len(built.columns) == 39 + 2


@pytest.mark.parametrize("layout", [silver.HOURLY, silver.HISTORICAL_FORECAST, silver.QUARTER_HOURLY])
def test_weather_series(spark, layout):
    times = ["2026-08-18T14:00", "2026-08-18T15:00", "2026-08-18T14:00"]
    arrays = [[n + i for n in range(3)] for i, _ in enumerate(layout.variables)]
    arrays = [
        a if name in catalog.INTEGER_VARIABLES else [float(x) for x in a]
        for name, a in zip(layout.variables, arrays)]
    schema = schemas.parallel_series(layout.container, layout.variables, layout.id_field)
    metadata = ("open_meteo", "d", "m", "2026-08-18T16:00:00Z", None, None, "S1", "Station", "MADRID")
    frame = spark.createDataFrame([(metadata, (600.0, 40.4, -3.7, (times, *arrays)))], schema)
    built = silver.weather_series(frame, layout)
    assert built.count() == 2
    assert built.columns[:7] == [
        "station_id", "observation_timestamp", "station_name", "province", "latitude", "longitude", "elevation"]
    first = built.filter(F.hour("observation_timestamp") == 15).drop(
        "observation_timestamp", "ingestion_timestamp").first()
    assert first["station_id"] == "S1" and first[layout.variables[0]] == 1.0
    broken = frame.withColumn("data", F.col("data").dropFields(f"{layout.container}.{layout.variables[-1]}"))
    with pytest.raises(ValueError, match=layout.variables[-1]):
        silver.weather_series(broken, layout)


VALUE = ("2026-08-18T14:00:00+02:00", "2026-08-18T12:00:00Z", "2026-08-18T14:00:00+02:00", 8741, "Madrid", 1234.5)


def indicator_frame(spark, indicator=1161, classes=(13, 4), points=(VALUE,)):
    data = ((indicator, "name", "short", [(classes[0], "m")] if classes else [],
             [(classes[1], "t")] if classes else [], "2026-08-18T13:00:00Z", list(points)),)
    metadata = (None, None, None, "2026-08-18T16:00:00Z", None, None)
    return spark.createDataFrame([(metadata, data)], schemas.INDICATOR)


def test_indicator_observation(spark):
    rows = silver.indicator_observations(indicator_frame(spark), F.lit("d"))
    assert rows.schema.simpleString() == spark.createDataFrame([], silver.OBSERVATION_SCHEMA).schema.simpleString()
    assert ntz(rows, "observation_timestamp") == dt.datetime(2026, 8, 18, 12)
    row = rows.select("indicator_id", "magnitude_id", "time_id", "esios_geo_id", "value", "dataset").first()
    assert tuple(row) == (1161, 13, 4, 8741, 1234.5, "d")


def test_empty_values_give_no_rows(spark):
    assert silver.indicator_observations(indicator_frame(spark, points=()), F.lit("d")).count() == 0
    assert silver.indicator_observations(indicator_frame(spark, classes=None), F.lit("d")).first()["time_id"] is None


def test_inferred_empty_values(spark):
    inferred = indicator_frame(spark, points=()).withColumn(
        "data", F.col("data").withField("indicator.values", F.array().cast("array<string>")))
    assert silver.indicator_observations(inferred, F.lit("d")).count() == 0
    wrong = inferred.withColumn("data", F.col("data").withField("indicator.values", F.array(F.lit("x"))))
    with pytest.raises(ValueError, match="structs"):
        silver.indicator_observations(wrong, F.lit("d"))
    with pytest.raises(ValueError, match="values"):
        silver.indicator_observations(
            inferred.withColumn("data", F.col("data").dropFields("indicator.values")), F.lit("d"))


@pytest.mark.parametrize("family", silver.FAMILIES)
def test_families_select_their_class(spark, family):
    frames = [indicator_frame(spark, i, c) for i, c in ((1, (13, 4)), (2, (20, 219)), (3, (20, 2)))]
    rows = silver.indicator_observations(frames[0].unionByName(frames[1]).unionByName(frames[2]), F.lit("d"))
    kept = silver.indicator_family(rows.unionByName(rows), family).collect()
    assert [(r["magnitude_id"], r["time_id"]) for r in kept] == [family.magnitude_and_time]


PROVINCES = [("01", "Araba/Álava", "16", "País Vasco/Euskadi", "Vitoria-Gasteiz"),
             ("02", "Albacete", "08", "Castilla-La Mancha", "Albacete"),
             ("13", "Ciudad Real", "08", "Castilla-La Mancha", "Ciudad Real")]
MUNICIPALITY = ("01001000000", "1010014", "01010", "01", "Araba/Álava", "Alegría-Dulantzi", "2961", "1994,5872",
                "35069", "01001000101", "Alegría-Dulantzi", "2842", "0113-3", "-2,512507724", "42,84045247",
                "Detección automática", "568", "MDT")


def test_cnig(spark):
    provinces = silver.provinces(spark.createDataFrame(PROVINCES + PROVINCES[:1], schemas.PROVINCES_CSV))
    assert provinces.count() == 3
    communities = silver.autonomous_communities(provinces)
    assert {tuple(r)[:2] for r in communities.drop("ingestion_timestamp").collect()} == {
        ("16", "País Vasco/Euskadi"), ("08", "Castilla-La Mancha")}
    with pytest.raises(ValueError):
        silver.provinces(spark.createDataFrame(PROVINCES, schemas.PROVINCES_CSV).drop("CAPITAL"))


def test_municipalities_share_a_geographic_code(spark):
    rows = [MUNICIPALITY, ("01002000000", MUNICIPALITY[1], "00000", *MUNICIPALITY[3:]),
            ("01003000000", MUNICIPALITY[1], "00000", *MUNICIPALITY[3:])]
    built = silver.municipalities(spark.createDataFrame(rows, schemas.MUNICIPALITIES_CSV))
    assert built.count() == 3 and len(built.columns) == 20
    row = built.filter("municipality_ine_code = '01001000000'").first()
    assert (row["municipality_population"], row["surface_area"], row["longitude"], row["latitude"], row["altitude"]) == (
        2961, 1994.5872, -2.512507724, 42.84045247, 568.0)
