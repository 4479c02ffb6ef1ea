import datetime as dt
import uuid

import bronze_fixture
import pytest
from pyspark.sql import functions as F

from meseta import catalog
from meseta.operators.guards import same_columns
from meseta.plans import load, silver
from meseta.sources import tables
from meseta.sources.bronze import Bronze

CREATED = dt.datetime(2026, 9, 1)
SILVER_ROWS = {
    "silver_aemet_stations": 3, "silver_aemet_daily_climatology": 1, "silver_aemet_current_observations": 2,
    "silver_open_meteo_hourly": 6, "silver_open_meteo_historical_forecast": 6, "silver_open_meteo_15min": 24,
    "silver_cnig_provinces": 3, "silver_cnig_autonomous_communities": 3, "silver_cnig_municipalities": 1,
    "silver_esios_energy_hourly": 24, "silver_esios_power_5min": 36,
    "silver_esios_installed_capacity_monthly": 18}
GOLD_ROWS = {
    "gold_fact_province_hourly": 6, "gold_fact_installed_capacity_monthly": 2, "gold_fact_country_15min": 9,
    "gold_fact_country_5min": 6, "gold_dim_geography": 8}


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    return Bronze(spark, bronze_fixture.write(str(tmp_path_factory.mktemp("bronze"))))


@pytest.fixture(scope="module")
def namespace(spark, bronze):
    name = f"load_{uuid.uuid4().hex[:8]}"
    load.load_silver(spark, bronze, name)
    load.load_gold(spark, name, created_at=CREATED)
    return name


def contents(spark, namespace, names):
    frames = {name: spark.table(f"{namespace}.{name}") for name in names}
    return {name: sorted(map(str, frame.collect())) for name, frame in frames.items()}


def test_bronze_paths(spark, bronze):
    for bad in (("", "x"), ("x", " ")):
        with pytest.raises(ValueError):
            bronze.path(*bad)
    with pytest.raises(ValueError):
        Bronze(spark, " ")
    with pytest.raises(ValueError, match="Unknown"):
        bronze.indicators(["demanda_inventada"])


def test_landed_range_prunes_directories(spark, bronze):
    inside = Bronze(spark, bronze.root, (dt.date(2026, 8, 18), dt.date(2026, 8, 19)))
    outside = Bronze(spark, bronze.root, (dt.date(2026, 8, 19), dt.date(2026, 9, 1)))
    assert inside.stations().count() == 3 and outside.stations().count() == 0
    # partition columns of the landing layout do not leak into the records
    assert silver.stations(inside.stations()).count() == 3


def test_file_times_and_charset(bronze):
    row = bronze.provinces().withColumn(
        "ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp_ntz")).filter("COD_PROV = '01'").first()
    assert row["PROVINCIA"] == "Araba/Álava"
    assert row["ingestion_timestamp"] == dt.datetime(2026, 8, 18, 14, 5, 0, 123456)


def test_dataset_names_come_from_the_path(bronze):
    datasets = {r[0] for r in silver.all_observations(bronze).select("dataset").distinct().collect()}
    expected = {d for f in silver.FAMILIES for d in f.datasets if not d.startswith("demanda_en") and "medida_disc" not in d}
    assert datasets == expected


def test_silver_rows(spark, namespace):
    assert {name: spark.table(f"{namespace}.{name}").count() for name in SILVER_ROWS} == SILVER_ROWS
    # the later delivery of the same key won
    current = spark.table(f"{namespace}.silver_aemet_current_observations").filter("station_id = 'S28'")
    assert [r["ta"] for r in current.select("ta").collect()] == [31.0]
    places = spark.table(f"{namespace}.silver_open_meteo_15min").select("province", "province_code").distinct()
    assert {tuple(r) for r in places.collect()} == {("MADRID", "28"), ("VALENCIA", "46"), ("ARABA/ALAVA", "01")}


def test_partitions(spark, namespace):
    specs = [*catalog.SILVER_TABLES.values(), *catalog.GOLD_TABLES.values()]
    layout = tables.describe_layout(spark, [f"{namespace}.{s.name}" for s in specs])
    found = {r["table_name"].split(".")[1]: r["partition_columns"] for r in layout.collect()}
    assert found == {s.name: [s.partition_column] if s.partition else [] for s in specs}
    assert tables.missing_tables(spark, [s.name for s in specs], namespace) == []


def test_stored_columns_match_the_build(spark, namespace, bronze):
    built = silver.build_silver(bronze, ["silver_cnig_provinces", "silver_aemet_stations"])
    for name, frame in built.items():
        assert same_columns(frame, spark.table(f"{namespace}.{name}"))


def test_gold_rows(spark, namespace):
    assert {name: spark.table(f"{namespace}.{name}").count() for name in GOLD_ROWS} == GOLD_ROWS
    madrid = spark.table(f"{namespace}.gold_fact_province_hourly").filter(
        "province_code = '28' AND hour(gold_timestamp) = 12").drop("gold_timestamp", "gold_created_at").first()
    assert (madrid["temperature"], madrid["humidity"], madrid["humidity_source"]) == (31.0, 10.0, "OPEN_METEO")
    assert madrid["wind_speed_80m"] == pytest.approx((1.5 + 3 + 4.5 + 6) / 4)
    assert madrid["wind_direction_80m"] == pytest.approx(bronze_fixture.mean_direction([10, 20, 30, 40]))
    assert madrid["hydraulic_generation_mwh"] == -10035.0
    assert madrid["total_generation_mwh"] == 10043.0
    quarter = spark.table(f"{namespace}.gold_fact_country_15min").filter("geography_level = 'PENINSULA'").drop(
        "gold_timestamp", "gold_created_at", "part_day").first()
    assert quarter["real_demand_energy_mwh_15min"] == pytest.approx(30.0)
    members = spark.table(f"{namespace}.gold_dim_time").groupBy("time_grain").count()
    assert {tuple(r) for r in members.collect()} == {
        ("FIVE_MINUTES", 3), ("FIFTEEN_MINUTES", 8), ("HOUR", 2), ("MONTH", 1)}


def test_second_load_changes_nothing(spark, namespace, bronze):
    names = [*SILVER_ROWS, *GOLD_ROWS, "gold_dim_time"]
    before = contents(spark, namespace, names)
    load.load_silver(spark, bronze, namespace)
    load.load_gold(spark, namespace, created_at=CREATED)
    assert contents(spark, namespace, names) == before


def test_modes_load_their_tables_only(spark, bronze):
    assert catalog.LOAD_MODES["all"] == set(SILVER_ROWS)
    name = f"mode_{uuid.uuid4().hex[:8]}"
    reports = load.load_silver(spark, bronze, name, mode="esios-geography-fix")
    assert set(reports) == {"silver_esios_energy_hourly"}
    assert [t.name for t in spark.catalog.listTables(name)] == ["silver_esios_energy_hourly"]
    with pytest.raises(ValueError, match="mode"):
        load.load_silver(spark, bronze, name, mode="everything")


def test_gold_backfill_keeps_other_hours(spark, namespace):
    name = f"{namespace}.gold_fact_province_hourly"
    later = dt.datetime(2026, 10, 1)
    window = (dt.datetime(2026, 8, 18, 13), dt.datetime(2026, 8, 18, 14))
    load.load_gold(spark, namespace, created_at=later, window=window)
    stamped = spark.table(name).select(
        F.hour("gold_timestamp").alias("h"), F.year("gold_created_at").alias("y"), F.month("gold_created_at").alias("m"))
    assert {tuple(r) for r in stamped.distinct().collect()} == {(12, 2026, 9), (13, 2026, 10)}
    assert spark.table(name).count() == GOLD_ROWS["gold_fact_province_hourly"]


def test_unmatched_province_rejects_the_load(spark, tmp_path):
    root = bronze_fixture.write(str(tmp_path))
    bronze_fixture.put_json(root, "aemet", "stations", "c", [{
        "indicativo": "S99", "nombre": "x", "provincia": "PROVINCIA_INEXISTENTE", "altitud": "1",
        "latitud": "402443N", "longitud": "0034049W", "indsinop": "1"}])
    name = f"reject_{uuid.uuid4().hex[:8]}"
    with pytest.raises(ValueError, match="silver_aemet_stations.unmatched_place=1"):
        load.load_silver(spark, Bronze(spark, root), name, tables=["silver_aemet_stations"])
    assert spark.table(f"{name}.silver_aemet_stations").count() == 0


def test_window_reads_its_days_only(spark, namespace):
    tables = {name: spark.table(f"{namespace}.{name}") for name in catalog.SILVER_TABLES}
    window = (dt.datetime(2026, 8, 18, 13), dt.datetime(2026, 8, 18, 14))
    needed = load._silver_of_window(tables, window)
    for name in ("silver_esios_power_5min", "silver_open_meteo_15min"):
        plan = needed[name]._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(part_day" in plan
    assert needed["silver_cnig_provinces"] is tables["silver_cnig_provinces"]
