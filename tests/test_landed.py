"""Landing zones and loads derived from the tables."""

import datetime as dt
import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meseta import catalog
from meseta.operators import upsert as upserts
from meseta.session import stage
from meseta.sources.snapshots import SnapshotTable
from meseta.workload import landed, registry


def folder_of(spark, tmp_path, events):
    """Tables of a small scale with events of their own."""
    folder = str(tmp_path)
    small = registry.Tables(spark, "/root/testdata/sf0.001")
    for name in ("region", "nation", "customer"):
        getattr(small, name).write.parquet(f"{folder}/{name}.parquet")
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(events, schema).write.parquet(f"{folder}/events.parquet")
    return folder


def test_gold_windows_with_several_events_in_one_step(spark, tmp_path):
    # events 0 and 12 are samples of one power series, in one step of five minutes
    at = lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=70 * (i % 100), days=i // 100)
    events = [(i, at(i), i % 7, "click", i + 0.25, "{}") for i in range(300)]
    events.append((312, at(0) + dt.timedelta(seconds=1), 3, "view", 9.5, "{}"))
    folder = folder_of(spark, tmp_path, events)
    found = registry.QUERIES["load_gold_windows"](spark, folder).collect()
    assert {tuple(row) for row in found} == {(name, True, 0) for name in landed._FACTS}


def test_readers_land_what_they_read_in_packed_files(spark, monkeypatch):
    monkeypatch.setattr(landed, "_landed", {})
    tables = registry.Tables(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(landed, "_FILE_POINTS", 40)
    landed.whole_landing(tables, "masters", "aemet", "weather")
    zone = landed.whole_landing(tables, "masters")
    assert {path.name for path in Path(zone.root).iterdir()} == {"cnig", "aemet", "open_meteo"}
    files = list(Path(zone.root, "open_meteo").rglob("part-*"))
    assert files and all(path.name.endswith(".json.gz") for path in files)
    assert max(gzip.open(path).read().count(b"\n") for path in files) <= 40
    landed.whole_landing(tables, "indicators")
    assert landed.whole_landing(tables) is zone and Path(zone.root, "esios").exists()


def test_lists_of_an_indicator_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landed, "_SERIES_BLOCK", 120)
    start = dt.datetime(2024, 1, 1)
    events = [(i, start + dt.timedelta(minutes=i), i % 7, "click", float(i), "{}") for i in range(2400)]
    zone = landed.Landing(registry.Tables(spark, folder_of(spark, tmp_path, events))).indicators("power")
    sizes = zone.bronze.indicators(landed._POWER).select(F.size("data.indicator.values").alias("n")).collect()
    assert sum(row["n"] for row in sizes) == 2400 and max(row["n"] for row in sizes) == 10


def test_first_load_of_a_table_joins_nothing(spark, monkeypatch, tmp_path):
    def joined(*_):
        raise AssertionError("a table without rows was joined")

    monkeypatch.setattr(upserts, "_merged", joined)
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "k int, part string")
    spark.sql("CREATE NAMESPACE IF NOT EXISTS first_load")
    for name, partition in (("plain", None), ("parted", "part")):
        table = SnapshotTable.create(
            spark, f"first_load.{name}", rows.schema, keys=("k",), partition_column=partition, location=f"{tmp_path}/{name}")
        with pytest.raises(ValueError, match="more than once"):
            upserts.upsert(table, rows.unionByName(rows.limit(1)), ["k"])
        assert table.read().count() == 0
        assert upserts.upsert(table, rows, ["k"]) == upserts.UpsertReport(3, 3)
        assert sorted(row["k"] for row in spark.table(f"first_load.{name}").collect()) == [1, 2, 3]


def test_weather_is_landed_from_points_that_know_their_place(spark, monkeypatch):
    tables = registry.Tables(spark, "/root/testdata/sf0.001")
    staged = []
    monkeypatch.setattr(landed, "stage", lambda frame, purpose: staged.append(purpose) or stage(frame, purpose))
    landed.Landing(tables).weather()
    assert staged == ["weather-payloads"]


def test_weather_envelopes_hold_a_block_of_their_users_points(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landed, "_SERIES_BLOCK", 5000)
    start = dt.datetime(2024, 1, 1)
    events = [(50 * i, start + dt.timedelta(minutes=i), i % 7, "click", float(i), "{}") for i in range(700)]
    zone = landed.Landing(registry.Tables(spark, folder_of(spark, tmp_path, events))).weather()
    for frame, container in ((zone.bronze.weather_hourly(), "hourly"), (zone.bronze.weather_15min(), "minutely_15")):
        sizes = [row["n"] for row in frame.select(F.size(f"data.{container}.time").alias("n")).collect()]
        assert sum(sizes) == 700 and len(sizes) == 7 * 7 and max(sizes) <= 15


def test_modes_land_the_datasets_they_load(spark):
    zone = landed.Landing(registry.Tables(spark, "/root/testdata/sf0.001")).aemet("stations", "daily")
    assert {path.name for path in Path(zone.root, "aemet").iterdir()} == {"stations", "daily_climatological_values"}


@pytest.mark.parametrize("partition", [None, "part"])
def test_rows_that_replace_all_stored_ones_are_published_as_staged(spark, monkeypatch, tmp_path, partition):
    schema = "k int, part string, v int, at int"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    old = [(1, "a", 10, 1), (2, "b", 20, 1), (3, "b", 30, 1)]
    spark.sql("CREATE NAMESPACE IF NOT EXISTS whole_load")
    name = f"whole_load.t_{partition}"
    SnapshotTable.create(
        spark, name, frame(old).schema, keys=("k",), partition_column=partition, location=f"{tmp_path}/t")

    def load(rows):
        table = SnapshotTable(spark, name)
        source = upserts.stage_source(frame(rows), table, ["k"], as_load=True)
        try:
            merge = upserts.prepare(table, source, ["k"], newest_by=["at"])
        except ValueError:
            source.discard(table)
            raise
        merge.publish()
        return merge.load is source.load, merge.report

    stored = lambda: sorted(tuple(row) for row in spark.table(name).select("k", "part", "v", "at").collect())
    merged = upserts._merged
    monkeypatch.setattr(upserts, "_merged", None)  # whole rows are not joined
    assert load(old) == (True, upserts.UpsertReport(3, 3))
    again = [(1, "a", 11, 1), (2, "b", 21, 2), (3, "b", 31, 2), (4, "c", 41, 2)]
    assert load(again) == (True, upserts.UpsertReport(4, 4)) and stored() == again
    with pytest.raises(ValueError, match="more than once"):
        load(again + again[:1])
    assert stored() == again
    monkeypatch.setattr(upserts, "_merged", merged)
    # a stored row is newer, another one is not delivered again
    mixed, report = load([(2, "b", 22, 1), (4, "c", 42, 3)])
    assert not mixed and report.source_rows == 2
    assert stored() == [*again[:3], (4, "c", 42, 3)]


def test_a_rejected_load_leaves_no_rows_behind(spark, tmp_path, monkeypatch):
    zone = landed.Landing(registry.Tables(spark, "/root/testdata/sf0.001")).masters().aemet("stations")
    load = landed.load
    warehouse = Path(spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:"))
    written = lambda: {path for path in warehouse.rglob("part-*") if "rejected_load" in str(path)}
    monkeypatch.setattr(load, "silver_checks", lambda name: {"any": (landed.quality.ERROR, F.lit(True))})
    with pytest.raises(ValueError):
        load.load_silver(spark, zone.bronze, "rejected_load", tables=["silver_aemet_stations"])
    assert not written() and spark.table("rejected_load.silver_aemet_stations").count() == 0
    monkeypatch.undo()
    load.load_silver(spark, zone.bronze, "rejected_load", tables=["silver_aemet_stations"])
    assert written() and spark.table("rejected_load.silver_aemet_stations").count() > 0


def test_arrays_of_the_layouts_are_computed_once(spark, monkeypatch):
    staged = []
    monkeypatch.setattr(landed, "stage", lambda frame, purpose: staged.append(frame.columns) or stage(frame, purpose))
    landed.Landing(registry.Tables(spark, "/root/testdata/sf0.001")).weather()
    assert staged == [["user_id", "block", "time", "value", "whole", "province"]]


def test_all_tables_are_landed_and_loaded_twice_by_the_query_itself(spark, tmp_path, monkeypatch):
    start = dt.datetime(2024, 1, 1)
    events = [(i, start + dt.timedelta(minutes=7 * i), i % 7, "click", float(i), "{}") for i in range(40)]
    folder = folder_of(spark, tmp_path, events)
    loads, load_silver = [], landed.load.load_silver

    def noted(spark, bronze, namespace, **options):
        reports = load_silver(spark, bronze, namespace, **options)
        loads.append((bronze.root, namespace, {name: report.source_rows for name, report in reports.items()}))
        return reports

    monkeypatch.setattr(landed.load, "load_silver", noted)
    # what another query of the session left for this folder is not taken
    session = spark.sparkContext.applicationId, folder
    monkeypatch.setitem(landed._landed, session, (landed.Landing(registry.Tables(spark, folder)), set(landed._PARTS)))
    monkeypatch.setitem(landed._loaded, session, "left_by_another_query")
    found = {row["table"]: row["n_rows"] for row in registry.QUERIES["load_silver_all"](spark, folder).collect()}
    assert set(found) == set(catalog.SILVER_TABLES) and [rows for *_, rows in loads] == [found, found]
    assert found["silver_open_meteo_15min"] == found["silver_esios_power_5min"] == 40
    assert len({(root, namespace) for root, namespace, _ in loads}) == 1
