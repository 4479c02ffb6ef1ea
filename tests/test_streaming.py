import datetime as dt
import json
import time

from pyspark.sql import functions as F

from meseta import schemas
from meseta.operators.clean import flatten_envelope
from meseta.plans import silver
from meseta.session import scratch_path
from meseta.sources.bronze import Bronze
from meseta.sources.landing import land_envelopes, land_text
from meseta.sources.tables import PathStore
from meseta.streaming import incremental

SCHEMA = "k string, at int, v string"


def str_json(progress):
    return progress.json


def deliver(spark, folder, *rows):
    spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_upsert_stream_reads_new_files_only(spark):
    folder, progress = scratch_path(spark, "in"), scratch_path(spark, "progress")
    store = PathStore(spark, scratch_path(spark, "out"), spark.createDataFrame([], SCHEMA).schema)
    seen = []

    def run():
        seen.clear()
        incremental.upsert_stream(
            spark.readStream.schema(SCHEMA).parquet(folder), store, ["k"], ["at"], progress,
            lambda batch: (seen.append(batch.count()), batch)[1]).awaitTermination()
        return {tuple(r) for r in store.read().collect()}

    deliver(spark, folder, ("A", 1, "x"), ("A", 2, "y"), ("B", 1, "z"))
    assert run() == {("A", 2, "y"), ("B", 1, "z")}
    deliver(spark, folder, ("A", 0, "old"), ("B", 3, "new"), ("C", 1, "w"))
    assert run() == {("A", 2, "y"), ("B", 3, "new"), ("C", 1, "w")}
    assert seen == [3]
    run()
    assert seen == []


def test_dedup_across_runs(spark):
    folder, out, progress = (scratch_path(spark, p) for p in ("in", "out", "progress"))
    ts = dt.datetime(2026, 8, 18, 12)
    schema = "k string, ts timestamp_ntz"
    store = PathStore(spark, out, spark.createDataFrame([], schema).schema)

    def run(*rows):
        spark.createDataFrame(list(rows), schema).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        incremental.dedup_stream(stream, store, ["k"], progress).awaitTermination()
        return sorted(r["k"] for r in store.read().select("k").collect())

    assert run(("A", ts), ("A", ts), ("B", ts)) == ["A", "B"]
    assert run(("B", ts + dt.timedelta(hours=1)), ("C", ts)) == ["A", "B", "C"]
    # years behind the newest instant: compared like any other, and the stored row stays
    assert run(("D", ts - dt.timedelta(days=900)), ("B", ts - dt.timedelta(days=900))) == ["A", "B", "C", "D"]
    assert store.read().filter("k = 'B'").first()["ts"] == ts


def test_landing_appends(spark):
    root = scratch_path(spark, "landing")
    at = dt.datetime(2026, 8, 18, 14, 5, tzinfo=dt.timezone.utc)
    payload = spark.createDataFrame([("S1", [("a",)])], "station string, data array<struct<x: string>>")
    for _ in range(2):
        path = land_envelopes(
            payload, root, source="aemet", dataset="stations", ingestion_mode="incremental", ingested_at=at,
            requested_start_date="2026-08-01", extra_metadata={"station_id": F.col("station")})
    schema = schemas.envelope(payload.schema["data"].dataType, station_id=payload.schema["station"].dataType)
    landed = Bronze(spark, root, (at.date(), at.date() + dt.timedelta(days=1)), multiline=False)
    rows = landed.json(schema, "aemet", "stations")
    assert path == f"{root}/aemet/stations" and rows.count() == 2
    first = rows.first()
    assert (first["metadata"]["station_id"], first["metadata"]["requested_start_date"]) == ("S1", "2026-08-01")
    assert (first["year"], first["month"], first["day"]) == (2026, 8, 18)
    flat = flatten_envelope(rows).select("x", "ingestion_timestamp").distinct().collect()
    assert [tuple(r) for r in flat] == [("a", at.isoformat())]


def test_packed_text_keeps_line_breaks(spark):
    root = scratch_path(spark, "landing")
    texts = ["one\ntwo\n", "three\r\nfour", ""]
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    at = dt.datetime(2026, 8, 18)
    land_text(frame, root, source="aemet", dataset="radiation", ingested_at=at)
    back = Bronze(spark, root).text("aemet", "radiation", packed=True)
    assert sorted(r["value"] for r in back.collect()) == sorted(texts)


def test_silver_stream_uses_the_batch_transform(spark):
    """The station transform runs unchanged on micro-batches of envelopes."""
    root = scratch_path(spark, "landing")
    at = dt.datetime(2026, 8, 18, tzinfo=dt.timezone.utc)
    row = ("3195", "MADRID", "MADRID", "667", "402443N", "0034049W", "08222")
    data_type = schemas.STATIONS["data"].dataType
    frame = spark.createDataFrame([([row],)], f"data {data_type.simpleString()}")
    land_envelopes(frame, root, source="aemet", dataset="stations", ingestion_mode="full", ingested_at=at)
    transform = lambda batch: silver.stations(flatten_envelope(batch, keep_empty=False))
    arrivals = spark.readStream.schema(schemas.STATIONS).json(f"{root}/aemet/stations")
    shape = transform(spark.read.schema(schemas.STATIONS).json(f"{root}/aemet/stations")).schema
    store = PathStore(spark, scratch_path(spark, "out"), shape)
    incremental.upsert_stream(
        arrivals, store, ["station_id"], ["ingestion_timestamp"], scratch_path(spark, "progress"), transform
    ).awaitTermination()
    assert [r["station_id"] for r in store.read().select("station_id").collect()] == ["3195"]


def test_dedup_state_is_bounded_and_its_loss_harmless(spark):
    """Repeats of keys that left the state, or that it never held, are found among the stored rows."""
    folder, progress = scratch_path(spark, "in"), scratch_path(spark, "progress")
    store = PathStore(spark, scratch_path(spark, "out"), spark.createDataFrame([], SCHEMA).schema)

    def run(*rows, progress=progress, remember="2 seconds"):
        deliver(spark, folder, *rows)
        stream = incremental.dedup_stream(
            spark.readStream.schema(SCHEMA).parquet(folder), store, ["k"], progress, remember)
        stream.awaitTermination()
        held = [p["stateOperators"][0]["numRowsTotal"] for p in map(json.loads, map(str_json, stream.recentProgress))
                if p["stateOperators"]]
        return held[-1], sorted(r["k"] for r in store.read().collect())

    many = [(f"k{i}", i, "v") for i in range(50)]
    held, stored = run(*many)
    assert held == 50 and len(stored) == 50
    time.sleep(3)
    run(("new", 0, "v"))
    time.sleep(3)
    held, stored = run(("newer", 0, "v"), *many[:10])
    assert held <= 15 and len(stored) == 52  # the first 50 keys are gone from the state, their repeats are not stored
    held, stored = run(("last", 0, "v"), progress=scratch_path(spark, "progress"))  # reads every file again
    assert len(stored) == len(set(stored)) == 53
