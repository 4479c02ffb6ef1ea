import datetime as dt

import pytest
from pyspark.sql import functions as F

from meseta.operators import clean, guards


def test_latest_by_key_is_order_independent(spark):
    rows = [("A", 1, "x"), ("A", 2, "y"), ("A", 2, "z"), ("B", None, "w"), ("B", 0, "v")]
    survivors = set()
    for permutation in (rows, rows[::-1], rows[2:] + rows[:2]):
        frame = spark.createDataFrame(permutation, "k string, at int, v string").repartition(3)
        found = {tuple(r) for r in clean.latest_by_key(frame, ["k"], ["at"]).collect()}
        assert {r[:2] for r in found} == {("A", 2), ("B", 0)}
        survivors.add(frozenset(found))
    assert len(survivors) == 1


def test_latest_by_key_rejects_bad_keys(spark):
    frame = spark.createDataFrame([("A", 1)], "k string, v int")
    with pytest.raises(ValueError):
        clean.latest_by_key(frame, [])
    with pytest.raises(ValueError, match="missing"):
        clean.latest_by_key(frame, ["missing"])


def test_group_limit_runs_before_the_shuffle(spark):
    frame = spark.createDataFrame([("A", 1), ("A", 2)], "k string, v int")
    plan = clean.latest_by_key(frame, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_guards(spark):
    frame = spark.createDataFrame([], "data struct<hourly: struct<time: array<string>>, n: array<struct<a: int>>>, m string")
    guards.require_fields(frame, ["data.hourly.time", "data.n.a", "m"])
    with pytest.raises(ValueError, match="data.hourly.rain"):
        guards.require_fields(frame, ["data.hourly.rain"])
    with pytest.raises(ValueError, match="struct"):
        guards.require_struct(frame, "m", ["x"])
    assert guards.has_struct_elements(frame, "data.n")
    assert not guards.has_struct_elements(frame, "data.hourly.time")
    assert guards.same_columns(frame, frame) and not guards.same_columns(frame, frame.select("m"))


def test_envelope_keeps_or_drops_empty_arrays(spark):
    schema = "metadata struct<ingestion_timestamp: string>, data array<struct<a: string>>"
    frame = spark.createDataFrame([(("t1",), [("x",), ("y",)]), (("t2",), []), (("t3",), None)], schema)
    assert clean.flatten_envelope(frame).count() == 4
    assert clean.flatten_envelope(frame, keep_empty=False).count() == 2
    with pytest.raises(ValueError):
        clean.flatten_envelope(frame.drop("metadata"))


def test_parallel_arrays_are_padded(spark):
    frame = spark.createDataFrame([("s", [1, 2, 3], ["a", "b"])], "id string, n array<int>, t array<string>")
    rows = clean.explode_parallel(frame, {"id": F.col("id")}, {"n": F.col("n"), "t": F.col("t")}).collect()
    assert [tuple(r) for r in rows] == [("s", 1, "a"), ("s", 2, "b"), ("s", 3, None)]


def test_windows_do_not_overlap(spark):
    stamps = [dt.datetime(2026, 1, 1, h) for h in range(6)]
    frame = spark.createDataFrame([(s,) for s in stamps], "ts timestamp_ntz")
    cut = lambda a, b: clean.in_window(
        frame, "ts", *[F.lit(stamps[0].replace(hour=h)).cast("timestamp_ntz") for h in (a, b)])
    assert cut(0, 3).count() + cut(3, 6).count() == 6
    assert cut(0, 3).intersect(cut(3, 6)).count() == 0


def test_union_needs_equal_columns(spark):
    a, b = spark.createDataFrame([(1, "x")], "n int, t string"), spark.createDataFrame([("y", 2)], "t string, n int")
    assert {tuple(r) for r in clean.union_all([a, b]).collect()} == {(1, "x"), (2, "y")}
    with pytest.raises(Exception):
        clean.union_all([a, b.drop("n")]).collect()


def test_traceability(spark):
    frame = spark.createDataFrame([("2026-08-18T12:00:00Z",)], "ingestion_timestamp string")
    row = clean.with_traceability(frame, "aemet").withColumn(
        "ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp_ntz")).first()
    assert tuple(row) == (dt.datetime(2026, 8, 18, 12), "aemet")
    bare = clean.with_traceability(frame.select(F.lit(1).alias("x")), "aemet").first()
    assert bare["ingestion_timestamp"] is None
