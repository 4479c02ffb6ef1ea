"""Windows over stored tables, offsets, steps, fingerprints and composite keys."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from meseta.catalog import TableSpec
from meseta.operators import analytics, clean, gaps, quality
from meseta.operators.upsert import upsert_table
from meseta.session import scratch_path
from meseta.sources import tables

START = dt.datetime(2026, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


@pytest.mark.parametrize("kind, column, expected", [("days", "part_day", 3), ("months", "part_month", 2)])
def test_a_window_lists_its_partitions_only(spark, kind, column, expected):
    spec = TableSpec(f"w_{kind}", ("k", "ts"), (kind, "ts"))
    rows = spark.range(90).select(
        F.col("id").alias("k"), (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(F.col("id"), F.lit(7))).alias("ts"))
    tables.create_namespace(spark, "windows")
    tables.create_table(spark, rows, spec, namespace="windows", location=scratch_path(spark, kind))
    name = f"windows.{spec.name}"
    upsert_table(spark, name, tables.with_partition(rows, spec), spec.keys, spec.partition_column)
    low, high = (F.lit(START + dt.timedelta(days=d)).cast("timestamp_ntz") for d in (30, 32.5))
    found = clean.in_window(spark.table(name), "ts", low, high)
    filters = plan_of(found).split("PartitionFilters: [")[1].split("]")[0]
    assert filters.count(column) >= 2
    assert {row["k"] for row in found.collect()} == {30, 31, 32}
    files = {f for f in found.inputFiles()}
    listed = found.select(F.input_file_name()).distinct().count()
    assert listed <= expected <= len(files)
    # other timestamps of the table don't bound the partitions
    assert clean.derived_partitions(spark.table(name), "k") == []


def test_offsets_equal_a_join_and_shuffle_rows_once(spark):
    draw = random.Random(1)
    data = [(p, START + dt.timedelta(hours=h), draw.random() if draw.random() < 0.8 else None, draw.random())
            for p in "ab" for h in range(200) if draw.random() < 0.9]
    frame = spark.createDataFrame(data, "p string, ts timestamp_ntz, x double, y double")
    hours = [-5, -1, 0, 2, 7]
    found = analytics.offset_scan(frame, ["p"], "ts", "x", "y", hours, by=["p"], block_hours=6)
    values = {(p, ts): y for p, ts, _, y in data}
    for row in found.collect():
        pairs = [(x, values.get((p, ts + dt.timedelta(hours=row["offset_hours"])))) for p, ts, x, _ in data if p == row["p"]]
        pairs = [(x, y) for x, y in pairs if x is not None and y is not None]
        assert row["n_pairs"] == len(pairs)
        mx, my = (sum(v) / len(pairs) for v in zip(*pairs))
        cov = sum((x - mx) * (y - my) for x, y in pairs)
        expected = cov / (sum((x - mx) ** 2 for x, _ in pairs) * sum((y - my) ** 2 for _, y in pairs)) ** 0.5
        assert row["correlation"] == pytest.approx(expected)
    assert found.count() == 2 * len(hours)
    assert plan_of(found).count("Exchange hashpartitioning") <= 2  # rows by block, then sums


def test_steps_are_carried_over_buckets_and_eras(spark):
    draw = random.Random(2)
    instants = sorted(START + dt.timedelta(minutes=draw.choice([10, 10, 10, 700, 60 * 24 * 45]) * k) for k in range(300))
    frame = spark.createDataFrame([("s", i) for i in instants], "s string, ts timestamp_ntz")
    expected = {}
    for a, b in itertools.pairwise(instants):
        minutes = (b - a).total_seconds() / 60
        expected[minutes] = expected.get(minutes, 0) + 1
    for series in (["s"], []):
        found = {row["minutes"]: row["n"] for row in gaps.step_histogram(frame, series, "ts").collect()}
        assert found == expected


def test_no_window_orders_all_buckets_of_a_long_series(spark):
    hours = spark.range(200_000).select((F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id"))).alias("ts"))
    found = gaps.step_summary(hours, [], "ts", 60.0)
    assert found.first()["n_matching"] == 199_999
    assert "_era" in plan_of(gaps.steps(hours, [], "ts"))


def test_equal_states_compare_without_their_rows(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("part"), F.lit("x" * 50).alias("wide"))
    plan = plan_of(quality.fingerprints(rows, ["part"]))
    assert "partial_count" in plan and "wide" not in plan.split("Exchange")[0]
    same = quality.same_rows(rows, rows.orderBy(F.desc("id")), "t", by=["part"])
    assert "Join" not in plan_of(same) and same.first()["n_total"] == 1000 and same.first()["n_bad"] == 0
    changed = rows.where("id <> 3").unionByName(rows.where("id IN (9, 9)").withColumn("wide", F.lit("y")))
    for by in (["part"], []):
        verdict = quality.same_rows(rows, changed, "t", by=by).first()
        assert (verdict["n_total"], verdict["n_bad"]) == (1000, 2)
    twice = quality.same_rows(rows, rows.unionByName(rows.where("id = 5")), "t", by=["part"]).first()
    assert (twice["n_total"], twice["n_bad"]) == (1000, 1)
    none = quality.same_rows(rows.limit(0), rows.limit(0), "t").first()
    assert (none["n_total"], none["n_bad"]) == (0, 0)
    fresh = quality.same_rows(rows.limit(0), rows, "t", by=["part"]).first()
    assert (fresh["n_total"], fresh["n_bad"]) == (0, 1000)


def test_minimal_keys(spark):
    rows = [(a, b, c, 10 * a + b, None if a == 0 else 1) for a in range(3) for b in range(4) for c in range(2)]
    frame = spark.createDataFrame(rows, "a int, b int, c int, ab int, d int")
    found = {row["columns"] for row in quality.minimal_keys(frame, ["a", "b", "c", "ab", "d"], 3).collect()}
    assert found == {"a,b,c", "c,ab"}
    assert quality.minimal_keys(frame, ["a", "b"], 2).count() == 0
    assert quality.minimal_keys(frame.limit(0), ["a", "b"]).count() == 0
    assert [tuple(r) for r in quality.minimal_keys(spark.range(5), ["id"]).collect()] == [("id", 1, 5, 5)]
    swapped = spark.createDataFrame([(None, "x"), ("x", None)], "p string, q string")
    assert {row["columns"] for row in quality.minimal_keys(swapped, ["p", "q"]).collect()} == {"p", "q"}


def test_minimal_keys_finds_a_single_repeated_value(spark):
    # one repeated pair among many rows, wherever its digest lies, and few shuffled rows otherwise
    frame = spark.range(3000).select(
        F.col("id").alias("a"), (F.col("id") % 60).alias("b"), F.floor(F.col("id") / 60).alias("c"), F.lit(1).alias("d"))
    assert {row["columns"] for row in quality.minimal_keys(frame, ["a", "b", "c", "d"]).collect()} == {"a", "b,c"}
    for again in (0, 7, 2999):
        twice = frame.unionByName(frame.where(F.col("a") == again).withColumn("a", F.lit(-1).cast("bigint")))
        assert [tuple(row) for row in quality.minimal_keys(twice, ["a", "b", "c", "d"]).collect()] == [("a", 1, 3001, 3001)]


def test_minimal_keys_shuffles_few_digests_of_candidates_that_repeat(spark):
    frame = spark.range(40_000).select(*[F.xxhash64(F.floor(F.col("id") / 2), F.lit(i)).alias(f"c{i}") for i in range(6)])
    store = spark.sparkContext._jsc.sc().statusStore()
    none = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
    stages = lambda: store.stageList(None, False, False, none, None)
    last = max([stages().apply(i).stageId() for i in range(stages().size())], default=-1)
    assert quality.minimal_keys(frame, frame.columns, 3).count() == 0
    found = stages()
    written = sum(found.apply(i).shuffleWriteRecords() for i in range(found.size()) if found.apply(i).stageId() > last)
    assert written < 40_000  # 41 candidates have 820,000 distinct values
