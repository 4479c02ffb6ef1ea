"""Plans and results when a side is too large to broadcast and when one key dominates."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from meseta.operators import aggregate, clean, gaps, geo, joins
from oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def shuffled_joins(spark):
    """No broadcast at all, and shuffle partitions count as skewed from a few kilobytes on."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", [
    "gold_province_hourly", "geo_enrich", "fact_join", "avg_two_stage", "window_coverage", "dim_reference",
    "capacity_vs_generation", "value_fidelity", "cu08_temperature_demand"])
def test_results_without_broadcast(spark, shuffled_joins, name):
    plan = driver.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    assert differences(
        spark, connect(FOLDER), FOLDER, name, driver.queries()[name], driver.oracle_sql()[name]) == []


def hot(spark, n=6000):
    """One key holds a third of the rows."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 400)).alias("k"),
        (F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 7)).alias("ts"), F.col("id"))


def test_hot_key_survives_lookup(spark, shuffled_joins):
    facts = hot(spark)
    dim = facts.select("k").distinct().withColumn("name", F.upper("k"))
    joined = joins.lookup(facts, dim, ["k"])
    assert joined.count() == facts.count()
    assert joined.filter(F.upper("k") != F.col("name")).count() == 0


def test_hot_key_ships_one_row_per_task(spark):
    """The group limit leaves at most one row per key and task for the shuffle."""
    latest = clean.latest_by_key(hot(spark), ["k"], ["id"])
    assert latest.filter("k = 'hot'").first()["id"] == 5997
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_hot_series_is_windowed_in_buckets(spark):
    found = gaps.steps(hot(spark), ["k"], "ts").groupBy("k").agg(F.sum("n").alias("n")).filter("k = 'hot'").first()
    assert found["n"] == 1999


def test_merge_needs_no_extra_shuffle(spark):
    """Each frame is shuffled once for its own aggregate; putting them together adds none."""
    facts = hot(spark)
    frames = {name: facts.groupBy("k").agg(F.sum("id").alias(name)) for name in ("a", "b", "c")}
    plan = joins.merge_on_grain(frames, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3


def test_means_combine_before_the_shuffle(spark):
    frame = hot(spark).withColumn("v", F.col("id").cast("double"))
    plan = aggregate.staged_mean(frame, [["k", "ts"], ["k"]], ["v"], [])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_avg") >= 2


def test_large_alias_free_master_still_matches(spark, shuffled_joins):
    rng = random.Random(1)
    names = [f"Lugar {i}" for i in range(300)]
    master = spark.createDataFrame(
        [(str(i), name, "1", "C") for i, name in enumerate(names)], ", ".join(f"{c} string" for c in geo.PROVINCE_COLUMNS))
    rows = spark.createDataFrame([(rng.choice(names).upper(),) for _ in range(900)], "province string")
    assert geo.unmatched(geo.resolve_place(rows, master, "province", {})).count() == 0
