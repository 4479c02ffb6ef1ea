import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meseta.functions import minutes_between
from meseta.operators import gaps

START = dt.datetime(2026, 1, 1)


def series(spark, seed):
    rng = random.Random(seed)
    rows = []
    for key in "ABCD":
        for _ in range(rng.randint(1, 60)):
            rows.append((key, START + dt.timedelta(minutes=rng.choice((0, 5, 65, 600, 3000)) * rng.randint(0, 9))))
    rows.append(("E", None))
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz")


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("bucket", ["hour", "day"])
def test_steps_equal_a_plain_lag(spark, seed, bucket):
    frame = series(spark, seed)
    before = F.lag("ts").over(Window.partitionBy("k").orderBy("ts"))
    plain = frame.select("k", minutes_between(before, F.col("ts")).alias("minutes")).filter("minutes IS NOT NULL")
    expected = {(r["k"], r["minutes"]): r["count"] for r in plain.groupBy("k", "minutes").count().collect()}
    found = gaps.steps(frame, ["k"], "ts", bucket).groupBy("k", "minutes").agg(F.sum("n").alias("n"))
    assert {(r["k"], r["minutes"]): r["n"] for r in found.collect()} == expected


def test_gaps_are_counted(spark):
    stamps = [0, 60, 120, 240, 300]
    frame = spark.createDataFrame(
        [("A", START + dt.timedelta(minutes=m)) for m in stamps], "k string, ts timestamp_ntz")
    assert tuple(gaps.step_summary(frame, ["k"], "ts", 60).first()) == (4, 3)
    assert [tuple(r) for r in gaps.off_grain(frame, ["k"], "ts", 60, ["k"]).collect()] == [("A", 120.0, 1)]
    empty = frame.filter("false")
    assert tuple(gaps.step_summary(empty, ["k"], "ts", 60).first()) == (0, 0)


def test_no_window_over_a_whole_series(spark):
    """The detail rows are windowed per bucket; only bucket rows are windowed per series."""
    frame = series(spark, 1)
    plan = gaps.steps(frame, ["k"], "ts")._jdf.queryExecution().optimizedPlan().toString()
    assert "_bucket" in plan
