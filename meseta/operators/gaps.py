"""Step analysis of time series: differences between consecutive instants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meseta.functions import minutes_between


# Eras of buckets: each holds at most some hundreds of buckets.
_ERA = {"minute": "day", "hour": "month", "day": "year", "month": "century"}


def steps(df: DataFrame, series: Sequence[str], ts: str, bucket: str = "hour") -> DataFrame:
    """Differences in minutes between consecutive instants of each series.

    Rows: ``(series..., minutes, n)``; ``n`` counts equal steps of repeated
    instants, so that summing ``n`` equals the steps a plain ``lag`` would give.

    A series is cut into time buckets and ``lag`` runs inside each bucket, so
    the longest series spreads over many tasks. The step that crosses buckets
    comes from one (first, last) row per bucket, and these are carried in two
    levels: inside an era of many buckets, and between eras. No task orders all
    buckets of a series. Repeated instants are counted before the window sees them.
    """
    era = _ERA.get(bucket, "century")
    instants = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(*series, F.col(ts).alias("_ts"))
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_bucket", F.date_trunc(bucket, F.col("_ts")))
    )
    inside = Window.partitionBy(*series, "_bucket").orderBy("_ts")
    whole = Window.partitionBy(*series, "_bucket")
    placed = instants.withColumns({
        "_before": F.lag("_ts").over(inside),
        "_last": F.max("_ts").over(whole),
    })

    # Both branches read the same shuffle of `instants`.
    within = placed.filter(F.col("_before").isNotNull())
    firsts = placed.filter(F.col("_before").isNull()).withColumn("_era", F.date_trunc(era, F.col("_bucket")))
    in_era = Window.partitionBy(*series, "_era")
    carried = firsts.withColumns({
        "_before": F.lag("_last").over(in_era.orderBy("_bucket")), "_era_last": F.max("_last").over(in_era)})
    crossing = carried.filter(F.col("_before").isNotNull()).drop("_era", "_era_last").unionByName(
        carried.filter(F.col("_before").isNull()).withColumn(
            "_before", F.lag("_era_last").over(Window.partitionBy(*series).orderBy("_era"))).drop("_era", "_era_last"))
    step = F.struct(minutes_between(F.col("_before"), F.col("_ts")).alias("minutes"),
                    F.lit(1).cast("bigint").alias("n"))
    copies = F.struct(F.lit(0.0).alias("minutes"), (F.col("_copies") - 1).alias("n"))
    return (
        within.unionByName(crossing)
        .select(*series, F.inline(F.array(step, copies)))
        .filter(F.col("minutes").isNotNull() & (F.col("n") > 0))
    )


def step_summary(
    df: DataFrame, series: Sequence[str], ts: str, expected_minutes: float, by: Sequence[str] = ()
) -> DataFrame:
    """Total steps and steps of the expected length; gaps are counted, never filled."""
    found = steps(df, series, ts)
    matching = F.sum(F.when(F.col("minutes") == expected_minutes, F.col("n")).otherwise(0))
    return found.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_steps"),
        F.coalesce(matching, F.lit(0)).alias("n_matching"),
    )


def step_histogram(
    df: DataFrame, series: Sequence[str], ts: str, by: Sequence[str] = (), whole_minutes: bool = False
) -> DataFrame:
    """How often each step length occurs."""
    found = steps(df, series, ts)
    if whole_minutes:
        found = found.withColumn("minutes", F.floor("minutes"))
    return found.groupBy(*by, "minutes").agg(F.sum("n").alias("n"))


def off_grain(df: DataFrame, series: Sequence[str], ts: str, expected_minutes: float, by: Sequence[str]) -> DataFrame:
    """Steps of another length than expected, counted per group and length."""
    return step_histogram(df, series, ts, by).filter(F.col("minutes") != expected_minutes)
