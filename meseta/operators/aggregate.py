"""Means over stages of geography and time, pivots, energy sums, coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meseta.functions import circular_mean, floor_grain, power_to_energy


def staged_mean(
    df: DataFrame,
    stages: Sequence[Sequence[str]],
    scalars: Sequence[str] = (),
    directions: Sequence[str] = (),
) -> DataFrame:
    """Mean of means: each stage averages the rows of the stage before it.

    Scalars use the plain mean, directions the circular mean. Each stage
    combines partial results before its shuffle; only the first one sees the
    detail rows, so a hot point or region costs no more than any other.
    """
    current = df
    for keys in stages:
        current = current.groupBy(*keys).agg(
            *[F.avg(F.col(name).cast("double")).alias(name) for name in scalars],
            *[circular_mean(F.col(name)).alias(name) for name in directions],
        )
    return current


def pivot_metrics(
    df: DataFrame,
    keys: Sequence[str],
    indicator: str,
    value: str,
    mapping: Mapping[object, str],
    strict: bool = False,
) -> DataFrame:
    """Long (indicator, value) rows to one column per metric.

    The value is copied: nothing is averaged or summed. ``strict`` stops the
    query when a metric would have to choose between several values. Indicators
    outside ``mapping`` are dropped before the shuffle.
    """
    wanted = df.filter(F.col(indicator).isin(*mapping))
    metrics = [
        F.max(F.when(F.col(indicator) == key, F.col(value))).alias(name)
        for key, name in mapping.items()
    ]
    if not strict:
        return wanted.groupBy(*keys).agg(*metrics)
    counts = [
        F.count(F.when(F.col(indicator) == key, F.col(value))).alias(f"_n_{i}") for i, key in enumerate(mapping)]
    wide = wanted.groupBy(*keys).agg(*metrics, *counts)
    # on every metric: a reader that takes one column only must meet the guard as well
    kinds = dict(wide.dtypes)
    return wide.withColumns({
        name: F.when(
            F.col(f"_n_{i}") > 1, F.raise_error(F.lit("Several values for one metric and key")).cast(kinds[name]),
        ).otherwise(F.col(name))
        for i, name in enumerate(mapping.values())
    }).drop(*[f"_n_{i}" for i in range(len(mapping))])


def energy_rollup(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    powers: Mapping[str, Column],
    *,
    grain: str = "FIFTEEN_MINUTES",
    step_minutes: int = 5,
    expected: int = 3,
    out: str = "gold_timestamp",
) -> DataFrame:
    """Power samples to interval energy, summed to ``grain``.

    Power itself is never summed. A metric needs one sample in each of its
    ``expected`` steps, otherwise the interval stays NULL; signs are kept. A step with
    several samples stops the query: which of them counts isn't decided here.
    """
    # two levels, so that a step is seen as a whole: samples of a step, steps of an interval
    step = F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / (60 * step_minutes)) * (60 * step_minutes))
    steps = df.groupBy(*keys, step.alias("_step")).agg(*[
        F.struct(F.count(power).alias("n"), F.max(power).alias("power")).alias(name)
        for name, power in powers.items()])
    energies = [
        F.when(F.count_if(F.col(name)["n"] > 1) > 0,
               F.raise_error(F.lit(f"Several samples of {name} in one step")).cast("double"))
        .when(F.count(F.col(name)["power"]) == expected, F.sum(power_to_energy(F.col(name)["power"], step_minutes)))
        .alias(name)
        for name in powers
    ]
    return steps.groupBy(*keys, floor_grain(F.col("_step"), grain).alias(out)).agg(*energies)


def period_sum(
    df: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str], period: str = "month"
) -> DataFrame:
    """Energy over periods longer than its own grain: a plain sum."""
    return df.groupBy(*keys, F.date_trunc(period, F.col(ts)).alias("period")).agg(
        *[F.sum(name).alias(name) for name in values]
    )


def coverage(df: DataFrame, by: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Share of rows with a value, one row per group and metric."""
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count(name).alias(name) for name in metrics]
    )
    long = counted.unpivot([*by, "n_rows"], list(metrics), "metric", "n_present")
    return long.withColumn("coverage", F.col("n_present") / F.col("n_rows"))
