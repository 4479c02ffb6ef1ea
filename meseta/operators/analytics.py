"""Relationships, ranges, shares and rankings over Gold facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meseta.functions import bin_floor, sector
from meseta.operators.clean import first_by_key

# Sums of doubles in another order differ by less; values of their own are further apart.
EDGE_NOISE = 1e-9


def _correlation(x: Column, y: Column) -> Column:
    """Pearson correlation; NULL when a side does not vary or pairs are missing."""
    both = x.isNotNull() & y.isNotNull()
    varies = (F.min(F.when(both, x)) < F.max(F.when(both, x))) & (
        F.min(F.when(both, y)) < F.max(F.when(both, y))
    )
    return F.when(varies, F.corr(F.when(both, x), F.when(both, y)))


def correlate(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Correlation of two metrics and the number of pairs, overall or per group."""
    a, b = F.col(x), F.col(y)
    return df.groupBy(*by).agg(
        F.count_if(a.isNotNull() & b.isNotNull()).alias("n_pairs"),
        _correlation(a, b).alias("correlation"),
    )


def offset_scan(
    df: DataFrame, keys: Sequence[str], ts: str, x: str, y: str, hours: Sequence[int],
    by: Sequence[str] = (), block_hours: int = 720,
) -> DataFrame:
    """Correlation of ``x`` shifted by each offset with ``y``.

    ``df`` holds one row per (keys, ts). Series are cut into blocks of time, and a row
    whose ``y`` lies within reach of another block is copied there, so every row is
    shuffled once plus its share of the edges, whatever the number of offsets. Inside a
    block each offset is a frame of one window; what offsets sum up is combined before
    the last, small shuffle.
    """
    hour = 3_600_000_000
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    block = lambda instant: F.floor(instant / F.lit(block_hours * hour))
    wanted = F.array_distinct(F.array(block(at), *[block(at - h * hour) for h in hours]))
    rows = df.select(*keys, x, y, at.alias("_at"), F.explode(wanted).alias("_block"))
    nearby = Window.partitionBy(*keys, "_block").orderBy("_at")
    own = rows.select("*", *[
        F.max(y).over(nearby.rangeBetween(h * hour, h * hour)).alias(f"_y{i}") for i, h in enumerate(hours)
    ]).filter(F.col("_block") == block(F.col("_at")))
    a = F.col(x)
    sums = own.groupBy(*by).agg(*[
        F.struct(
            F.lit(h).alias("offset_hours"), F.count_if(a.isNotNull() & F.col(f"_y{i}").isNotNull()).alias("n_pairs"),
            _correlation(a, F.col(f"_y{i}")).alias("correlation")).alias(f"_offset{i}")
        for i, h in enumerate(hours)])
    return sums.select(*by, F.inline(F.array(*[f"_offset{i}" for i in range(len(hours))]))).select(
        "offset_hours", *by, "n_pairs", "correlation")


def best_offset(scan: DataFrame, by: Sequence[str]) -> DataFrame:
    """The offset with the highest correlation in each group."""
    return first_by_key(
        scan.filter(F.col("correlation").isNotNull()), by,
        [F.col("correlation").desc(), F.col("offset_hours")],
    )


def mean_by_bin(df: DataFrame, x: str, y: str, width: float, by: Sequence[str] = ()) -> DataFrame:
    """Mean of ``y`` per range of ``x``.

    ``x`` is often a mean itself: one that is the edge of a range up to summation noise
    belongs to the range that begins there, whatever the order of its sum.
    """
    return (
        df.filter(F.col(x).isNotNull())
        .groupBy(*by, bin_floor(F.col(x) + F.lit(EDGE_NOISE), width).alias("bin_start"))
        .agg(F.count(y).alias("n"), F.avg(y).alias("mean"))
    )


def mean_by_sector(df: DataFrame, degrees: str, y: str, sectors: int = 8) -> DataFrame:
    """Mean of ``y`` per direction sector."""
    return (
        df.filter(F.col(degrees).isNotNull())
        .groupBy(sector(F.col(degrees), sectors).alias("sector"))
        .agg(F.count(y).alias("n"), F.avg(y).alias("mean"))
    )


def mix_share(df: DataFrame, parts: Sequence[str], total: str, by: Sequence[str]) -> DataFrame:
    """Share of each part in the summed total of a period; NULL for a zero total."""
    summed = df.groupBy(*by).agg(*[F.sum(name).alias(name) for name in dict.fromkeys([*parts, total])])
    denominator = F.nullif(F.col(total), F.lit(0.0))
    return summed.select(
        *by, F.col(total).alias("total"),
        *[(F.col(name) / denominator).alias(f"{name}_share") for name in parts],
    )


def unpivot_series(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Wide metrics to (keys, metric, value) rows without NULL values."""
    long = df.unpivot(list(keys), list(metrics), "metric", "value")
    return long.filter(F.col("value").isNotNull())


def top_k(df: DataFrame, by: Sequence[str], value: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    """The ``k`` largest rows per group with their rank; ties follow ``tie_break``."""
    order = [F.col(value).desc_nulls_last(), *[F.col(name) for name in tie_break]]
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= k)


def capacity_and_generation(
    capacity: DataFrame, generation: DataFrame, keys: Sequence[str], capacity_mw: str, energy_mwh: str
) -> DataFrame:
    """Installed capacity next to the generation of the same place and period.

    Generation is summed to the keys first, so the join pairs single rows.
    """
    produced = generation.groupBy(*keys).agg(F.sum(energy_mwh).alias(energy_mwh))
    per_mw = F.col(energy_mwh) / F.nullif(F.col(capacity_mw), F.lit(0.0))
    return capacity.select(*keys, capacity_mw).join(produced, list(keys)).withColumn("mwh_per_mw", per_mw)
