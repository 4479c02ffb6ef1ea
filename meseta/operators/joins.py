"""Joins: lookups, assembly of pre-aggregated frames, references.

No join carries a broadcast hint. Spark broadcasts a side when its size is below
``spark.sql.autoBroadcastJoinThreshold``, known from file sizes when planning or
from shuffle sizes at run time, and otherwise shuffles and splits hot keys
(adaptive skew join). A master that outgrows the threshold therefore changes the
plan instead of the executors' memory.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def lookup(facts: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join to a dimension that is unique on ``on``; no fact row is lost or multiplied."""
    return facts.join(dim, list(on), "left")


def merge_on_grain(frames: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer combination of frames that are each unique on ``keys``.

    Written as union + one aggregate: N frames cost one shuffle of already
    aggregated rows, where chained full joins reshuffle after every coalesced
    key. A frame with a repeated key stops the query instead of multiplying rows.
    Metric names must not repeat between frames.
    """
    keys = list(keys)
    metrics: dict[str, str] = {}
    for name, frame in frames.items():
        for column in frame.columns:
            if column in keys:
                continue
            if column in metrics:
                raise ValueError(f"Metric {column} occurs in both {metrics[column]} and {name}")
            metrics[column] = name

    tagged = [frame.withColumn("_frame", F.lit(name)) for name, frame in frames.items()]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    counts = [
        F.count_if(F.col("_frame") == name).alias(f"_rows_{i}") for i, name in enumerate(frames)
    ]
    merged = stacked.groupBy(*keys).agg(*[F.max(m).alias(m) for m in metrics], *counts)
    repeated = reduce(lambda a, b: a | b, [F.col(f"_rows_{i}") > 1 for i in range(len(frames))])
    # on every column, so that no selection of columns prunes the guard away
    kinds = dict(merged.dtypes)
    return merged.select(*[
        F.when(repeated, F.raise_error(F.lit(f"A frame repeats a key of {keys}")).cast(kinds[name]))
        .otherwise(F.col(name)).alias(name)
        for name in (*keys, *metrics)])


def dangling(facts: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct fact keys without a dimension member."""
    return facts.select(*on).distinct().join(dim.select(*on), list(on), "left_anti")


def new_members(candidates: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Members not yet stored."""
    return candidates.join(existing.select(key), key, "left_anti")
