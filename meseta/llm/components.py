"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meseta.llm.common import discard, stage


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


ROWS_OF_FILE = 250_000


def _written(rows: DataFrame, purpose: str, size: int) -> DataFrame:
    """Staged in as many files as ``size`` rows need: late rounds are small, and so are most graphs."""
    return stage(rows.coalesce(8 + size // ROWS_OF_FILE), purpose)


def _minima(neighbours: DataFrame, size: int) -> DataFrame:
    """The least of each node and its neighbours; written, so that the join below can split a hub."""
    return _written(neighbours.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least")), "minima", size)


def _large_star(edges: DataFrame, size: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    minima = _minima(both, size)
    # larger neighbours of u move to the least neighbour of u
    moved = both.join(minima, "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return _written(moved.where("u <> v").distinct(), "large-star", size)


def _small_star(edges: DataFrame, size: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    minima = _minima(down, size)
    # smaller neighbours of u, and u itself, move to the least of them
    moved = down.join(minima, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = minima.select("u", F.col("least").alias("v"))
    return _written(moved.unionByName(own).where("u <> v").distinct(), "small-star", size)


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` from ``u``, ``v``: the least node of each component, for nodes with an edge.

    Edges stay in tables; the driver sees a count and a checksum per round. Each round
    writes its edges, so a lost executor costs one round at most.
    """
    now = stage(edges.select("u", "v").where("u <> v").distinct(), "edges")
    before, seen = None, _signature(now)
    while seen[0] and seen != before:
        large = _large_star(now, seen[0])
        after = _small_star(large, seen[0])
        discard(now, large)
        now, before, seen = after, seen, _signature(after)
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
