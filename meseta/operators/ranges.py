"""Backfill windows over inclusive date ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tile_ranges(df: DataFrame, start: str, end: str, days: int) -> DataFrame:
    """Cut each inclusive ``[start, end]`` into consecutive windows of at most ``days`` days.

    A start after its end stops the query.
    """
    if days <= 0:
        raise ValueError("A window needs at least one day.")
    first, last = F.col(start).cast("date"), F.col(end).cast("date")
    ordered = F.when(first <= last, first).otherwise(
        F.raise_error(F.lit("Range starts after its end")).cast("date")
    )
    windows = F.posexplode(F.sequence(ordered, last, F.make_dt_interval(F.lit(days))))
    kept = [name for name in df.columns if name not in (start, end)]
    return df.select(*kept, last.alias("_last"), windows.alias("window_index", "window_start")).select(
        *kept, "window_index", "window_start",
        F.least(F.date_add("window_start", days - 1), F.col("_last")).alias("window_end"),
    )


def window_coverage(
    windows: DataFrame, observations: DataFrame, entity: Sequence[str], on_date: str, days: int
) -> DataFrame:
    """Observations per backfill window; windows without any stay with 0.

    Windows of one entity start every ``days`` days, so the window of a date is
    plain arithmetic on the entity's first day and no range join is needed.
    Observations are counted per entity and day before they are joined.
    """
    entity = list(entity)
    first_day = windows.groupBy(*entity).agg(F.min("window_start").alias("_first"))
    daily = observations.groupBy(*entity, F.col(on_date).cast("date").alias("_day")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    index = F.floor(F.datediff(F.col("_day"), F.col("_first")) / days).cast("int")
    counted = (
        daily.join(first_day, entity).withColumn("window_index", index)
        .groupBy(*entity, "window_index").agg(F.sum("_n").alias("n_observations"))
    )
    return windows.join(counted, [*entity, "window_index"], "left").fillna(0, ["n_observations"])
