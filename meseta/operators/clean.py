"""From landed payloads to typed, deduplicated rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meseta.functions import instant
from meseta.operators.guards import require_fields


def _require_keys(df: DataFrame, keys: Sequence[str]) -> None:
    if not keys:
        raise ValueError("At least one key column is required.")
    require_fields(df, keys, "keyed rows")


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows of each key.

    Spark turns the rank filter into a group limit that runs before the shuffle,
    so each task ships at most ``k`` rows per key and a hot key stays cheap.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per natural key: the latest by ``order``, ties settled by content.

    The result does not depend on row order, so reruns keep the same survivor.
    """
    _require_keys(df, keys)
    tie_break = F.xxhash64(*[F.col(name) for name in df.columns])
    ordering = [F.col(name).desc_nulls_last() for name in order] + [tie_break]
    return first_by_key(df, keys, ordering)


def distinct_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key where the other columns depend on the key anyway."""
    _require_keys(df, keys)
    return df.dropDuplicates(list(keys))


def flatten_envelope(df: DataFrame, keep_empty: bool = True) -> DataFrame:
    """One row per element of ``data`` with the envelope's ingestion timestamp.

    An empty or NULL array leaves one all-NULL record. ``keep_empty=False`` drops
    it here, on the struct; a later filter over dozens of flattened columns
    would multiply the constraints the optimizer tracks.
    """
    require_fields(df, ["data", "metadata.ingestion_timestamp"], "envelope")
    unfold = F.explode_outer if keep_empty else F.explode
    records = df.select(
        F.col("metadata.ingestion_timestamp").alias("ingestion_timestamp"),
        unfold("data").alias("record"),
    )
    if not keep_empty:
        records = records.filter(F.col("record").isNotNull())
    return records.select("record.*", "ingestion_timestamp")


def with_traceability(df: DataFrame, source: str) -> DataFrame:
    """``source`` and a typed ``ingestion_timestamp`` (NULL when the input has none)."""
    if "ingestion_timestamp" in df.columns:
        stamp = F.col("ingestion_timestamp")
        if dict(df.dtypes)["ingestion_timestamp"] == "string":
            stamp = instant(stamp)
    else:
        stamp = F.lit(None).cast("timestamp")
    return df.withColumns({"source": F.lit(source), "ingestion_timestamp": stamp})


def explode_parallel(
    df: DataFrame, carried: dict[str, Column], arrays: dict[str, Column]
) -> DataFrame:
    """Parallel arrays to one row per position; short arrays are padded with NULL.

    ``carried`` columns repeat on every row of their location.
    """
    zipped = F.arrays_zip(*[column.alias(name) for name, column in arrays.items()])
    return df.select(
        *[column.alias(name) for name, column in carried.items()],
        F.explode(zipped).alias("_row"),
    ).select(*carried, *[F.col(f"_row.{name}").alias(name) for name in arrays])


def in_window(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Half-open ``[start, end)``: consecutive runs neither overlap nor leave a hole.

    Partition columns that stored tables derive from ``ts`` are bounded as well, so the
    scan lists the partitions of the window only; callers needn't know the layout.
    """
    low, high = F.lit(start), F.lit(end)
    for name, transform in derived_partitions(df, ts):
        df = df.filter((F.col(name) >= transform(low)) & (F.col(name) <= transform(high)))
    return df.filter((F.col(ts) >= low) & (F.col(ts) < high))


PARTITION_TRANSFORMS = {
    "days": lambda ts: F.to_date(ts),
    "months": lambda ts: F.date_format(ts, "yyyy-MM"),
}


def derived_partitions(df: DataFrame, ts: str) -> list[tuple[str, Callable[[Column], Column]]]:
    """Columns whose comment says that they are days or months of ``ts``, and how."""
    comments = {field.name: field.metadata.get("comment") for field in df.schema.fields}
    return [
        (name, transform) for name, comment in comments.items()
        for kind, transform in PARTITION_TRANSFORMS.items() if comment == f"{kind}({ts})"]


def of_class(df: DataFrame, magnitude: Column, time: Column, wanted: tuple) -> DataFrame:
    """Rows of one (magnitude, time) class."""
    return df.filter((magnitude == F.lit(wanted[0])) & (time == F.lit(wanted[1])))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column missing on any side is an error."""
    if not frames:
        raise ValueError("Nothing to union.")
    return reduce(DataFrame.unionByName, frames)


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(name).isNull() for name in columns])
