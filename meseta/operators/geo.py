"""Resolving source place names against a canonical master."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meseta.functions import blank_to_null, plain_name
from meseta.operators.clean import latest_by_key
from meseta.operators.guards import require_fields
from meseta.operators.joins import lookup

PROVINCE_COLUMNS = (
    "province_code", "province_name", "autonomous_community_code", "autonomous_community_name",
)


def alias_frame(spark: SparkSession, aliases: Mapping[str, str]) -> DataFrame:
    """Alias settings as rows with both names in comparable form."""
    for source, target in aliases.items():
        if not isinstance(source, str) or not isinstance(target, str):
            raise ValueError("Aliases must map text to text.")
    frame = spark.createDataFrame(list(aliases.items()), "alias string, canonical string")
    return frame.select(
        "alias",
        "canonical",
        blank_to_null(plain_name(F.col("alias"))).alias("alias_key"),
        blank_to_null(plain_name(F.col("canonical"))).alias("canonical_key"),
    )


def canonical_key(name: Column, aliases: Mapping[str, str]) -> Column:
    """Comparable form of ``name`` after the controlled alias fallback.

    The aliases are package settings of a few entries and become one literal map;
    a name outside the map keeps its own comparable form.
    """
    plain = plain_name(name)
    if not aliases:
        return plain
    pairs: list[Column] = []
    for source, target in aliases.items():
        pairs += [plain_name(F.lit(source)), plain_name(F.lit(target))]
    return F.coalesce(F.create_map(*pairs)[plain], plain)


def prepare_master(
    master: DataFrame, columns: Sequence[str] = PROVINCE_COLUMNS, code: str | None = None,
    name: str | None = None,
) -> DataFrame:
    """Master rows, one per code, with the comparable name as ``_place_key``."""
    require_fields(master, columns, "place master")
    code, name = code or columns[0], name or columns[1]
    unique = latest_by_key(master.select(*columns), [code])
    return unique.withColumn("_place_key", plain_name(F.col(name)))


def resolve_place(
    df: DataFrame,
    master: DataFrame,
    source_column: str,
    aliases: Mapping[str, str],
    columns: Sequence[str] = PROVINCE_COLUMNS,
) -> DataFrame:
    """Left join of the source name to the master; the source column is kept.

    A master of provinces is far below Spark's broadcast threshold, so the facts
    are not shuffled.
    """
    require_fields(df, [source_column], "place source")
    prepared = prepare_master(master, columns)
    keyed = df.withColumn("_place_key", canonical_key(F.col(source_column), aliases))
    return lookup(keyed, prepared, ["_place_key"]).select(*df.columns, *columns)


def unmatched(df: DataFrame, columns: Sequence[str] = PROVINCE_COLUMNS[:2]) -> DataFrame:
    """Rows without a canonical code or name."""
    return df.filter(F.col(columns[0]).isNull() | F.col(columns[1]).isNull())


def require_matched(
    df: DataFrame, dataset: str, columns: Sequence[str] = PROVINCE_COLUMNS[:2],
    scope: Column | None = None,
) -> None:
    """Raise when rows within ``scope`` stayed without a canonical place."""
    require_fields(df, columns, dataset)
    missing = unmatched(df if scope is None else df.filter(scope), columns).count()
    if missing:
        raise ValueError(f"{dataset}: {missing} rows match no canonical place.")


def attach_station_place(
    observations: DataFrame, stations: DataFrame, columns: Sequence[str] = PROVINCE_COLUMNS
) -> DataFrame:
    """Place of each observation through its station."""
    places = latest_by_key(stations.select("station_id", *columns), ["station_id"])
    return lookup(observations, places, ["station_id"])
