"""Bronze -> Silver: typed, deduplicated, place-enriched observation tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meseta import catalog, config
from meseta.functions import blank_to_null, day, decimal_comma, dms_to_degrees, instant
from meseta.operators.clean import (
    explode_parallel,
    latest_by_key,
    of_class,
    with_traceability,
)
from meseta.operators.geo import resolve_place
from meseta.operators.guards import has_struct_elements, require_fields, require_struct
from meseta.sources.bronze import Bronze

_NEWEST = ("ingestion_timestamp",)
_TRACE = ("source", "ingestion_timestamp")


def _unique(df: DataFrame, table: str, newest: tuple[str, ...] = _NEWEST) -> DataFrame:
    return latest_by_key(df, catalog.SILVER_TABLES[table].keys, newest)


# AEMET -------------------------------------------------------------------------


def stations(bronze: DataFrame) -> DataFrame:
    """Station master with decimal coordinates."""
    require_fields(bronze, catalog.STATION_FIELDS, "AEMET stations")
    rows = with_traceability(bronze, "aemet")
    typed = rows.select(
        F.col("indicativo").alias("station_id"), "nombre", "provincia",
        decimal_comma(F.col("altitud")).alias("altitud"),
        dms_to_degrees(F.col("latitud"), "latitude").alias("latitude"),
        dms_to_degrees(F.col("longitud"), "longitude").alias("longitude"),
        "indsinop", *_TRACE,
    )
    return _unique(typed, "silver_aemet_stations")


def daily_climatology(bronze: DataFrame) -> DataFrame:
    """Daily values; measurements arrive as text with a decimal comma."""
    fields = ("indicativo", "fecha", *catalog.DAILY_FIELD_ORDER)
    require_fields(bronze, fields, "AEMET daily climatology")
    rows = with_traceability(bronze, "aemet")
    measured = set(catalog.DAILY_NUMBER_FIELDS)
    typed = rows.select(
        F.col("indicativo").alias("station_id"), day(F.col("fecha")).alias("observation_date"),
        *[
            decimal_comma(F.col(name)).alias(name) if name in measured else F.col(name)
            for name in catalog.DAILY_FIELD_ORDER
        ],
        *_TRACE,
    )
    return _unique(typed, "silver_aemet_daily_climatology")


def current_observations(bronze: DataFrame) -> DataFrame:
    """Hourly station observations; the measures pass through as delivered."""
    fields = ("idema", "fint", "lat", "lon", *catalog.CURRENT_MEASURES)
    require_fields(bronze, fields, "AEMET current observations")
    rows = with_traceability(bronze, "aemet")
    renamed = rows.select(
        F.col("idema").alias("station_id"), instant(F.col("fint")).alias("observation_timestamp"),
        F.col("lat").try_cast("double").alias("latitude"),
        F.col("lon").try_cast("double").alias("longitude"),
        *catalog.CURRENT_MEASURES, *_TRACE,
    )
    return _unique(renamed, "silver_aemet_current_observations")


# Open-Meteo ----------------------------------------------------------------------


@dataclass(frozen=True)
class SeriesLayout:
    """Where a parallel-array payload keeps its arrays and its location id."""

    table: str
    container: str
    variables: tuple[str, ...]
    id_field: str


HOURLY = SeriesLayout(
    "silver_open_meteo_hourly", "hourly", catalog.SURFACE_VARIABLES, "station_id")
HISTORICAL_FORECAST = SeriesLayout(
    "silver_open_meteo_historical_forecast", "hourly", catalog.HUB_HEIGHT_VARIABLES, "station_id")
QUARTER_HOURLY = SeriesLayout(
    "silver_open_meteo_15min", "minutely_15",
    catalog.SURFACE_VARIABLES + catalog.HUB_HEIGHT_VARIABLES, "location_id")


def weather_series(bronze: DataFrame, layout: SeriesLayout) -> DataFrame:
    """One row per location and instant out of one envelope per location."""
    arrays = ("time", *layout.variables)
    require_struct(bronze, "data", ("elevation", "latitude", "longitude", layout.container), layout.table)
    require_struct(bronze, "metadata", (layout.id_field, "station_name", "province", *_TRACE), layout.table)
    require_struct(bronze, f"data.{layout.container}", arrays, layout.table)
    rows = explode_parallel(
        bronze,
        carried={
            "station_id": F.col(f"metadata.{layout.id_field}"),
            "station_name": F.col("metadata.station_name"),
            "province": F.col("metadata.province"),
            **{name: F.col(f"data.{name}").cast("double") for name in ("latitude", "longitude", "elevation")},
            "source": F.col("metadata.source"),
            "ingestion_timestamp": instant(F.col("metadata.ingestion_timestamp")),
        },
        arrays={name: F.col(f"data.{layout.container}.{name}") for name in arrays},
    )
    typed = rows.select(
        "station_id", instant(F.col("time")).alias("observation_timestamp"),
        "station_name", "province", "latitude", "longitude", "elevation",
        *layout.variables, *_TRACE,
    )
    return _unique(typed, layout.table)


# ESIOS ---------------------------------------------------------------------------

_INDICATOR_FIELDS = ("id", "name", "short_name", "magnitud", "tiempo", "values", "values_updated_at")

OBSERVATION_SCHEMA = (
    "indicator_id bigint, dataset string, indicator_name string, indicator_short_name string, "
    "magnitude_id bigint, magnitude_name string, time_id bigint, time_name string, "
    "observation_timestamp timestamp, source_datetime timestamp, tz_time timestamp, "
    "esios_geo_id bigint, esios_geo_name string, value double, values_updated_at timestamp, "
    "source string, ingestion_timestamp timestamp"
)


def indicator_observations(bronze: DataFrame, dataset: Column | None = None) -> DataFrame:
    """Indicator envelopes to observation rows, not yet deduplicated.

    The first entry of each classifier list names the class. Frames whose schema
    was inferred from empty value lists give a typed empty result.
    """
    require_struct(bronze, "data", ("indicator",), "ESIOS")
    require_struct(bronze, "data.indicator", _INDICATOR_FIELDS, "ESIOS")
    require_fields(bronze, ["metadata.ingestion_timestamp"], "ESIOS")
    series = F.col("data.indicator")
    if not has_struct_elements(bronze, "data.indicator.values"):
        if not bronze.filter(F.size(series["values"]) > 0).isEmpty():
            raise ValueError("ESIOS values hold records that are not structs.")
        return bronze.sparkSession.createDataFrame([], OBSERVATION_SCHEMA)

    magnitude = F.get(series["magnitud"], F.lit(0))
    time = F.get(series["tiempo"], F.lit(0))
    exploded = bronze.select(
        series["id"].cast("bigint").alias("indicator_id"),
        (F.col("dataset") if dataset is None else dataset).alias("dataset"),
        series["name"].alias("indicator_name"),
        series["short_name"].alias("indicator_short_name"),
        magnitude["id"].cast("bigint").alias("magnitude_id"),
        magnitude["name"].alias("magnitude_name"),
        time["id"].cast("bigint").alias("time_id"),
        time["name"].alias("time_name"),
        instant(series["values_updated_at"]).alias("values_updated_at"),
        instant(F.col("metadata.ingestion_timestamp")).alias("ingestion_timestamp"),
        F.explode(series["values"]).alias("point"),
    )
    point = F.col("point")
    return exploded.select(
        "indicator_id", "dataset", "indicator_name", "indicator_short_name",
        "magnitude_id", "magnitude_name", "time_id", "time_name",
        instant(point["datetime_utc"]).alias("observation_timestamp"),
        instant(point["datetime"]).alias("source_datetime"),
        instant(point["tz_time"]).alias("tz_time"),
        point["geo_id"].cast("bigint").alias("esios_geo_id"),
        point["geo_name"].alias("esios_geo_name"),
        point["value"].cast("double").alias("value"),
        "values_updated_at", F.lit("esios").alias("source"), "ingestion_timestamp",
    )


@dataclass(frozen=True)
class IndicatorFamily:
    table: str
    datasets: tuple[str, ...]
    magnitude_and_time: tuple[int, int]


ENERGY_HOURLY = IndicatorFamily(
    "silver_esios_energy_hourly",
    tuple(catalog.HOURLY_ENERGY_DATASETS.values()), catalog.ENERGY_BY_HOUR)
POWER_5MIN = IndicatorFamily(
    "silver_esios_power_5min",
    tuple(catalog.FIVE_MINUTE_POWER_DATASETS.values()), catalog.POWER_BY_FIVE_MINUTES)
CAPACITY_MONTHLY = IndicatorFamily(
    "silver_esios_installed_capacity_monthly",
    tuple(catalog.MONTHLY_CAPACITY_DATASETS.values()), catalog.CAPACITY_BY_MONTH)
FAMILIES = (ENERGY_HOURLY, POWER_5MIN, CAPACITY_MONTHLY)


def indicator_family(observations: DataFrame, family: IndicatorFamily) -> DataFrame:
    """Rows of the family's class, one per natural key.

    The class filter comes before the deduplication, so only the family's rows
    are shuffled; indicator ids never span two classes.
    """
    wanted = of_class(observations, F.col("magnitude_id"), F.col("time_id"), family.magnitude_and_time)
    return _unique(wanted, family.table, ("ingestion_timestamp", "values_updated_at"))


def all_observations(bronze: Bronze) -> DataFrame:
    """Observations of all 35 datasets, deduplicated once."""
    rows = indicator_observations(bronze.indicators(d for f in FAMILIES for d in f.datasets))
    return _unique(rows, ENERGY_HOURLY.table, ("ingestion_timestamp", "values_updated_at"))


# CNIG ----------------------------------------------------------------------------

# Source column -> stored column
_PROVINCE_NAMES = {
    "COD_PROV": "province_code",
    "PROVINCIA": "province_name",
    "COD_CA": "autonomous_community_code",
    "COMUNIDAD_AUTONOMA": "autonomous_community_name",
    "CAPITAL": "capital_name",
}
_MUNICIPALITY_NAMES = {
    "COD_INE": "municipality_ine_code",
    "ID_REL": "relation_id",
    "COD_GEO": "municipality_code",
    "COD_PROV": "province_code",
    "PROVINCIA": "province_name",
    "NOMBRE_ACTUAL": "municipality_name",
    "POBLACION_MUNI": "municipality_population",
    "SUPERFICIE": "surface_area",
    "PERIMETRO": "perimeter",
    "COD_INE_CAPITAL": "capital_ine_code",
    "CAPITAL": "capital_name",
    "POBLACION_CAPITAL": "capital_population",
    "HOJA_MTN25": "mtn25_sheet",
    "LONGITUD_ETRS89_REGCAN95": "longitude",
    "LATITUD_ETRS89_REGCAN95": "latitude",
    "ORIGENCOOR": "coordinate_origin",
    "ALTITUD": "altitude",
    "ORIGENALTITUD": "altitude_origin",
}
_WHOLE_NUMBERS = {"municipality_population", "perimeter", "capital_population"}
_DECIMAL_COMMAS = {"surface_area", "longitude", "latitude", "altitude"}


def _renamed(bronze: DataFrame, names: dict[str, str], what: str) -> DataFrame:
    require_fields(bronze, names, what)

    def typed(source: str, target: str) -> Column:
        column = F.col(source)
        if target in _WHOLE_NUMBERS:
            column = blank_to_null(column).try_cast("bigint")
        elif target in _DECIMAL_COMMAS:
            column = decimal_comma(column)
        return column.alias(target)

    return with_traceability(bronze, "cnig").select(
        *[typed(source, target) for source, target in names.items()], *_TRACE
    )


def provinces(bronze: DataFrame) -> DataFrame:
    return _unique(_renamed(bronze, _PROVINCE_NAMES, "CNIG provinces"), "silver_cnig_provinces")


def autonomous_communities(provinces_silver: DataFrame) -> DataFrame:
    """Community master derived from the province master."""
    columns = ("autonomous_community_code", "autonomous_community_name", *_TRACE)
    require_fields(provinces_silver, columns, "province master")
    return _unique(provinces_silver.select(*columns), "silver_cnig_autonomous_communities")


def municipalities(bronze: DataFrame) -> DataFrame:
    """Keyed by the INE code: several municipalities share a geographic code."""
    return _unique(
        _renamed(bronze, _MUNICIPALITY_NAMES, "CNIG municipalities"), "silver_cnig_municipalities")


# Composite builds ------------------------------------------------------------------


def _family_builder(family: IndicatorFamily):
    """Scans the family's own datasets only (14, 12 or 9 directories)."""
    return lambda bronze: indicator_family(
        indicator_observations(bronze.indicators(family.datasets)), family)


# table -> function of the Bronze root; nothing is listed or read for other tables
AEMET_BUILDERS = {
    "silver_aemet_stations": lambda bronze: stations(bronze.stations()),
    "silver_aemet_daily_climatology": lambda bronze: daily_climatology(bronze.daily_climatology()),
    "silver_aemet_current_observations":
        lambda bronze: current_observations(bronze.current_observations()),
}
OPEN_METEO_BUILDERS = {
    HOURLY.table: lambda bronze: weather_series(bronze.weather_hourly(), HOURLY),
    HISTORICAL_FORECAST.table:
        lambda bronze: weather_series(bronze.weather_historical_forecast(), HISTORICAL_FORECAST),
    QUARTER_HOURLY.table: lambda bronze: weather_series(bronze.weather_15min(), QUARTER_HOURLY),
}
CNIG_BUILDERS = {
    "silver_cnig_provinces": lambda bronze: provinces(bronze.provinces()),
    "silver_cnig_autonomous_communities":
        lambda bronze: autonomous_communities(provinces(bronze.provinces())),
    "silver_cnig_municipalities": lambda bronze: municipalities(bronze.municipalities()),
}
ESIOS_BUILDERS = {family.table: _family_builder(family) for family in FAMILIES}


def _build(builders, bronze: Bronze) -> dict[str, DataFrame]:
    return {name: build(bronze) for name, build in builders.items()}


def build_aemet(bronze: Bronze) -> dict[str, DataFrame]:
    return _build(AEMET_BUILDERS, bronze)


def build_open_meteo(bronze: Bronze) -> dict[str, DataFrame]:
    return _build(OPEN_METEO_BUILDERS, bronze)


def build_cnig(bronze: Bronze) -> dict[str, DataFrame]:
    return _build(CNIG_BUILDERS, bronze)


def build_esios(bronze: Bronze) -> dict[str, DataFrame]:
    return _build(ESIOS_BUILDERS, bronze)


def build_silver(bronze: Bronze, tables: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The named Silver frames (all by default), place-enriched where specified."""
    wanted = set(catalog.SILVER_TABLES if tables is None else tables)
    unknown = wanted - set(catalog.SILVER_TABLES)
    if unknown:
        raise ValueError(f"Unknown Silver tables: {sorted(unknown)}")
    builders = AEMET_BUILDERS | OPEN_METEO_BUILDERS | CNIG_BUILDERS | ESIOS_BUILDERS
    aliases = config.load("province_aliases")
    master = None
    built = {}
    for name, spec in catalog.SILVER_TABLES.items():
        if name not in wanted:
            continue
        frame = builders[name](bronze)
        if spec.place_column:
            # the master is a snapshot of its own: a load of some landing days needs all of it
            master = provinces(bronze.everything().provinces()) if master is None else master
            frame = resolve_place(frame, master, spec.place_column, aliases)
        built[name] = frame
    return built
