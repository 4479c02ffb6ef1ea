"""Silver -> Gold: four facts at fixed grains and two dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meseta import catalog, config
from meseta.functions import (
    calendar_parts,
    civil_month,
    fallback,
    floor_grain,
    power_to_energy,
    shift_hours,
    surrogate_key,
)
from meseta.operators.aggregate import energy_rollup, pivot_metrics, staged_mean
from meseta.operators.clean import latest_by_key
from meseta.operators.geo import PROVINCE_COLUMNS, attach_station_place, canonical_key
from meseta.operators.joins import lookup, merge_on_grain

_PROVINCE_HOUR = ("province_code", "gold_timestamp")
_SCOPE_TIME = ("geography_key", "gold_timestamp")

SPAIN_KEY = "COUNTRY|ES"
PENINSULA_KEY = "PENINSULA|PENINSULA"


def _created(df: DataFrame, created_at: dt.datetime) -> DataFrame:
    """The load instant is a parameter, so that a rerun gives equal rows."""
    return df.withColumn("gold_created_at", F.lit(created_at).cast("timestamp"))


def _located(df: DataFrame) -> DataFrame:
    return df.filter(F.col("province_code").isNotNull() & F.col("observation_timestamp").isNotNull())


def _hour(df: DataFrame, hours: int = 0) -> DataFrame:
    ts = shift_hours(F.col("observation_timestamp"), hours)
    return df.withColumn("gold_timestamp", floor_grain(ts, "HOUR"))


def weather_by_province_hour(
    current: DataFrame, stations: DataFrame, hourly: DataFrame, quarter_hourly: DataFrame
) -> dict[str, DataFrame]:
    """The weather inputs of the province fact, each already on its grain."""
    # sums and counts of a station's hour first: the place join then sees one row of each,
    # however many observations a station has, and the mean is still that of all of them
    measured = ("ta", "hr", "prec")
    timed = _hour(current.filter(F.col("observation_timestamp").isNotNull()))
    hours = timed.groupBy("station_id", "gold_timestamp").agg(*[
        F.struct(F.sum(F.col(name).cast("double")).alias("sum"), F.count(name).alias("n")).alias(name)
        for name in measured])
    placed = attach_station_place(hours, stations, ("province_code",)).filter(F.col("province_code").isNotNull())
    aemet = placed.groupBy(*_PROVINCE_HOUR).agg(*[
        (F.sum(F.col(name)["sum"]) / F.sum(F.col(name)["n"])).alias(name) for name in measured])
    points = staged_mean(
        _hour(_located(hourly)), [_PROVINCE_HOUR],
        ["temperature_2m", "relative_humidity_2m", "precipitation", "shortwave_radiation",
         "direct_normal_irradiance"],
    )
    wind = staged_mean(
        _hour(_located(quarter_hourly)),
        [("station_id", *_PROVINCE_HOUR), _PROVINCE_HOUR],
        ["wind_speed_80m", "wind_speed_120m"],
        ["wind_direction_80m", "wind_direction_120m"],
    )
    return {"aemet": aemet, "open_meteo": points, "wind": wind}


def fact_province_hourly(
    current: DataFrame,
    stations: DataFrame,
    hourly: DataFrame,
    quarter_hourly: DataFrame,
    energy: DataFrame,
    provinces: DataFrame,
    *,
    created_at: dt.datetime,
    alignment: Mapping[str, int] | None = None,
) -> DataFrame:
    """Weather and generation per province and hour."""
    shift = (alignment or config.load("time_alignment"))["hourly"]
    frames = weather_by_province_hour(current, stations, hourly, quarter_hourly)
    frames["energy"] = pivot_metrics(
        _hour(_located(energy), shift), _PROVINCE_HOUR, "indicator_id", "value",
        catalog.HOURLY_METRICS, strict=True,
    )
    merged = merge_on_grain(frames, _PROVINCE_HOUR)

    selected: list[Column] = []
    sources: list[Column] = []
    for metric, station_value, point_value in (
        ("temperature", "ta", "temperature_2m"),
        ("humidity", "hr", "relative_humidity_2m"),
        ("precipitation", "prec", "precipitation"),
    ):
        value, source = fallback(
            [("AEMET", F.col(station_value)), ("OPEN_METEO", F.col(point_value))])
        selected.append(value.alias(metric))
        sources.append(source.alias(f"{metric}_source"))

    master = latest_by_key(provinces.select(*PROVINCE_COLUMNS), ["province_code"])
    named = lookup(merged, master, ["province_code"])
    fact = named.select(
        "gold_timestamp",
        surrogate_key(F.lit("PROVINCE"), F.col("province_code")).alias("geography_key"),
        *PROVINCE_COLUMNS,
        *selected,
        "wind_speed_80m", "wind_direction_80m", "wind_speed_120m", "wind_direction_120m",
        F.col("shortwave_radiation").alias("solar_radiation"), "direct_normal_irradiance",
        *catalog.HOURLY_METRICS.values(),
        *sources,
    )
    return _created(fact, created_at)


def fact_installed_capacity_monthly(
    capacity: DataFrame, communities: DataFrame, *, created_at: dt.datetime
) -> DataFrame:
    """Installed capacity in MW per autonomous community and month; never shifted or summed."""
    months = capacity.withColumn("year_month", civil_month(F.col("observation_timestamp")))
    keys = ["esios_geo_id", "esios_geo_name", "year_month"]
    wide = pivot_metrics(
        months, [*keys, "observation_timestamp"], "indicator_id", "value",
        catalog.CAPACITY_METRICS, strict=True,
    )
    columns = ["autonomous_community_code", "autonomous_community_name"]
    master = latest_by_key(communities.select(*columns), columns[:1])
    keyed_master = master.withColumn("_place", canonical_key(F.col(columns[1]), {}))
    aliases = config.load("community_aliases")
    named = wide.withColumn("_place", canonical_key(F.col("esios_geo_name"), aliases))
    placed = lookup(named, keyed_master, ["_place"])
    fact = placed.select(
        "year_month",
        F.to_timestamp("year_month", "yyyy-MM").alias("gold_month_timestamp"),
        F.col("observation_timestamp").alias("source_timestamp"),
        surrogate_key(F.lit("AUTONOMOUS_COMMUNITY"), F.col(columns[0])).alias("geography_key"),
        *columns, "esios_geo_id",
        *catalog.CAPACITY_METRICS.values(),
    )
    return _created(fact, created_at)


def national_scope() -> dict[str, Column]:
    """Key, level and name of the scope an ESIOS geography id stands for.

    Only the two published ids map; any other id keeps NULL and is reported by
    the level check instead of being converted.
    """
    geo = F.col("esios_geo_id")

    def pick(spain: str, peninsula: str) -> Column:
        return F.when(geo == catalog.SPAIN_GEO_ID, spain).when(
            geo == catalog.PENINSULA_GEO_ID, peninsula)

    return {
        "geography_key": pick(SPAIN_KEY, PENINSULA_KEY),
        "geography_level": pick("COUNTRY", "PENINSULA"),
        "geography_name": pick("Spain", "Peninsula"),
    }


def power_metric(stem: str) -> str:
    return f"{stem}_mw" if stem == catalog.NATIONAL_SERIES[catalog.DEMAND_INDICATOR] else f"{stem}_power_mw"


def fact_country_5min(
    power: DataFrame, *, created_at: dt.datetime, alignment: Mapping[str, int] | None = None
) -> DataFrame:
    """Power and interval energy per national scope and five minutes."""
    shift = (alignment or config.load("time_alignment"))["five_minute"]
    ts = floor_grain(shift_hours(F.col("observation_timestamp"), shift), "FIVE_MINUTES")
    names = {key: power_metric(stem) for key, stem in catalog.NATIONAL_SERIES.items()}
    wide = pivot_metrics(
        power.withColumn("gold_timestamp", ts), ["gold_timestamp", "esios_geo_id"],
        "indicator_id", "value", names, strict=True,
    )
    fact = wide.select(
        "gold_timestamp",
        *[column.alias(name) for name, column in national_scope().items()],
        "esios_geo_id",
        *names.values(),
        *[
            power_to_energy(F.col(names[key]), 5).alias(f"{stem}_energy_mwh_5min")
            for key, stem in catalog.NATIONAL_SERIES.items()
        ],
    )
    return _created(fact, created_at)


_NATIONAL_WEATHER = {
    "temperature": "temperature_2m",
    "humidity": "relative_humidity_2m",
    "precipitation": "precipitation",
    "wind_speed_80m": "wind_speed_80m",
    "wind_speed_120m": "wind_speed_120m",
    "solar_radiation": "shortwave_radiation",
    "direct_normal_irradiance": "direct_normal_irradiance",
}
_NATIONAL_DIRECTIONS = ("wind_direction_80m", "wind_direction_120m")


def fact_country_15min(
    quarter_hourly: DataFrame, power: DataFrame, *, created_at: dt.datetime,
    alignment: Mapping[str, int] | None = None,
) -> DataFrame:
    """National weather and energy per 15 minutes; the scopes stay separate rows."""
    shift = (alignment or config.load("time_alignment"))["five_minute"]
    points = _located(quarter_hourly).select(
        "province_code",
        floor_grain(F.col("observation_timestamp"), "FIFTEEN_MINUTES").alias("gold_timestamp"),
        *[F.col(source).alias(name) for name, source in _NATIONAL_WEATHER.items()],
        *_NATIONAL_DIRECTIONS,
    )
    weather = staged_mean(
        points, [("province_code", "gold_timestamp"), ("gold_timestamp",)],
        list(_NATIONAL_WEATHER), list(_NATIONAL_DIRECTIONS),
    ).withColumn("geography_key", F.lit(SPAIN_KEY))

    indicators = F.col("indicator_id").isin(*catalog.NATIONAL_SERIES)
    scoped = power.filter(indicators).select(
        F.coalesce(
            national_scope()["geography_key"], surrogate_key(F.lit("UNKNOWN"), F.col("esios_geo_id").cast("string")),
        ).alias("geography_key"),
        "indicator_id", "value", shift_hours(F.col("observation_timestamp"), shift).alias("_ts"),
    )
    energy = energy_rollup(scoped, ["geography_key"], "_ts", {
        f"{stem}_energy_mwh_15min": F.when(F.col("indicator_id") == key, F.col("value"))
        for key, stem in catalog.NATIONAL_SERIES.items()
    })

    merged = merge_on_grain({"weather": weather, "energy": energy}, _SCOPE_TIME)
    # an id that is neither scope keeps its rows without a level, for the level check to report
    spain, peninsula = F.col("geography_key") == SPAIN_KEY, F.col("geography_key") == PENINSULA_KEY
    fact = merged.select(
        "gold_timestamp", "geography_key",
        F.when(spain, "COUNTRY").when(peninsula, "PENINSULA").alias("geography_level"),
        F.when(spain, "Spain").when(peninsula, "Peninsula").alias("geography_name"),
        "temperature", "humidity", "precipitation",
        "wind_speed_80m", "wind_direction_80m", "wind_speed_120m", "wind_direction_120m",
        "solar_radiation", "direct_normal_irradiance",
        *[f"{stem}_energy_mwh_15min" for stem in catalog.NATIONAL_SERIES.values()],
    )
    return _created(fact, created_at)


# Dimensions ------------------------------------------------------------------------


def time_members(instants: DataFrame, grain: str, ts: str = "gold_timestamp") -> DataFrame:
    """Distinct members of one sub-monthly grain."""
    at = F.col(ts)
    key = surrogate_key(F.lit(grain), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"))
    distinct = instants.filter(at.isNotNull()).select(ts).distinct()
    return distinct.select(
        key.alias("time_key"), F.lit(grain).alias("time_grain"), at.alias("gold_timestamp"),
        *[column.alias(name) for name, column in calendar_parts(at).items()],
    )


def month_members(months: DataFrame, label: str = "year_month") -> DataFrame:
    """Distinct months; no instant, day or hour is made up for them."""
    distinct = months.filter(F.col(label).isNotNull()).select(label).distinct()
    nothing = F.lit(None)
    return distinct.select(
        surrogate_key(F.lit("MONTH"), F.col(label)).alias("time_key"),
        F.lit("MONTH").alias("time_grain"),
        nothing.cast("timestamp").alias("gold_timestamp"),
        nothing.cast("date").alias("date"),
        F.substring(label, 1, 4).cast("int").alias("year"),
        F.substring(label, 6, 2).cast("int").alias("month"),
        F.col(label).alias("year_month"),
        *[nothing.cast("int").alias(name) for name in ("day", "day_of_week", "hour", "minute")],
    )


def dim_time(
    by_grain: Mapping[str, DataFrame], *, created_at: dt.datetime
) -> DataFrame:
    """Members needed by the facts; ``by_grain`` maps a grain to the facts that use it."""
    parts = [
        month_members(frame) if grain == "MONTH" else time_members(frame, grain)
        for grain, frame in by_grain.items()
    ]
    return _created(reduce(DataFrame.unionByName, parts), created_at)


def dim_geography(
    provinces: DataFrame, communities: DataFrame, *, created_at: dt.datetime,
    esios_ids: DataFrame | None = None,
) -> DataFrame:
    """Provinces, communities, Spain and the Peninsula.

    ``esios_ids`` (geography_key, esios_geo_id) supplies the ids seen in the
    data; members without one keep NULL.
    """
    spark: SparkSession = provinces.sparkSession
    text, nothing = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    country = {"country_code": F.lit("ES"), "country_name": F.lit("Spain")}

    def member(df: DataFrame, level: str, code: Column, name: Column, **given: Column) -> DataFrame:
        columns = dict.fromkeys([*PROVINCE_COLUMNS, "country_code", "country_name"], text)
        columns["esios_geo_id"] = nothing
        columns.update(given)
        return df.select(
            surrogate_key(F.lit(level), code).alias("geography_key"),
            F.lit(level).alias("geography_level"), code.alias("geography_code"),
            name.alias("geography_name"),
            *[column.alias(key) for key, column in columns.items()],
        )

    province_rows = member(
        provinces, "PROVINCE", F.col("province_code"), F.col("province_name"),
        **{name: F.col(name) for name in PROVINCE_COLUMNS}, **country,
    )
    community_rows = member(
        communities, "AUTONOMOUS_COMMUNITY", F.col("autonomous_community_code"),
        F.col("autonomous_community_name"),
        **{name: F.col(name) for name in PROVINCE_COLUMNS[2:]}, **country,
    )
    one = spark.range(1)
    spain = member(one, "COUNTRY", F.lit("ES"), F.lit("Spain"), **country,
                   esios_geo_id=F.lit(catalog.SPAIN_GEO_ID).cast("bigint"))
    peninsula = member(one, "PENINSULA", F.lit("PENINSULA"), F.lit("Peninsula"),
                       esios_geo_id=F.lit(catalog.PENINSULA_GEO_ID).cast("bigint"))
    members = reduce(DataFrame.unionByName, [province_rows, community_rows, spain, peninsula])
    if esios_ids is not None:
        ids = esios_ids.select("geography_key", F.col("esios_geo_id").alias("_seen")).distinct()
        members = lookup(members, ids, ["geography_key"]).withColumn(
            "esios_geo_id", F.coalesce("esios_geo_id", "_seen")).drop("_seen")
    return _created(members, created_at)
