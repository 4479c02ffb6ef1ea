"""The fifteen analytical questions, answered from the Gold facts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meseta import catalog
from meseta.functions import civil_month
from meseta.operators import analytics

HOURLY = "gold_fact_province_hourly"
CAPACITY = "gold_fact_installed_capacity_monthly"
QUARTER = "gold_fact_country_15min"

Facts = Mapping[str, DataFrame]

# shares are taken of the official total, so the total itself is no part
TECHNOLOGIES = tuple(name for name in catalog.HOURLY_METRICS.values() if name != "total_generation_mwh")

# technology -> (capacity metric, generation metric) where both are published
CAPACITY_AND_GENERATION = {
    "hydraulic": ("hydraulic_installed_capacity_mw", "hydraulic_generation_mwh"),
    "wind": ("wind_installed_capacity_mw", "wind_generation_mwh"),
    "solar_photovoltaic": ("solar_photovoltaic_installed_capacity_mw", "solar_photovoltaic_generation_mwh"),
    "solar_thermal": ("solar_thermal_installed_capacity_mw", "solar_thermal_generation_mwh"),
    "nuclear": ("nuclear_installed_capacity_mw", "nuclear_generation_mwh"),
    "coal": ("coal_installed_capacity_mw", "coal_generation_mwh"),
    "combined_cycle": ("combined_cycle_installed_capacity_mw", "combined_cycle_generation_mwh"),
    "other_renewables": ("other_renewables_installed_capacity_mw", "other_renewables_generation_mwh"),
}


def _labelled(df: DataFrame, **labels: str) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in labels.items()})


def _relation(x: str, y: str) -> Callable[[Facts], DataFrame]:
    return lambda facts: analytics.correlate(facts[HOURLY], x, y)


def wind_height(facts: Facts) -> DataFrame:
    """Both heights side by side; the stronger one has rank 1."""
    heights = ("80m", "120m")
    # one pass: both heights of a row in one long frame
    long = facts[HOURLY].select("wind_generation_mwh", F.inline(F.array(*[
        F.struct(F.lit(h).alias("height"), F.col(f"wind_speed_{h}").alias("speed")) for h in heights])))
    stacked = _labelled(analytics.correlate(long, "speed", "wind_generation_mwh", ["height"]), all="all").withColumn(
        "strength", F.abs("correlation"))
    return analytics.top_k(stacked, ["all"], "strength", len(heights), ["height"]).drop("all", "strength")


def temperature_and_demand(facts: Facts) -> DataFrame:
    """Temperature of Spain next to the demand of the Peninsula, per instant.

    The fact keeps the two scopes in separate rows. This pairing crosses scopes
    on purpose and says so in its columns; it converts neither value.
    """
    fact = facts[QUARTER]
    country, peninsula = F.col("geography_level") == "COUNTRY", F.col("geography_level") == "PENINSULA"
    # one row per scope and instant, so a conditional maximum is that row's value
    paired = fact.groupBy("gold_timestamp").agg(
        F.max(F.when(country, F.col("temperature"))).alias("temperature"),
        F.max(F.when(peninsula, F.col("real_demand_energy_mwh_15min"))).alias("demand_mwh"),
        F.count_if(country).alias("_countries"), F.count_if(peninsula).alias("_peninsulas"),
    ).filter("_countries > 0 AND _peninsulas > 0").drop("_countries", "_peninsulas")
    return _labelled(paired, temperature_scope="COUNTRY", demand_scope="PENINSULA")


def by_territory(facts: Facts) -> DataFrame:
    """The weather-generation relations of each province."""
    pairs = {
        "wind": ("wind_speed_80m", "wind_generation_mwh"),
        "solar_photovoltaic": ("solar_radiation", "solar_photovoltaic_generation_mwh"),
        "hydraulic": ("precipitation", "hydraulic_generation_mwh"),
    }
    keys = ["province_code", "province_name"]
    # one pass: all pairs of all provinces in one long frame
    long = facts[HOURLY].select(*keys, F.inline(F.array(*[
        F.struct(F.lit(name).alias("relation"), F.col(x).alias("x"), F.col(y).alias("y"))
        for name, (x, y) in pairs.items()])))
    return analytics.correlate(long, "x", "y", [*keys, "relation"])


def generation_mix(facts: Facts) -> DataFrame:
    months = facts[HOURLY].withColumn("period", F.date_trunc("month", "gold_timestamp"))
    return analytics.mix_share(months, TECHNOLOGIES, "total_generation_mwh", ["period"])


def capacity_evolution(facts: Facts) -> DataFrame:
    keys = ["autonomous_community_code", "autonomous_community_name", "year_month"]
    return analytics.unpivot_series(facts[CAPACITY], keys, list(catalog.CAPACITY_METRICS.values()))


def capacity_concentration(facts: Facts, k: int = 3) -> DataFrame:
    """The communities with the most capacity, per technology and month."""
    return analytics.top_k(
        capacity_evolution(facts), ["metric", "year_month"], "value", k, ["autonomous_community_code"])


def capacity_and_generation(facts: Facts) -> DataFrame:
    """Capacity and summed generation per community, month and technology."""
    keys = ["autonomous_community_code", "year_month"]
    months = facts[HOURLY].withColumn("year_month", civil_month(F.col("gold_timestamp")))
    # sum the wide rows first: one row per community and month before turning long
    generated = months.groupBy(*keys).agg(*[F.sum(e).alias(e) for _, e in CAPACITY_AND_GENERATION.values()])

    def long(df: DataFrame, side: int, value: str) -> DataFrame:
        return df.select(*keys, F.inline(F.array(*[
            F.struct(F.lit(name).alias("technology"), F.col(metrics[side]).alias(value))
            for name, metrics in CAPACITY_AND_GENERATION.items()])))

    return analytics.capacity_and_generation(
        long(facts[CAPACITY], 0, "capacity_mw").filter("capacity_mw IS NOT NULL"),
        long(generated, 1, "energy_mwh").filter("energy_mwh IS NOT NULL"),
        [*keys, "technology"], "capacity_mw", "energy_mwh")


QUESTIONS: dict[str, Callable[[Facts], DataFrame]] = {
    "CU01": _relation("wind_speed_80m", "wind_generation_mwh"),
    "CU02": wind_height,
    "CU03": lambda facts: analytics.mean_by_bin(facts[HOURLY], "wind_speed_80m", "wind_generation_mwh", 5.0),
    "CU04": lambda facts: analytics.mean_by_sector(facts[HOURLY], "wind_direction_80m", "wind_generation_mwh"),
    "CU05": _relation("solar_radiation", "solar_photovoltaic_generation_mwh"),
    "CU06": _relation("direct_normal_irradiance", "solar_photovoltaic_generation_mwh"),
    "CU07": lambda facts: analytics.mean_by_bin(
        facts[HOURLY], "solar_radiation", "solar_photovoltaic_generation_mwh", 100.0),
    "CU08": lambda facts: _labelled(
        analytics.correlate(temperature_and_demand(facts), "temperature", "demand_mwh"),
        temperature_scope="COUNTRY", demand_scope="PENINSULA"),
    "CU09": lambda facts: _labelled(
        analytics.mean_by_bin(temperature_and_demand(facts), "temperature", "demand_mwh", 5.0),
        temperature_scope="COUNTRY", demand_scope="PENINSULA"),
    "CU10": _relation("precipitation", "hydraulic_generation_mwh"),
    "CU11": by_territory,
    "CU12": generation_mix,
    "CU13": capacity_evolution,
    "CU14": capacity_concentration,
    "CU15": capacity_and_generation,
}


def answer(question: str, facts: Facts) -> DataFrame:
    if question not in QUESTIONS:
        raise ValueError(f"Unknown question {question}; known: {sorted(QUESTIONS)}")
    return QUESTIONS[question](facts)
