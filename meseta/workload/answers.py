"""Queries: the analytical questions on Gold facts derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from meseta.operators.analytics import EDGE_NOISE
from meseta.plans import questions
from meseta.workload import facts
from meseta.workload.insight import sql_pearson
from meseta.workload.registry import query, rounded, sql_r4


class _Facts(dict):
    """Gold frames by name, built on first use."""

    def __init__(self, t):
        super().__init__()
        self._builders = {
            questions.HOURLY: lambda: facts.province_hourly(t),
            questions.CAPACITY: lambda: facts.capacity_fact(t),
            questions.QUARTER: lambda: facts.country_15min(t),
        }

    def __missing__(self, name):
        self[name] = self._builders[name]()
        return self[name]


def _ask(t, name):
    return questions.answer(name, _Facts(t))


_HOURLY = f"WITH {facts.SQL_PROVINCE_HOURLY}"
_PAIRED = f"""WITH {facts.SQL_COUNTRY_15},
    paired AS (SELECT w.temperature, d.real_demand_energy_mwh_15min AS demand_mwh FROM quarter w
               JOIN quarter d USING (gold_timestamp)
               WHERE w.geography_level = 'COUNTRY' AND d.geography_level = 'PENINSULA')"""
_SCOPES = "'COUNTRY' AS temperature_scope, 'PENINSULA' AS demand_scope"


def _relation(x, y, source="fact"):
    return (f"count(*) FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL) AS n_pairs, "
            f"{sql_r4(sql_pearson(x, y))} AS correlation FROM {source}")


def _bins(x, y, width, source="fact"):
    return (f"floor({x} / {width}) * {width} AS bin_start, count({y}) AS n, {sql_r4(f'avg({y})')} AS mean "
            f"FROM {source} WHERE {x} IS NOT NULL GROUP BY ALL")


def _register_relation(name, question, x, y):
    @query(name, f"{_HOURLY} SELECT {_relation(x, y)}")
    def build(t):
        return rounded(_ask(t, question), "correlation")


_register_relation("cu01_wind_speed", "CU01", "wind_speed_80m", "wind_generation_mwh")
_register_relation("cu05_radiation", "CU05", "solar_radiation", "solar_photovoltaic_generation_mwh")
_register_relation("cu06_irradiance", "CU06", "direct_normal_irradiance", "solar_photovoltaic_generation_mwh")
_register_relation("cu10_precipitation", "CU10", "precipitation", "hydraulic_generation_mwh")


@query("cu02_wind_height", f"""{_HOURLY}
    SELECT '80m' AS height, {_relation('wind_speed_80m', 'wind_generation_mwh')} UNION ALL
    SELECT '120m', {_relation('wind_speed_120m', 'wind_generation_mwh')}""")
def cu02_wind_height(t):
    # the derived speeds are proportional, so the ranks would only compare noise
    return rounded(_ask(t, "CU02").drop("rank"), "correlation")


# a mean that is the edge of a range up to summation noise begins that range
@query("cu03_wind_ranges", f"""{_HOURLY},
    edged AS (SELECT wind_speed_80m + {EDGE_NOISE} AS wind_speed_80m, wind_generation_mwh FROM fact)
    SELECT {_bins('wind_speed_80m', 'wind_generation_mwh', 5.0, 'edged')}""")
def cu03_wind_ranges(t):
    return rounded(_ask(t, "CU03"), "mean")


@query("cu04_wind_direction", f"""{_HOURLY}
    SELECT CAST(floor((wind_direction_80m + 22.5) % 360.0 / 45) AS INTEGER) AS sector,
           count(wind_generation_mwh) AS n, {sql_r4('avg(wind_generation_mwh)')} AS mean
    FROM fact WHERE wind_direction_80m IS NOT NULL GROUP BY 1""")
def cu04_wind_direction(t):
    return rounded(_ask(t, "CU04"), "mean")


@query("cu07_radiation_levels", f"""{_HOURLY}
    SELECT {_bins('solar_radiation', 'solar_photovoltaic_generation_mwh', 100.0)}""")
def cu07_radiation_levels(t):
    return rounded(_ask(t, "CU07"), "mean")


@query("cu08_temperature_demand", f"{_PAIRED} SELECT {_SCOPES}, {_relation('temperature', 'demand_mwh', 'paired')}")
def cu08_temperature_demand(t):
    return rounded(_ask(t, "CU08"), "correlation")


@query("cu09_temperature_ranges", f"{_PAIRED} SELECT {_SCOPES}, {_bins('temperature', 'demand_mwh', 5.0, 'paired')}")
def cu09_temperature_ranges(t):
    return rounded(_ask(t, "CU09"), "mean")


@query("cu11_territories", f"""{_HOURLY},
    long AS (SELECT province_code, province_name, 'wind' AS relation, wind_speed_80m AS x, wind_generation_mwh AS y FROM fact
             UNION ALL SELECT province_code, province_name, 'solar_photovoltaic', solar_radiation, solar_photovoltaic_generation_mwh FROM fact
             UNION ALL SELECT province_code, province_name, 'hydraulic', precipitation, hydraulic_generation_mwh FROM fact)
    SELECT province_code, province_name, relation, {_relation('x', 'y', 'long')} GROUP BY ALL""")
def cu11_territories(t):
    return rounded(_ask(t, "CU11"), "correlation")


@query("cu12_generation_mix", f"""{_HOURLY}
    SELECT date_trunc('month', gold_timestamp) AS period, {sql_r4('sum(total_generation_mwh)')} AS total,
           {', '.join(f"{sql_r4(f'sum({name}) / nullif(sum(total_generation_mwh), 0)')} AS {name}_share"
                      for name in ('wind_generation_mwh', 'solar_photovoltaic_generation_mwh', 'hydraulic_generation_mwh'))}
    FROM fact GROUP BY 1""")
def cu12_generation_mix(t):
    shares = [f"{name}_generation_mwh_share" for name in ("wind", "solar_photovoltaic", "hydraulic")]
    return rounded(_ask(t, "CU12").select("period", "total", *shares), "total", *shares)


_SQL_EVOLUTION = f"""WITH {facts.SQL_CAPACITY},
    evolution AS (SELECT autonomous_community_code, autonomous_community_name, year_month, metric, value FROM (
        SELECT autonomous_community_code, autonomous_community_name, year_month, hydraulic_installed_capacity_mw,
               wind_installed_capacity_mw, renewable_total_installed_capacity_mw FROM capacity)
        UNPIVOT (value FOR metric IN (hydraulic_installed_capacity_mw, wind_installed_capacity_mw,
                                      renewable_total_installed_capacity_mw)))"""


@query("cu13_capacity_evolution", f"{_SQL_EVOLUTION} SELECT * FROM evolution")
def cu13_capacity_evolution(t):
    return _ask(t, "CU13")


@query("cu14_capacity_concentration", f"""{_SQL_EVOLUTION}
    SELECT *, CAST(row_number() OVER (PARTITION BY metric, year_month
                   ORDER BY value DESC, autonomous_community_code) AS INTEGER) AS rank
    FROM evolution QUALIFY rank <= 3""")
def cu14_capacity_concentration(t):
    return _ask(t, "CU14")


@query("cu15_capacity_generation", f"""
    WITH {facts.SQL_PROVINCE_HOURLY.strip()}, {facts.SQL_CAPACITY.strip()},
    recent AS (SELECT autonomous_community_code, strftime(CAST(year_month || '-01' AS TIMESTAMP) + INTERVAL 29 YEAR, '%Y-%m') AS year_month,
                      hydraulic_installed_capacity_mw, wind_installed_capacity_mw FROM capacity),
    generated AS (SELECT autonomous_community_code,
            strftime(gold_timestamp + INTERVAL 1 HOUR, '%Y-%m') AS year_month,
            sum(hydraulic_generation_mwh) AS hydraulic, sum(wind_generation_mwh) AS wind FROM fact GROUP BY ALL),
    sides AS (
        SELECT autonomous_community_code, year_month, 'hydraulic' AS technology,
               hydraulic_installed_capacity_mw AS capacity_mw, hydraulic AS energy_mwh
        FROM recent JOIN generated USING (autonomous_community_code, year_month)
        UNION ALL
        SELECT autonomous_community_code, year_month, 'wind', wind_installed_capacity_mw, wind
        FROM recent JOIN generated USING (autonomous_community_code, year_month))
    SELECT autonomous_community_code, year_month, technology, capacity_mw, {sql_r4('energy_mwh')} AS energy_mwh,
           {sql_r4('energy_mwh / nullif(capacity_mw, 0)')} AS mwh_per_mw
    FROM sides WHERE capacity_mw IS NOT NULL AND energy_mwh IS NOT NULL""")
def cu15_capacity_generation(t):
    """Orders end before the events begin; their months are moved 29 years ahead to meet."""
    built = _Facts(t)
    month = F.to_timestamp("year_month", "yyyy-MM") + F.make_ym_interval(F.lit(29))
    built[questions.CAPACITY] = built[questions.CAPACITY].withColumn(
        "year_month", F.date_format(month, "yyyy-MM"))
    return rounded(questions.answer("CU15", built), "energy_mwh", "mwh_per_mw")
