"""Queries: place resolution, staged means, pivots, energy, facts and dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from meseta import catalog
from meseta.functions import calendar_parts, fallback, floor_grain, shift_hours, surrogate_key
from meseta.operators import aggregate, geo, joins, quality
from meseta.plans import gold, silver
from meseta.workload.cleaning import provinces_csv
from meseta.workload.derived import (
    direction,
    SQL_LOCATED,
    located,
    metric,
    province_master,
    stations,
)
from meseta.workload.registry import (
    angle4,
    query,
    rounded,
    sql_angle4,
    sql_circular,
    sql_r4,
)

_CREATED = dt.datetime(2024, 3, 1)

# Places ------------------------------------------------------------------------------

_ALIASES = {"Tercera": "NATION_3", "Séptima": "NATION_7", "Undécima": "Nation_11",
            "STA. QUINTA": "NATION_5", "VIGÉSIMA": "Nation_20"}
_SQL_SPELLED = """CASE WHEN c_custkey % 2 = 0 AND c_nationkey = 3 THEN ' tercera '
    WHEN c_custkey % 2 = 0 AND c_nationkey = 7 THEN 'Septima'
    WHEN c_custkey % 2 = 0 AND c_nationkey = 20 THEN 'vigésima'
    ELSE concat('nation_', c_nationkey) END"""


def spelled_customers(t):
    """Customers with the nation's name in several spellings."""
    return t.customer.select("c_custkey", F.expr(_SQL_SPELLED).alias("spelled"))


@query("alias_lookup", """
    SELECT concat('NATION_', c_nationkey) AS place, count(*) AS n FROM customer GROUP BY 1""")
def alias_lookup(t):
    place = geo.canonical_key(F.col("spelled"), _ALIASES)
    return spelled_customers(t).groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("n"))


@query("geo_enrich", f"""
    SELECT c_custkey, {_SQL_SPELLED} AS spelled, CAST(n_nationkey AS VARCHAR) AS province_code,
           n_name AS province_name, CAST(r_regionkey AS VARCHAR) AS autonomous_community_code,
           r_name AS autonomous_community_name
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey""")
def geo_enrich(t):
    return geo.resolve_place(spelled_customers(t), province_master(t), "spelled", _ALIASES)


@query("geo_unmatched", f"""
    SELECT {_SQL_SPELLED} AS spelled, count(*) AS n FROM customer
    WHERE c_nationkey IN (2, 3, 5) GROUP BY 1""")
def geo_unmatched(t):
    reduced = province_master(t).filter(~F.col("province_code").isin("2", "3", "5"))
    enriched = geo.resolve_place(spelled_customers(t), reduced, "spelled", _ALIASES)
    return geo.unmatched(enriched).groupBy("spelled").agg(F.count(F.lit(1)).alias("n"))


@query("station_to_province", f"""
    WITH {SQL_LOCATED}
    SELECT province_name, count(*) AS n, max(value) AS highest, min(ts) AS first_ts
    FROM located GROUP BY province_name""")
def station_to_province(t):
    rows = t.events.select(F.col("user_id").cast("string").alias("station_id"), "ts", "value")
    placed = geo.attach_station_place(rows, stations(t)).filter(F.col("province_code").isNotNull())
    return placed.groupBy("province_name").agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("highest"), F.min("ts").alias("first_ts"))


@query("functional_dependency", """
    SELECT 'n_nationkey_to_n_name' AS "check", 'customer' AS "table", 'ERROR' AS severity,
           count(*) AS n_total, count(*) FILTER (WHERE k > 1) AS n_bad
    FROM (SELECT n_nationkey, count(DISTINCT n_name) AS k FROM customer
          JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
    UNION ALL
    SELECT 'o_orderstatus_to_o_orderpriority', 'orders', 'ERROR', count(*),
           count(*) FILTER (WHERE k > 1)
    FROM (SELECT o_orderstatus, count(DISTINCT o_orderpriority) AS k FROM orders GROUP BY 1)""")
def functional_dependency(t):
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return quality.functional_dependency(named, "n_nationkey", "n_name", "customer").unionByName(
        quality.functional_dependency(t.orders, "o_orderstatus", "o_orderpriority", "orders"))


# Means -------------------------------------------------------------------------------


def _hourly_located(t):
    return located(t, t.events.select("user_id", "event_type", "value", "ts")).withColumn(
        "hour", floor_grain(F.col("ts"), "HOUR"))


@query("avg_spatial_hour", f"""
    WITH {SQL_LOCATED}
    SELECT province_name, date_trunc('hour', ts) AS hour, {sql_r4('avg(value)')} AS value
    FROM located GROUP BY ALL""")
def avg_spatial_hour(t):
    return rounded(aggregate.staged_mean(_hourly_located(t), [["province_name", "hour"]], ["value"]), "value")


_SQL_USER_HOUR = f"""
    WITH {SQL_LOCATED},
    points AS (SELECT user_id, province_name, autonomous_community_name, date_trunc('hour', ts) AS hour,
                      avg(value) AS value, {sql_circular('(value * 7) % 360')} AS direction
               FROM located GROUP BY ALL),
    provinces AS (SELECT province_name, autonomous_community_name, hour, avg(value) AS value,
                         {sql_circular('direction')} AS direction
                  FROM points GROUP BY ALL)"""
_STAGES = [
    ["province_name", "autonomous_community_name", "hour"],
    ["autonomous_community_name", "hour"],
]


def _located_user_hours(t, scalars, directions):
    """Means per user and hour, then their place.

    The user settles the place, so the first stage needs none: it combines before its
    shuffle, and the join sees one row per user and hour however hot a user is.
    """
    rows = t.events.select("user_id", "value", direction().alias("direction"),
                           floor_grain(F.col("ts"), "HOUR").alias("hour"))
    return located(t, aggregate.staged_mean(rows, [["user_id", "hour"]], scalars, directions))


@query("avg_two_stage", f"""{_SQL_USER_HOUR}
    SELECT autonomous_community_name, hour, {sql_r4('avg(value)')} AS value
    FROM provinces GROUP BY ALL""")
def avg_two_stage(t):
    return rounded(aggregate.staged_mean(_located_user_hours(t, ["value"], []), _STAGES, ["value"]), "value")


@query("circular_mean", f"""{_SQL_USER_HOUR}
    SELECT autonomous_community_name, hour, {sql_angle4(sql_circular('direction'))} AS direction
    FROM provinces GROUP BY ALL""")
def circular_mean(t):
    rows = _located_user_hours(t, [], ["direction"])
    return aggregate.staged_mean(rows, _STAGES, [], ["direction"]).withColumn(
        "direction", angle4(F.col("direction")))


# Pivots and energy ---------------------------------------------------------------------

EVENT_METRICS = {"click": "clicks", "view": "views", "purchase": "purchases", "signup": "signups",
                 "error": "errors"}
_SQL_PIVOT = ", ".join(
    f"max(CASE WHEN event_type = '{kind}' THEN value END) AS {name}" for kind, name in EVENT_METRICS.items())


@query("pivot_metrics", f"""
    WITH {SQL_LOCATED}
    SELECT province_name, date_trunc('hour', ts) AS hour, {_SQL_PIVOT} FROM located GROUP BY ALL""")
def pivot_metrics(t):
    return aggregate.pivot_metrics(
        _hourly_located(t), ["province_name", "hour"], "event_type", "value", EVENT_METRICS)


@query("energy_15min", f"""
    WITH steps AS (SELECT event_type, time_bucket(INTERVAL '5 minutes', ts) AS step,
                          max(CASE WHEN event_type = 'signup' THEN -value ELSE value END) AS mw
                   FROM events WHERE event_type <> 'error' GROUP BY ALL)
    SELECT event_type, time_bucket(INTERVAL '15 minutes', step) AS slot,
           CASE WHEN count(mw) = 3 THEN {sql_r4('sum(mw / 12)')} END AS energy
    FROM steps GROUP BY ALL""")
def energy_15min(t):
    names = F.create_map(*[F.lit(x) for kind, key in _POWER_IDS.items() for x in (key, kind)])
    power = silver_power(t).withColumn("event_type", names[F.col("indicator_id")]).filter(
        F.col("event_type") != "error")
    rolled = aggregate.energy_rollup(
        power, ["event_type"], "observation_timestamp", {"energy": F.col("value")}, out="slot")
    return rounded(rolled, "energy")


@query("energy_period", """
    SELECT l_returnflag, date_trunc('month', l_shipdate) AS period, sum(l_quantity) AS l_quantity
    FROM lineitem GROUP BY ALL""")
def energy_period(t):
    return aggregate.period_sum(t.lineitem, ["l_returnflag"], "l_shipdate", ["l_quantity"])


@query("fallback_metric", f"""
    WITH {SQL_LOCATED}, wide AS (
        SELECT province_name, date_trunc('hour', ts) AS hour, {_SQL_PIVOT} FROM located GROUP BY ALL)
    SELECT province_name, hour, coalesce(clicks, views) AS value,
           CASE WHEN clicks IS NOT NULL THEN 'AEMET' WHEN views IS NOT NULL THEN 'OPEN_METEO' END AS source
    FROM wide""")
def fallback_metric(t):
    wide = pivot_metrics(t)
    value, source = fallback([("AEMET", F.col("clicks")), ("OPEN_METEO", F.col("views"))])
    return wide.select("province_name", "hour", value.alias("value"), source.alias("source"))


@query("time_shift", """
    SELECT date_trunc('hour', ts + INTERVAL 1 HOUR) AS hour, count(*) AS n, max(value) AS highest
    FROM events GROUP BY 1""")
def time_shift(t):
    hour = floor_grain(shift_hours(F.col("ts"), 1), "HOUR")
    return t.events.groupBy(hour.alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("highest"))


@query("fact_join", f"""
    WITH {SQL_LOCATED},
    a AS (SELECT province_name, date_trunc('month', ts) AS month, avg(value) AS events FROM located GROUP BY ALL),
    b AS (SELECT n_name AS province_name, date_trunc('month', o_orderdate) AS month, max(o_totalprice) AS orders
          FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
    c AS (SELECT n_name AS province_name, date_trunc('month', l_shipdate) AS month, sum(l_quantity) AS shipped
          FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)
    SELECT province_name, month, {sql_r4('events')} AS events, orders, shipped
    FROM a FULL JOIN b USING (province_name, month) FULL JOIN c USING (province_name, month)""")
def fact_join(t):
    """Three sources at the grain nation x month, each aggregated from its own table."""
    keys = ["province_name", "month"]
    month = lambda ts: F.date_trunc("month", ts).alias("month")
    nations = t.nation.select("n_nationkey", F.col("n_name").alias("province_name"))
    events = located(t, t.events.select("user_id", "ts", "value")).groupBy("province_name", month("ts")).agg(
        F.avg("value").alias("events"))
    # aggregated by the customer or supplier before the nation is looked up
    orders = t.orders.groupBy("o_custkey", month("o_orderdate")).agg(F.max("o_totalprice").alias("orders")).join(
        t.customer, F.col("o_custkey") == F.col("c_custkey")
    ).join(nations, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(*keys).agg(
        F.max("orders").alias("orders"))
    shipped = t.lineitem.groupBy("l_suppkey", month("l_shipdate")).agg(F.sum("l_quantity").alias("shipped")).join(
        t.supplier, F.col("l_suppkey") == F.col("s_suppkey")
    ).join(nations, F.col("s_nationkey") == F.col("n_nationkey")).groupBy(*keys).agg(
        F.sum("shipped").alias("shipped"))
    merged = joins.merge_on_grain({"events": events, "orders": orders, "lineitem": shipped}, keys)
    return rounded(merged, "events")


@query("coverage", f"""
    WITH {SQL_LOCATED}, wide AS (
        SELECT province_name, date_trunc('hour', ts) AS hour, {_SQL_PIVOT} FROM located GROUP BY ALL),
    long AS (SELECT province_name, metric, count(*) AS n_rows, count(value) AS n_present FROM (
        SELECT * FROM wide UNPIVOT INCLUDE NULLS (value FOR metric IN (clicks, views, purchases, signups, errors)))
        GROUP BY ALL)
    SELECT province_name, metric, n_rows, n_present, {sql_r4('n_present / n_rows')} AS coverage FROM long""")
def coverage(t):
    return rounded(
        aggregate.coverage(pivot_metrics(t), ["province_name"], list(EVENT_METRICS.values())), "coverage")


# Domain facts on derived Silver frames ---------------------------------------------------


def silver_current(t):
    return t.events.select(
        F.col("user_id").cast("string").alias("station_id"),
        F.col("ts").alias("observation_timestamp"),
        metric("click").alias("ta"), metric("view").alias("hr"), metric("error").alias("prec"))


def silver_points(t):
    """Events as Open-Meteo rows: hourly and 15-minute variables side by side."""
    slim = t.events.select("user_id", "event_type", "value", "ts")
    return located(t, slim).select(
        F.col("user_id").cast("string").alias("station_id"), "province_code",
        F.col("ts").alias("observation_timestamp"),
        metric("purchase").alias("temperature_2m"), metric("signup").alias("relative_humidity_2m"),
        metric("purchase").alias("precipitation"), metric("view").alias("shortwave_radiation"),
        metric("click").alias("direct_normal_irradiance"),
        F.col("value").alias("wind_speed_80m"), (F.col("value") * 2).alias("wind_speed_120m"),
        direction().alias("wind_direction_80m"), direction().alias("wind_direction_120m"))


_HOURLY_IDS = {"click": 1159, "view": 1161, "purchase": 10035, "signup": 10043, "error": 10195}


def _ids(values):
    pairs = []
    for name, value in values.items():
        pairs += [F.lit(name), F.lit(value).cast("bigint")]
    return F.create_map(*pairs)[F.col("event_type")]


def silver_energy(t):
    """One value per nation, hour and indicator; 10195 must not reach Gold."""
    return _hourly_located(t).groupBy(
        "province_code", F.col("hour").alias("observation_timestamp"), _ids(_HOURLY_IDS).alias("indicator_id")
    ).agg(F.max("value").alias("value"))


def province_hourly(t):
    points = silver_points(t)
    return gold.fact_province_hourly(
        silver_current(t), stations(t), points, points, silver_energy(t), province_master(t),
        created_at=_CREATED)


_HOURLY_ROUNDED = ("temperature", "humidity", "precipitation", "wind_speed_80m", "wind_speed_120m",
                   "solar_radiation", "direct_normal_irradiance")


SQL_PROVINCE_HOURLY = f"""{SQL_LOCATED},
    hours AS (SELECT *, date_trunc('hour', ts) AS hour FROM located),
    station AS (SELECT province_code, hour,
            avg(CASE WHEN event_type = 'click' THEN value END) AS ta,
            avg(CASE WHEN event_type = 'view' THEN value END) AS hr,
            avg(CASE WHEN event_type = 'error' THEN value END) AS prec,
            avg(CASE WHEN event_type = 'purchase' THEN value END) AS t2m,
            avg(CASE WHEN event_type = 'signup' THEN value END) AS rh,
            avg(CASE WHEN event_type = 'view' THEN value END) AS sw,
            avg(CASE WHEN event_type = 'click' THEN value END) AS dni
        FROM hours GROUP BY ALL),
    point AS (SELECT user_id, province_code, hour, avg(value) AS v,
            {sql_circular('(value * 7) % 360')} AS d FROM hours GROUP BY ALL),
    wind AS (SELECT province_code, hour, avg(v) AS v, {sql_circular('d')} AS d FROM point GROUP BY ALL),
    energy AS (SELECT province_code, hour + INTERVAL 1 HOUR AS hour,
            max(CASE WHEN event_type = 'click' THEN value END) AS wind_generation_mwh,
            max(CASE WHEN event_type = 'view' THEN value END) AS solar_photovoltaic_generation_mwh,
            max(CASE WHEN event_type = 'purchase' THEN value END) AS hydraulic_generation_mwh,
            max(CASE WHEN event_type = 'signup' THEN value END) AS total_generation_mwh
        FROM hours WHERE event_type <> 'error' GROUP BY ALL),
    joined AS (SELECT * FROM station FULL JOIN wind USING (province_code, hour)
               FULL JOIN energy USING (province_code, hour)),
    fact AS (SELECT hour AS gold_timestamp, concat('PROVINCE|', province_code) AS geography_key, province_code,
           n.n_name AS province_name, CAST(r.r_regionkey AS VARCHAR) AS autonomous_community_code,
           r.r_name AS autonomous_community_name,
           coalesce(ta, t2m) AS temperature, coalesce(hr, rh) AS humidity, coalesce(prec, t2m) AS precipitation,
           v AS wind_speed_80m, v * 2 AS wind_speed_120m, d AS wind_direction_80m,
           sw AS solar_radiation, dni AS direct_normal_irradiance,
           wind_generation_mwh, solar_photovoltaic_generation_mwh, hydraulic_generation_mwh,
           total_generation_mwh, CAST(NULL AS DOUBLE) AS nuclear_generation_mwh,
           CASE WHEN ta IS NOT NULL THEN 'AEMET' WHEN t2m IS NOT NULL THEN 'OPEN_METEO' END AS temperature_source,
           CASE WHEN hr IS NOT NULL THEN 'AEMET' WHEN rh IS NOT NULL THEN 'OPEN_METEO' END AS humidity_source,
           CASE WHEN prec IS NOT NULL THEN 'AEMET' WHEN t2m IS NOT NULL THEN 'OPEN_METEO' END AS precipitation_source,
           TIMESTAMP '2024-03-01 00:00:00' AS gold_created_at
    FROM joined JOIN nation n ON province_code = CAST(n.n_nationkey AS VARCHAR)
    JOIN region r ON n.n_regionkey = r.r_regionkey)
"""
_PLAIN_COLUMNS = (
    "gold_timestamp", "geography_key", "province_code", "province_name", "autonomous_community_name",
    "wind_generation_mwh", "solar_photovoltaic_generation_mwh", "hydraulic_generation_mwh",
    "total_generation_mwh", "nuclear_generation_mwh",
    "temperature_source", "humidity_source", "precipitation_source", "gold_created_at")


@query("gold_province_hourly", f"""
    WITH {SQL_PROVINCE_HOURLY}
    SELECT {', '.join(_PLAIN_COLUMNS)}, {', '.join(f'{sql_r4(name)} AS {name}' for name in _HOURLY_ROUNDED)},
           {sql_angle4('wind_direction_80m')} AS wind_direction_80m FROM fact""")
def gold_province_hourly(t):
    fact = province_hourly(t).select(
        *_PLAIN_COLUMNS, *_HOURLY_ROUNDED, angle4(F.col("wind_direction_80m")).alias("wind_direction_80m"))
    return rounded(fact, *_HOURLY_ROUNDED)


# order status -> capacity indicator
_CAPACITY_IDS = {"F": 1475, "O": 1485, "P": 10302}


def silver_capacity(t):
    """Highest order value per region, month and status as installed capacity.

    The month's instant is the local midnight of its first day, in UTC.
    """
    month = F.to_utc_timestamp(F.date_trunc("month", "o_orderdate").cast("timestamp"), "Europe/Madrid")
    pairs = []
    for status, indicator in _CAPACITY_IDS.items():
        pairs += [F.lit(status), F.lit(indicator).cast("bigint")]
    indicator = F.create_map(*pairs)[F.col("o_orderstatus")]
    master = province_master(t)
    customers = t.customer.select("c_custkey", F.col("c_nationkey").cast("string").alias("province_code"))
    placed = t.orders.select(
        "o_custkey", "o_totalprice", month.alias("observation_timestamp"), indicator.alias("indicator_id")
    ).join(customers, F.col("o_custkey") == F.col("c_custkey")).join(master, "province_code")
    return placed.groupBy(
        (F.col("autonomous_community_code").cast("bigint") + 100).alias("esios_geo_id"),
        F.initcap("autonomous_community_name").alias("esios_geo_name"),
        "observation_timestamp", "indicator_id",
    ).agg(F.max("o_totalprice").alias("value"))


SQL_CAPACITY = """
    capacity AS (SELECT strftime(o_orderdate, '%Y-%m') AS year_month,
           date_trunc('month', o_orderdate) AS gold_month_timestamp,
           concat('AUTONOMOUS_COMMUNITY|', r_regionkey) AS geography_key,
           CAST(r_regionkey AS VARCHAR) AS autonomous_community_code, r_name AS autonomous_community_name,
           CAST(r_regionkey + 100 AS BIGINT) AS esios_geo_id,
           max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS hydraulic_installed_capacity_mw,
           max(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS wind_installed_capacity_mw,
           max(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS renewable_total_installed_capacity_mw,
           CAST(NULL AS DOUBLE) AS nuclear_installed_capacity_mw
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)"""


def capacity_fact(t):
    communities = province_master(t).select("autonomous_community_code", "autonomous_community_name")
    return gold.fact_installed_capacity_monthly(silver_capacity(t), communities, created_at=_CREATED)


@query("gold_capacity_monthly", f"WITH {SQL_CAPACITY} SELECT * FROM capacity")
def gold_capacity_monthly(t):
    return capacity_fact(t).select(
        "year_month", "gold_month_timestamp", "geography_key", "autonomous_community_code",
        "autonomous_community_name", "esios_geo_id", "hydraulic_installed_capacity_mw",
        "wind_installed_capacity_mw", "renewable_total_installed_capacity_mw",
        "nuclear_installed_capacity_mw")


_SEGMENTS = {name: name.lower() for name in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")}
_SQL_SEGMENTS = ", ".join(
    f"max(CASE WHEN c_mktsegment = '{name}' THEN c_acctbal END) AS {metric}" for name, metric in _SEGMENTS.items())


@query("capacity_monthly", f"""
    SELECT r_name AS community, strftime(o_orderdate, '%Y-%m') AS year_month,
           {_SQL_SEGMENTS}
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def capacity_monthly(t):
    master = province_master(t)
    customers = t.customer.select(
        "c_custkey", "c_mktsegment", "c_acctbal", F.col("c_nationkey").cast("string").alias("province_code"))
    rows = t.orders.select("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("year_month")).join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    ).join(master, "province_code").withColumnRenamed("autonomous_community_name", "community")
    return aggregate.pivot_metrics(
        rows, ["community", "year_month"], "c_mktsegment", "c_acctbal", _SEGMENTS)


_POWER_IDS = {"click": 1293, "view": 2038, "purchase": 2042, "signup": 2065, "error": 10004}
# demand is published for the Peninsula, the other series for Spain
_SQL_SCOPE = "CASE WHEN event_type = 'click' THEN 'PENINSULA|PENINSULA' ELSE 'COUNTRY|ES' END"


def silver_power(t):
    """Highest event value per type and five minutes as power; pumping is negative."""
    geo_id = F.when(F.col("event_type") == "click", catalog.PENINSULA_GEO_ID).otherwise(catalog.SPAIN_GEO_ID)
    signed = F.when(F.col("event_type") == "signup", -F.col("value")).otherwise(F.col("value"))
    return t.events.groupBy(
        _ids(_POWER_IDS).alias("indicator_id"), geo_id.cast("bigint").alias("esios_geo_id"),
        floor_grain(F.col("ts"), "FIVE_MINUTES").alias("observation_timestamp"),
    ).agg(F.max(signed).alias("value"))


_SQL_POWER = f"""
    power AS (SELECT event_type, {_SQL_SCOPE} AS geography_key,
                     time_bucket(INTERVAL '5 minutes', ts) + INTERVAL 1 HOUR AS tick,
                     max(CASE WHEN event_type = 'signup' THEN -value ELSE value END) AS mw
              FROM events WHERE event_type <> 'error' GROUP BY ALL)"""
_POWER_COLUMNS = {"click": "real_demand", "view": "wind_generation",
                  "purchase": "hydraulic_generation", "signup": "pumping_consumption"}


def country_5min(t):
    return gold.fact_country_5min(silver_power(t), created_at=_CREATED)


@query("fact_country_5min", f"""
    WITH {_SQL_POWER}
    SELECT tick AS gold_timestamp, geography_key,
           CASE WHEN geography_key = 'COUNTRY|ES' THEN 'COUNTRY' ELSE 'PENINSULA' END AS geography_level,
           CASE WHEN geography_key = 'COUNTRY|ES' THEN 'Spain' ELSE 'Peninsula' END AS geography_name,
           CAST(CASE WHEN geography_key = 'COUNTRY|ES' THEN 3 ELSE 8741 END AS BIGINT) AS esios_geo_id,
           max(CASE WHEN event_type = 'click' THEN mw END) AS real_demand_mw,
           max(CASE WHEN event_type = 'view' THEN mw END) AS wind_generation_power_mw,
           max(CASE WHEN event_type = 'signup' THEN mw END) AS pumping_consumption_power_mw,
           {sql_r4("max(CASE WHEN event_type = 'click' THEN mw END) / 12")} AS real_demand_energy_mwh_5min,
           {sql_r4("max(CASE WHEN event_type = 'signup' THEN mw END) / 12")} AS pumping_consumption_energy_mwh_5min
    FROM power GROUP BY tick, geography_key""")
def fact_country_5min(t):
    fact = country_5min(t).select(
        "gold_timestamp", "geography_key", "geography_level", "geography_name", "esios_geo_id",
        "real_demand_mw", "wind_generation_power_mw", "pumping_consumption_power_mw",
        "real_demand_energy_mwh_5min", "pumping_consumption_energy_mwh_5min")
    return rounded(fact, "real_demand_energy_mwh_5min", "pumping_consumption_energy_mwh_5min")


def country_15min(t):
    return gold.fact_country_15min(silver_points(t), silver_power(t), created_at=_CREATED)


_SQL_ENERGY_15 = ", ".join(
    f"CASE WHEN count(*) FILTER (WHERE event_type = '{kind}') >= 3 THEN "
    f"sum(mw / 12) FILTER (WHERE event_type = '{kind}') END AS {name}"
    for kind, name in _POWER_COLUMNS.items())
_COUNTRY_15_ROUNDED = [
    "temperature", "humidity", "wind_speed_80m",
    *[f"{name}_energy_mwh_15min" for name in _POWER_COLUMNS.values()]]


SQL_COUNTRY_15 = f"""{SQL_LOCATED}, {_SQL_POWER},
    province AS (SELECT province_code, time_bucket(INTERVAL '15 minutes', ts) AS slot,
            avg(CASE WHEN event_type = 'purchase' THEN value END) AS t,
            avg(CASE WHEN event_type = 'signup' THEN value END) AS h, avg(value) AS v,
            {sql_circular('(value * 7) % 360')} AS d FROM located GROUP BY ALL),
    weather AS (SELECT 'COUNTRY|ES' AS geography_key, slot, avg(t) AS t, avg(h) AS h, avg(v) AS v,
            {sql_circular('d')} AS d FROM province GROUP BY ALL),
    energy AS (SELECT geography_key, time_bucket(INTERVAL '15 minutes', tick) AS slot, {_SQL_ENERGY_15}
               FROM power GROUP BY ALL),
    quarter AS (SELECT slot AS gold_timestamp, geography_key,
           CASE WHEN geography_key = 'COUNTRY|ES' THEN 'COUNTRY' ELSE 'PENINSULA' END AS geography_level,
           t AS temperature, h AS humidity, v AS wind_speed_80m, d AS wind_direction_120m,
           {', '.join(f"{name} AS {name}_energy_mwh_15min" for name in _POWER_COLUMNS.values())}
    FROM weather FULL JOIN energy USING (geography_key, slot))"""


@query("fact_country_15min", f"""
    WITH {SQL_COUNTRY_15}
    SELECT gold_timestamp, geography_key, geography_level,
           {', '.join(f"{sql_r4(name)} AS {name}" for name in _COUNTRY_15_ROUNDED)},
           {sql_angle4('wind_direction_120m')} AS wind_direction_120m FROM quarter""")
def fact_country_15min(t):
    fact = country_15min(t).select(
        "gold_timestamp", "geography_key", "geography_level",
        *_COUNTRY_15_ROUNDED, angle4(F.col("wind_direction_120m")).alias("wind_direction_120m"))
    return rounded(fact, *_COUNTRY_15_ROUNDED)


# Dimensions --------------------------------------------------------------------------


def _grain_instants(t):
    """Instants of the three sub-monthly grains and months out of one distinct pass.

    The coarser grains are functions of the five-minute instant, so only the
    five-minute distinct touches the events.
    """
    five = t.events.select(floor_grain(F.col("ts"), "FIVE_MINUTES").alias("gold_timestamp")).distinct()
    coarser = lambda grain: five.select(floor_grain(F.col("gold_timestamp"), grain).alias("gold_timestamp"))
    return {
        "FIVE_MINUTES": five,
        "FIFTEEN_MINUTES": coarser("FIFTEEN_MINUTES"),
        "HOUR": coarser("HOUR"),
        "MONTH": five.select(F.date_format("gold_timestamp", "yyyy-MM").alias("year_month")),
    }


def time_dimension(t):
    return gold.dim_time(_grain_instants(t), created_at=_CREATED)


def _sql_members(grain, bucket):
    return f"""
    SELECT DISTINCT concat('{grain}|', strftime({bucket}, '%Y-%m-%dT%H:%M:%S')) AS time_key,
           '{grain}' AS time_grain, {bucket} AS gold_timestamp, CAST({bucket} AS DATE) AS "date",
           CAST(year({bucket}) AS INTEGER) AS "year", CAST(month({bucket}) AS INTEGER) AS "month",
           strftime({bucket}, '%Y-%m') AS year_month, CAST(day({bucket}) AS INTEGER) AS "day",
           CAST(dayofweek({bucket}) + 1 AS INTEGER) AS day_of_week,
           CAST(hour({bucket}) AS INTEGER) AS "hour", CAST(minute({bucket}) AS INTEGER) AS "minute"
    FROM events"""


SQL_DIM_TIME = f"""
    {_sql_members('FIVE_MINUTES', "time_bucket(INTERVAL '5 minutes', ts)")} UNION ALL
    {_sql_members('FIFTEEN_MINUTES', "time_bucket(INTERVAL '15 minutes', ts)")} UNION ALL
    {_sql_members('HOUR', "date_trunc('hour', ts)")} UNION ALL
    SELECT DISTINCT concat('MONTH|', strftime(ts, '%Y-%m')), 'MONTH', CAST(NULL AS TIMESTAMP),
           CAST(NULL AS DATE), CAST(year(ts) AS INTEGER), CAST(month(ts) AS INTEGER),
           strftime(ts, '%Y-%m'), CAST(NULL AS INTEGER), CAST(NULL AS INTEGER), CAST(NULL AS INTEGER),
           CAST(NULL AS INTEGER) FROM events"""


@query("dim_time", SQL_DIM_TIME)
def dim_time(t):
    return time_dimension(t).drop("gold_created_at")


@query("calendar_parts", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS "date", CAST(year(o_orderdate) AS INTEGER) AS "year",
           CAST(month(o_orderdate) AS INTEGER) AS "month", strftime(o_orderdate, '%Y-%m') AS year_month,
           CAST(day(o_orderdate) AS INTEGER) AS "day", CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week,
           CAST(0 AS INTEGER) AS "hour", CAST(0 AS INTEGER) AS "minute",
           concat(o_orderstatus, '|', o_orderkey) AS order_key
    FROM orders""")
def order_calendar(t):
    parts = calendar_parts(F.col("o_orderdate"))
    key = surrogate_key(F.col("o_orderstatus"), F.col("o_orderkey"))
    return t.orders.select(
        "o_orderkey", *[column.alias(name) for name, column in parts.items()], key.alias("order_key"))


def geography_dimension(t, esios_ids=None):
    """Dimension over the province master as the customers deliver it."""
    master = silver.provinces(provinces_csv(t))
    return gold.dim_geography(
        master, silver.autonomous_communities(master), created_at=_CREATED, esios_ids=esios_ids)


SQL_DIM_GEOGRAPHY = """
    SELECT concat('PROVINCE|', n_nationkey) AS geography_key, 'PROVINCE' AS geography_level,
           CAST(n_nationkey AS VARCHAR) AS geography_code, n_name AS geography_name,
           CAST(n_nationkey AS VARCHAR) AS province_code, n_name AS province_name,
           CAST(r_regionkey AS VARCHAR) AS autonomous_community_code, r_name AS autonomous_community_name,
           'ES' AS country_code, 'Spain' AS country_name, CAST(NULL AS BIGINT) AS esios_geo_id
    FROM nation JOIN region ON n_regionkey = r_regionkey
    WHERE n_nationkey IN (SELECT c_nationkey FROM customer)
    UNION ALL
    SELECT DISTINCT concat('AUTONOMOUS_COMMUNITY|', r_regionkey), 'AUTONOMOUS_COMMUNITY',
           CAST(r_regionkey AS VARCHAR), r_name, NULL, NULL, CAST(r_regionkey AS VARCHAR), r_name,
           'ES', 'Spain', CAST(NULL AS BIGINT)
    FROM nation JOIN region ON n_regionkey = r_regionkey
    WHERE n_nationkey IN (SELECT c_nationkey FROM customer)
    UNION ALL
    SELECT 'COUNTRY|ES', 'COUNTRY', 'ES', 'Spain', NULL, NULL, NULL, NULL, 'ES', 'Spain', 3
    UNION ALL
    SELECT 'PENINSULA|PENINSULA', 'PENINSULA', 'PENINSULA', 'Peninsula', NULL, NULL, NULL, NULL, NULL, NULL, 8741"""


@query("dim_geography", f"""
    WITH {SQL_CAPACITY.strip()}, seen AS (SELECT DISTINCT geography_key, esios_geo_id AS id FROM capacity)
    SELECT d.* REPLACE (coalesce(d.esios_geo_id, seen.id) AS esios_geo_id)
    FROM ({SQL_DIM_GEOGRAPHY}) d LEFT JOIN seen ON d.geography_key = seen.geography_key""")
def dim_geography(t):
    """Communities carry the source id seen with their capacity; other members none."""
    return geography_dimension(t, capacity_fact(t)).drop("gold_created_at")


@query("dim_reference", f"""
    WITH {SQL_LOCATED}
    SELECT DISTINCT concat('PROVINCE|', province_code) AS geography_key FROM located
    WHERE autonomous_community_name = 'ASIA'""")
def dim_reference(t):
    facts = located(t, t.events.select("user_id")).select(
        surrogate_key(F.lit("PROVINCE"), F.col("province_code")).alias("geography_key"))
    partial = geography_dimension(t).filter(
        F.col("autonomous_community_name").isNull() | (F.col("autonomous_community_name") != "ASIA"))
    return joins.dangling(facts, partial, ["geography_key"])


@query("dim_time_increment", f"""
    SELECT time_key FROM ({SQL_DIM_TIME}) WHERE time_key NOT IN (
        SELECT time_key FROM ({SQL_DIM_TIME.replace('FROM events', "FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00'")}))""")
def dim_time_increment(t):
    cut = F.lit(dt.datetime(2024, 1, 20)).cast("timestamp_ntz")

    class Earlier:
        events = t.events.filter(F.col("ts") < cut)

    known = time_dimension(Earlier)
    return joins.new_members(time_dimension(t), known, "time_key").select("time_key")
