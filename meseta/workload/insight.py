"""Queries: correlations, bins, shares, rankings, reports and ranges."""

from __future__ import annotations

from pyspark.sql import functions as F

from meseta.operators import analytics, radiation, ranges
from meseta.workload import facts
from meseta.workload.derived import SQL_LOCATED, direction, province_master
from meseta.workload.registry import query, rounded, sql_r4

_SQL_HOURLY = f"""
    WITH {SQL_LOCATED}, hourly AS (
        SELECT autonomous_community_name AS place, date_trunc('hour', ts) AS hour,
               avg(CASE WHEN event_type = 'click' THEN value END) AS x,
               avg(CASE WHEN event_type = 'view' THEN value END) AS y
        FROM located GROUP BY ALL)"""


def _hourly(t):
    return facts._hourly_located(t).groupBy(
        F.col("autonomous_community_name").alias("place"), "hour"
    ).agg(
        F.avg(F.when(F.col("event_type") == "click", F.col("value"))).alias("x"),
        F.avg(F.when(F.col("event_type") == "view", F.col("value"))).alias("y"))


def sql_pearson(x, y):
    """Correlation over complete pairs; NULL unless both sides vary."""
    varies = " AND ".join(
        f"min({side}) FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL) < "
        f"max({side}) FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL)" for side in (x, y))
    return f"CASE WHEN {varies} THEN corr({x}, {y}) END"


def _sql_corr(by):
    return f"""SELECT {by} AS place, count(*) FILTER (WHERE x IS NOT NULL AND y IS NOT NULL) AS n_pairs,
        {sql_r4(sql_pearson('x', 'y'))} AS correlation FROM hourly GROUP BY ALL"""


# every offset of every place is listed, also without a pair
_SQL_SCAN = f"""{_SQL_HOURLY},
    offsets AS (SELECT CAST(unnest(range(-3, 4)) AS INTEGER) AS offset_hours),
    shifted AS (SELECT offset_hours, place, hour + to_hours(offset_hours) AS hour, x FROM hourly, offsets),
    scan AS (SELECT s.offset_hours, s.place,
                    count(*) FILTER (WHERE s.x IS NOT NULL AND h.y IS NOT NULL) AS n_pairs,
                    {sql_pearson('s.x', 'h.y')} AS c
             FROM shifted s LEFT JOIN hourly h ON s.place = h.place AND s.hour = h.hour GROUP BY ALL)"""


@query("corr_by_geo", f"""{_SQL_HOURLY} {_sql_corr('place')} UNION ALL {_sql_corr("'all'")}""")
def corr_by_geo(t):
    # one pass: each hour counts for its place and for all
    hourly = _hourly(t).select(F.explode(F.array("place", F.lit("all"))).alias("place"), "x", "y")
    return rounded(analytics.correlate(hourly, "x", "y", ["place"]), "correlation")


@query("offset_scan", f"""{_SQL_SCAN}
    SELECT offset_hours, place, n_pairs, {sql_r4('c')} AS correlation FROM scan""")
def offset_scan(t):
    scan = analytics.offset_scan(
        _hourly(t), ["place"], "hour", "x", "y", range(-3, 4), by=["place"])
    return rounded(scan, "correlation")


@query("best_offset", f"""{_SQL_SCAN}
    SELECT place, offset_hours, {sql_r4('c')} AS correlation FROM scan WHERE c IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY place ORDER BY c DESC, offset_hours) = 1""")
def best_offset(t):
    scan = analytics.offset_scan(
        _hourly(t), ["place"], "hour", "x", "y", range(-3, 4), by=["place"])
    return rounded(analytics.best_offset(scan, ["place"]).drop("n_pairs"), "correlation")


@query("mean_by_bin", f"""
    SELECT floor(l_extendedprice / 5000) * 5000.0 AS bin_start, count(l_quantity) AS n,
           {sql_r4('avg(l_quantity)')} AS mean FROM lineitem GROUP BY 1""")
def mean_by_bin(t):
    return rounded(analytics.mean_by_bin(t.lineitem, "l_extendedprice", "l_quantity", 5000.0), "mean")


@query("mean_by_sector", f"""
    SELECT CAST(floor((((value * 7) % 360) + 22.5) % 360.0 / 45) AS INTEGER) AS sector, count(value) AS n,
           {sql_r4('avg(value)')} AS mean FROM events GROUP BY 1""")
def mean_by_sector(t):
    return rounded(
        analytics.mean_by_sector(t.events.withColumn("direction", direction()), "direction", "value"), "mean")


_FLAGS = {"A": "accepted", "N": "fresh", "R": "returned"}
_SQL_FLAGS = ", ".join(
    f"CASE WHEN l_returnflag = '{flag}' THEN l_quantity ELSE 0 END AS {name}" for flag, name in _FLAGS.items())


@query("mix_share", f"""
    SELECT date_trunc('month', l_shipdate) AS period, sum(l_quantity) AS total,
           {', '.join(f"{sql_r4(f'sum({name}) / sum(l_quantity)')} AS {name}_share" for name in _FLAGS.values())}
    FROM (SELECT l_shipdate, l_quantity, {_SQL_FLAGS} FROM lineitem) GROUP BY 1""")
def mix_share(t):
    wide = t.lineitem.select(
        F.date_trunc("month", "l_shipdate").alias("period"), "l_quantity",
        *[F.when(F.col("l_returnflag") == flag, F.col("l_quantity")).otherwise(0.0).alias(name)
          for flag, name in _FLAGS.items()])
    shares = analytics.mix_share(wide, list(_FLAGS.values()), "l_quantity", ["period"])
    return rounded(shares, *[f"{name}_share" for name in _FLAGS.values()])


@query("unpivot_series", f"""
    WITH {SQL_LOCATED}, wide AS (
        SELECT province_name, date_trunc('hour', ts) AS hour, {facts._SQL_PIVOT} FROM located GROUP BY ALL)
    SELECT province_name, hour, metric, value FROM (
        UNPIVOT wide ON clicks, views, purchases, signups, errors INTO NAME metric VALUE value)""")
def unpivot_series(t):
    return analytics.unpivot_series(
        facts.pivot_metrics(t), ["province_name", "hour"], list(facts.EVENT_METRICS.values()))


@query("topk_per_group", f"""
    SELECT c_mktsegment, n_name, {sql_r4('balance')} AS balance, CAST(rn AS INTEGER) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY balance DESC, n_name) AS rn FROM (
            SELECT c_mktsegment, n_name, round(sum(c_acctbal), 2) AS balance
            FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)) WHERE rn <= 3""")
def topk_per_group(t):
    summed = t.customer.groupBy("c_mktsegment", "c_nationkey").agg(
        F.round(F.sum("c_acctbal"), 2).alias("balance"))
    named = summed.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_mktsegment", "n_name", "balance")
    return rounded(analytics.top_k(named, ["c_mktsegment"], "balance", 3, ["n_name"]), "balance")


@query("capacity_vs_generation", f"""
    WITH placed AS (
        SELECT r_name AS place, strftime(o_orderdate, '%Y-%m') AS year_month, o_totalprice, c_acctbal
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey),
    capacity AS (SELECT place, year_month, max(c_acctbal) AS capacity_mw FROM placed GROUP BY ALL),
    produced AS (SELECT place, year_month, sum(o_totalprice) AS energy_mwh FROM placed GROUP BY ALL)
    SELECT place, year_month, capacity_mw, {sql_r4('energy_mwh')} AS energy_mwh,
           {sql_r4('energy_mwh / nullif(capacity_mw, 0)')} AS mwh_per_mw
    FROM capacity JOIN produced USING (place, year_month)""")
def capacity_vs_generation(t):
    master = province_master(t)
    customers = t.customer.select(
        "c_custkey", "c_acctbal", F.col("c_nationkey").cast("string").alias("province_code"))
    placed = t.orders.select(
        "o_custkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("year_month")
    ).join(customers, F.col("o_custkey") == F.col("c_custkey")).join(master, "province_code").select(
        F.col("autonomous_community_name").alias("place"), "year_month",
        F.col("o_totalprice").alias("energy_mwh"), F.col("c_acctbal").alias("capacity_mw"))
    keys = ["place", "year_month"]
    capacity = placed.groupBy(*keys).agg(F.max("capacity_mw").alias("capacity_mw"))
    joined = analytics.capacity_and_generation(capacity, placed, keys, "capacity_mw", "energy_mwh")
    return rounded(joined, "energy_mwh", "mwh_per_mw")


# Radiation reports ---------------------------------------------------------------------


def radiation_reports(t):
    """One report per user and day: GL values of the hours 5-20 and a UVB block cut short.

    The hourly cells are conditional aggregates, so no list of readings is collected.
    """
    hour = F.hour("ts")
    cells = [
        F.max(F.when(hour == h, F.col("value"))).cast("string").alias(f"h{h}") for h in range(5, 21)
    ]
    daily = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        *cells, F.count(F.lit(1)).alias("readings"))
    quoted = lambda c: F.concat(F.lit('"'), F.coalesce(c.cast("string"), F.lit("")), F.lit('"'))
    row = F.concat_ws(
        ";", quoted(F.concat(F.lit("Station; no "), F.col("user_id"))), quoted(F.col("user_id")),
        quoted(F.lit("GL")), *[quoted(F.col(f"h{h}")) for h in range(5, 21)],
        quoted(F.col("readings")), quoted(F.lit("UVB")), quoted(F.lit("1")))
    text = F.concat_ws(
        "\n", F.lit('"RADIACION SOLAR"'), quoted(F.date_format("day", "dd-MM-yy")),
        F.lit('"Estación";"Indicativo";"Tipo"'), row, F.lit(""))
    return daily.select(text.alias("value"))


@query("radiation_parse", """
    WITH days AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS readings FROM events GROUP BY ALL),
    hours AS (SELECT unnest(range(5, 21)) AS h),
    cells AS (SELECT user_id, CAST(ts AS DATE) AS day, hour(ts) AS h, max(value) AS value FROM events GROUP BY ALL)
    SELECT concat('Station; no ', d.user_id) AS station_name, CAST(d.user_id AS VARCHAR) AS station_id,
           d.day AS observation_date, 'GL' AS radiation_type, printf('%02d:00', h.h) AS solar_time,
           c.value, '10*kJ/m2' AS unit, CAST(d.readings AS DOUBLE) AS daily_total, '1h' AS temporal_granularity
    FROM days d CROSS JOIN hours h
    LEFT JOIN cells c ON c.user_id = d.user_id AND c.day = d.day AND c.h = h.h""")
def radiation_parse(t):
    return radiation.parse_radiation(radiation_reports(t))


# Backfill windows ----------------------------------------------------------------------

_SQL_SPANS = """
    spans AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_day,
                     CAST(max(o_orderdate) AS DATE) AS last_day FROM orders GROUP BY o_custkey),
    windows AS (SELECT o_custkey, CAST(i AS INTEGER) AS window_index,
                       CAST(first_day + CAST(i * 31 AS INTEGER) AS DATE) AS window_start,
                       CAST(least(first_day + CAST(i * 31 + 30 AS INTEGER), last_day) AS DATE) AS window_end
                FROM (SELECT *, unnest(range(0, (last_day - first_day) // 31 + 1)) AS i FROM spans))"""


def _windows(t):
    spans = t.orders.groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("first_day"), F.to_date(F.max("o_orderdate")).alias("last_day"))
    return ranges.tile_ranges(spans, "first_day", "last_day", 31)


@query("range_tiling", f"WITH {_SQL_SPANS} SELECT * FROM windows")
def range_tiling(t):
    return _windows(t)


@query("window_coverage", f"""
    WITH {_SQL_SPANS}
    SELECT w.*, count(o.o_orderkey) AS n_observations FROM windows w LEFT JOIN orders o
    ON o.o_custkey = w.o_custkey AND CAST(o.o_orderdate AS DATE) BETWEEN w.window_start AND w.window_end
    GROUP BY ALL""")
def window_coverage(t):
    return ranges.window_coverage(_windows(t), t.orders, ["o_custkey"], "o_orderdate", 31)
