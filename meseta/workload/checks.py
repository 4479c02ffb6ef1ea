"""Queries: data-quality verdicts, profiles and step analysis."""

from __future__ import annotations

import datetime as dt
from itertools import combinations

from pyspark.sql import functions as F

from meseta import catalog
from meseta.functions import floor_grain, power_to_energy
from meseta.operators import aggregate, gaps, geo, guards, quality
from meseta.operators.clean import union_all
from meseta.plans import gold, silver
from meseta.workload import facts
from meseta.workload.cleaning import _SQL_DMS_LATITUDE, _dms
from meseta.workload.derived import SQL_LOCATED, located
from meseta.workload.registry import query


def _verdict(check, table, severity, total, bad, source):
    return (
        f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", '{severity}' AS severity, "
        f"CAST({total} AS BIGINT) AS n_total, CAST({bad} AS BIGINT) AS n_bad FROM {source}"
    )


def _bad(condition):
    return f"count(*) FILTER (WHERE {condition})"


# Keys --------------------------------------------------------------------------------


@query("null_keys", _verdict("null_key", "events", "ERROR", "count(*)", _bad("event_id % 97 = 0"), "events"))
def null_keys(t):
    holed = t.events.withColumn("user_id", F.when(F.col("event_id") % 97 != 0, F.col("user_id")))
    return quality.row_checks(holed, "events", {"null_key": quality.null_key(["user_id", "ts"])})


@query("dup_keys", _verdict(
    "duplicate_key", "lineitem", "ERROR", "sum(n)", _bad("n > 1"),
    "(SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"))
def dup_keys(t):
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"], "lineitem")


@query("distinct_counts", """
    SELECT event_type, count(DISTINCT user_id) AS n_users, count(DISTINCT CAST(ts AS DATE)) AS n_days
    FROM events GROUP BY event_type""")
def distinct_counts(t):
    return t.events.groupBy("event_type").agg(
        F.countDistinct("user_id").alias("n_users"), F.countDistinct(F.to_date("ts")).alias("n_days"))


@query("surplus_rows", """
    SELECT l_returnflag, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
           CAST(sum(n) - count(*) AS BIGINT) AS n_duplicates
    FROM (SELECT l_returnflag, l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
    GROUP BY l_returnflag""")
def surplus_rows(t):
    return quality.surplus_rows(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_returnflag"])


@query("class_census", """
    SELECT event_type AS magnitude, event_id % 2 AS time, count(DISTINCT user_id) AS n_datasets
    FROM events GROUP BY ALL""")
def class_census(t):
    return t.events.groupBy(
        F.col("event_type").alias("magnitude"), (F.col("event_id") % 2).alias("time")
    ).agg(F.countDistinct("user_id").alias("n_datasets"))


@query("class_purity", _verdict(
    "class_purity", "events", "ERROR", "count(*)", _bad("event_id % 2 <> 0"),
    "events WHERE event_type IN ('click', 'view')"))
def class_purity(t):
    # indicator selection first; the excluded types never reach the check
    selected = t.events.filter(F.col("event_type").isin("click", "view")).select(
        F.lit(1).alias("magnitude_id"), (F.col("event_id") % 2).alias("time_id"))
    return quality.row_checks(
        selected, "events", {"class_purity": quality.class_purity("magnitude_id", "time_id", (1, 0))})


@query("required_fields", " UNION ALL ".join(
    _verdict(f"null_{name}", "customer", "ERROR", "count(*)", bad, "customer") for name, bad in (
        ("c_custkey", "count(*) - count(c_custkey)"), ("c_name", _bad("c_custkey % 11 = 0")),
        ("c_nationkey", "count(*) - count(c_nationkey)"))))
def required_fields(t):
    holed = t.customer.withColumn("c_name", F.when(F.col("c_custkey") % 11 != 0, F.col("c_name")))
    return quality.row_checks(
        holed, "customer", quality.null_fields(["c_custkey", "c_name", "c_nationkey"]))


_SQL_LAT, _SQL_LON = "(c_custkey % 100)", "(CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 200 END)"
_SQL_DMS_BAD = f"NOT {_SQL_DMS_LATITUDE}"


@query("coordinate_range", " UNION ALL ".join((
    _verdict("coordinate_out_of_range", "customer", "ERROR", "count(*)",
             _bad(f"{_SQL_LAT} > 90 OR {_SQL_LON} > 180"), "customer"),
    _verdict("coordinate_missing", "customer", "WARNING", "count(*)", _bad("c_custkey % 7 = 0"), "customer"),
    _verdict("dms_shape", "customer", "WARNING", "count(*)", _bad(_SQL_DMS_BAD), "customer"))))
def coordinate_range(t):
    key = F.col("c_custkey")
    rows = t.customer.select(
        (key % 100).cast("double").alias("latitude"),
        F.when(key % 7 != 0, key % 200).cast("double").alias("longitude"), _dms(key).alias("dms"))
    return quality.row_checks(rows, "customer", {
        **quality.coordinate_checks("latitude", "longitude"), "dms_shape": quality.dms_check("dms", "latitude")})


@query("key_profile", """
    SELECT 'c_custkey' AS "column", count(*) AS n_rows, count(*) AS n_filled,
           count(DISTINCT c_custkey) AS n_distinct, count(*) - count(DISTINCT c_custkey) AS n_duplicates FROM customer
    UNION ALL SELECT 'c_name', count(*), count(*), count(DISTINCT c_name), count(*) - count(DISTINCT c_name) FROM customer
    UNION ALL SELECT 'c_nationkey', count(*), count(*), count(DISTINCT c_nationkey), count(*) - count(DISTINCT c_nationkey) FROM customer
    UNION ALL SELECT 'c_mktsegment', count(*), count(*), count(DISTINCT c_mktsegment), count(*) - count(DISTINCT c_mktsegment) FROM customer""")
def key_profile(t):
    return quality.key_profile(t.customer, ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])


# Steps -------------------------------------------------------------------------------

_SQL_STEPS = """(SELECT user_id, event_type,
        (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY {series} ORDER BY ts))) / 60000000.0 AS minutes
    FROM events)"""


@query("gap_detect", f"""
    SELECT user_id, count(minutes) AS n_steps, count(*) FILTER (WHERE minutes <= 60) AS n_matching
    FROM {_SQL_STEPS.format(series='user_id')} GROUP BY user_id HAVING count(minutes) > 0""")
def gap_detect(t):
    found = gaps.steps(t.events, ["user_id"], "ts")
    return found.groupBy("user_id").agg(
        F.sum("n").alias("n_steps"),
        F.coalesce(F.sum(F.when(F.col("minutes") <= 60, F.col("n"))), F.lit(0)).alias("n_matching"))


@query("gap_regularity", _verdict(
    "irregular_step", "orders", "WARNING", "count(minutes)", _bad("minutes <> 1440"),
    """(SELECT (epoch_us(o_orderdate) - epoch_us(lag(o_orderdate) OVER (
            PARTITION BY o_orderstatus ORDER BY o_orderdate))) / 60000000.0 AS minutes FROM orders)"""))
def gap_regularity(t):
    # dates repeat within a status: equal instants count as steps of length zero
    return quality.irregular_steps(t.orders, ["o_orderstatus"], "o_orderdate", 1440.0, "orders")


@query("gap_distribution", f"""
    SELECT event_type, CAST(floor(minutes) AS BIGINT) AS minutes, count(*) AS n
    FROM {_SQL_STEPS.format(series='event_type')} WHERE minutes IS NOT NULL GROUP BY ALL""")
def gap_distribution(t):
    return gaps.step_histogram(t.events, ["event_type"], "ts", ["event_type"], whole_minutes=True)


@query("gap_top_steps", f"""
    SELECT event_type, CAST(floor(minutes) AS BIGINT) AS minutes, count(*) AS n
    FROM {_SQL_STEPS.format(series='event_type')} WHERE minutes IS NOT NULL GROUP BY ALL
    ORDER BY n DESC, minutes, event_type LIMIT 10""")
def gap_top_steps(t):
    """The ten most frequent step lengths; Spark keeps ten rows per task, not a sort of all."""
    histogram = gaps.step_histogram(t.events, ["event_type"], "ts", ["event_type"], whole_minutes=True)
    return histogram.orderBy(F.col("n").desc(), "minutes", "event_type").limit(10)


@query("gap_off_grain", """
    SELECT o_orderpriority, minutes, count(*) AS n FROM (
        SELECT o_orderpriority, (epoch_us(o_orderdate) - epoch_us(lag(o_orderdate) OVER (
            PARTITION BY o_orderpriority ORDER BY o_orderdate))) / 60000000.0 AS minutes FROM orders)
    WHERE minutes <> 0 GROUP BY ALL""")
def gap_off_grain(t):
    return gaps.off_grain(t.orders, ["o_orderpriority"], "o_orderdate", 0.0, ["o_orderpriority"])


# Gold checks -------------------------------------------------------------------------


@query("grain_check", _verdict(
    "grid", "events", "ERROR", "count(*)", _bad("minute(ts) % 15 <> 0 OR second(ts) <> 0"), "events"))
def grain_check(t):
    return quality.row_checks(
        t.events, "events", {"grid": quality.off_grid("ts", "FIFTEEN_MINUTES")})


@query("month_check", _verdict(
    "month_label", "orders", "ERROR", "count(*)",
    _bad("strftime(o_orderdate + INTERVAL 2 DAY, '%Y-%m') <> strftime(o_orderdate, '%Y-%m')"), "orders"))
def month_check(t):
    rows = t.orders.select(
        F.date_format(F.col("o_orderdate") + F.make_dt_interval(F.lit(2)), "yyyy-MM").alias("year_month"),
        F.date_trunc("month", "o_orderdate").alias("month_start"))
    return quality.row_checks(
        rows, "orders", {"month_label": quality.incoherent_month("year_month", "month_start")})


@query("sign_check", _verdict(
    "sign", "events", "ERROR", "count(*)", _bad("event_type = 'error' AND value <> 0"), "events"))
def sign_check(t):
    flipped = F.when(F.col("event_type") == "error", -F.col("value")).otherwise(F.col("value"))
    return quality.row_checks(t.events, "events", {
        "sign": quality.sign_changed(F.col("value"), power_to_energy(flipped, 5))})


_SQL_HOURLY_TYPE = """(SELECT event_type, date_trunc('hour', ts) AS hour, max(value) AS value
    FROM events GROUP BY ALL)"""


def _hourly_by_type(t):
    return t.events.groupBy("event_type", floor_grain(F.col("ts"), "HOUR").alias("hour")).agg(
        F.max("value").alias("value"))


@query("value_fidelity", _verdict(
    "value_fidelity", "hourly", "ERROR", "count(*)",
    _bad("event_type = 'view' OR (event_type = 'click' AND hour(hour) = 5)"), _SQL_HOURLY_TYPE))
def value_fidelity(t):
    source = _hourly_by_type(t)
    # a lost hour and a changed series are planted
    stored = source.filter(~((F.col("event_type") == "click") & (F.hour("hour") == 5))).withColumn(
        "value", F.when(F.col("event_type") == "view", F.col("value") + 1).otherwise(F.col("value")))
    return quality.value_fidelity(source, stored, ["event_type", "hour"], "value", "hourly")


@query("lost_coverage", _verdict(
    "lost_coverage", "hourly", "ERROR", "count(*)", _bad("hour(hour) = 5"), _SQL_HOURLY_TYPE))
def lost_coverage(t):
    source = _hourly_by_type(t)
    stored = source.filter(F.hour("hour") != 5)
    return quality.lost_coverage(source, stored, ["event_type", "hour"], "value", "hourly")


@query("provenance_check", f"""
    WITH {SQL_LOCATED}, wide AS (
        SELECT province_name, date_trunc('hour', ts) AS hour, {facts._SQL_PIVOT} FROM located GROUP BY ALL)
    {_verdict('provenance', 'wide', 'ERROR', 'count(*)',
              _bad('(clicks IS NULL AND views IS NOT NULL AND hour(hour) = 3)'), 'wide')}""")
def provenance_check(t):
    chosen = facts.fallback_metric(t)
    wide = facts.pivot_metrics(t)
    joined = wide.join(chosen, ["province_name", "hour"])
    mislabelled = joined.withColumn("source", F.when(
        F.hour("hour") == 3, F.when(F.col("source").isNotNull(), F.lit("AEMET"))).otherwise(F.col("source")))
    return quality.row_checks(mislabelled, "wide", {"provenance": quality.wrong_provenance(
        "value", "source", {"AEMET": "clicks", "OPEN_METEO": "views"})})


@query("energy_integrity", f"""
    WITH steps AS (SELECT event_type, time_bucket(INTERVAL '5 minutes', ts) AS step, max(value) AS value
                   FROM events GROUP BY ALL),
    rolled AS (SELECT event_type, time_bucket(INTERVAL '15 minutes', step) AS slot,
                      count(value) = 3 AND sum(value) > 1e-6 AS complete FROM steps GROUP BY ALL)
    {_verdict('rolled_energy', 'events', 'ERROR', 'count(*)',
              _bad("complete AND event_type = 'view'"), 'rolled')}
    UNION ALL
    {_verdict('interval_energy', 'events', 'ERROR', 'count(*)', _bad("event_type = 'view' AND value - value / 12 > 1e-6"), 'events')}""")
def energy_integrity(t):
    def rolled(df):
        return aggregate.energy_rollup(df, ["event_type"], "ts", {"energy": F.col("value")}, out="slot")

    steps = t.events.groupBy("event_type", floor_grain(F.col("ts"), "FIVE_MINUTES").alias("ts")).agg(
        F.max("value").alias("value"))
    expected = rolled(steps)
    # one series stored as summed power instead of energy
    stored = expected.withColumn("energy", F.when(
        F.col("event_type") == "view", F.col("energy") * 12).otherwise(F.col("energy")))
    intervals = t.events.select("value", F.when(
        F.col("event_type") == "view", F.col("value")).otherwise(F.col("value") / 12).alias("energy"))
    return quality.rolled_energy_matches(
        expected, stored, ["event_type", "slot"], "energy", "events"
    ).unionByName(quality.row_checks(
        intervals, "events", {"interval_energy": quality.wrong_interval_energy("value", "energy", 5)}))


def _planted_time(t):
    """Time dimension with an hour outside the day for one weekday and an odd grain."""
    return facts.time_dimension(t).withColumns({
        "hour": F.when(F.col("day_of_week") == 2, F.lit(24)).otherwise(F.col("hour")),
        "time_grain": F.when(F.col("time_key").startswith("HOUR|") & (F.col("day_of_week") == 3), "WEEK")
        .otherwise(F.col("time_grain"))})


@query("dim_time_checks", f"""
    WITH once AS ({facts.SQL_DIM_TIME}),
    members AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE time_key LIKE 'MONTH|%') SELECT * FROM (
    {_verdict('null_key', 'gold_dim_time', 'ERROR', 'count(*)', '0', 'members')} UNION ALL
    {_verdict('unknown_grain', 'gold_dim_time', 'ERROR', 'count(*)',
              _bad("time_grain = 'HOUR' AND day_of_week = 3"), 'members')} UNION ALL
    {_verdict('month_range', 'gold_dim_time', 'ERROR', 'count(*)', '0', 'members')} UNION ALL
    {_verdict('hour_range', 'gold_dim_time', 'ERROR', 'count(*)', _bad('day_of_week = 2'), 'members')} UNION ALL
    {_verdict('minute_range', 'gold_dim_time', 'ERROR', 'count(*)', '0', 'members')} UNION ALL
    {_verdict('hour_on_month', 'gold_dim_time', 'ERROR', 'count(*)', '0', 'members')} UNION ALL
    {_verdict('hour_missing', 'gold_dim_time', 'ERROR', 'count(*)', '0', 'members')} UNION ALL
    {_verdict('duplicate_key', 'gold_dim_time', 'ERROR', 'count(*)',
              "count(DISTINCT CASE WHEN time_grain = 'MONTH' THEN time_key END)", 'members')})""")
def dim_time_checks(t):
    planted = _planted_time(t)
    # every month twice
    return quality.dim_time_checks(planted.unionByName(
        planted.filter("time_key LIKE 'MONTH|%'")), "gold_dim_time")


@query("dim_geography_checks", f"""
    WITH members AS ({facts.SQL_DIM_GEOGRAPHY}), kept AS (SELECT * FROM members WHERE NOT (
        geography_level = 'AUTONOMOUS_COMMUNITY' AND geography_name = 'EUROPE'))
    SELECT * FROM (
    {_verdict('null_key', 'gold_dim_geography', 'ERROR', 'count(*)', '0', 'kept')} UNION ALL
    {_verdict('unknown_level', 'gold_dim_geography', 'ERROR', 'count(*)', _bad("geography_level = 'PENINSULA'"), 'kept')} UNION ALL
    {_verdict('lower_level_filled', 'gold_dim_geography', 'ERROR', 'count(*)', '0', 'kept')} UNION ALL
    {_verdict('country_missing', 'gold_dim_geography', 'ERROR', 'count(*)', _bad("geography_name = 'NATION_4'"), 'kept')} UNION ALL
    {_verdict('broken_hierarchy', 'gold_dim_geography', 'ERROR', _bad("geography_level = 'PROVINCE'"),
              _bad("geography_level = 'PROVINCE' AND autonomous_community_name = 'EUROPE'"), 'kept')} UNION ALL
    {_verdict('community_without_country', 'gold_dim_geography', 'ERROR',
              _bad("geography_level = 'AUTONOMOUS_COMMUNITY'"), '0', 'kept')} UNION ALL
    {_verdict('scopes_share_code', 'gold_dim_geography', 'ERROR', _bad("geography_level = 'COUNTRY'"), '0', 'kept')} UNION ALL
    {_verdict('duplicate_key', 'gold_dim_geography', 'ERROR', 'count(*)', '0', 'kept')} UNION ALL
    {_verdict('duplicate_level_and_code', 'gold_dim_geography', 'ERROR', 'count(*)', '0', 'kept')})""")
def dim_geography_checks(t):
    members = facts.geography_dimension(t)
    lost = (F.col("geography_level") == "AUTONOMOUS_COMMUNITY") & (F.col("geography_name") == "EUROPE")
    planted = members.filter(~lost).withColumns({
        "geography_level": F.when(F.col("geography_level") == "PENINSULA", "ISLAND").otherwise(
            F.col("geography_level")),
        "country_code": F.when(F.col("geography_name") != "NATION_4", F.col("country_code")).otherwise(
            F.lit(None))})
    return quality.dim_geography_checks(planted)


def _planted_five(t):
    """The five-minute fact with one repeated hour, one bad level and one shifted instant."""
    fact = facts.country_5min(t)
    repeated = fact.filter(F.hour("gold_timestamp") == 7)
    return fact.unionByName(repeated).withColumns({
        "geography_key": F.when(F.hour("gold_timestamp") == 9, F.lit("PROVINCE|1")).otherwise(
            F.col("geography_key")),
        "gold_timestamp": F.when(
            F.hour("gold_timestamp") == 11, F.col("gold_timestamp") + F.make_dt_interval(
                F.lit(0), F.lit(0), F.lit(1))).otherwise(F.col("gold_timestamp"))})


_SQL_FIVE = f"""
    WITH {facts._SQL_POWER}, fact AS (SELECT tick, geography_key FROM power GROUP BY tick, geography_key),
    planted AS (
        SELECT CASE WHEN hour(tick) = 11 THEN tick + INTERVAL 1 MINUTE ELSE tick END AS gold_timestamp,
               CASE WHEN hour(tick) = 9 THEN 'PROVINCE|1' ELSE geography_key END AS geography_key
        FROM (SELECT * FROM fact UNION ALL SELECT * FROM fact WHERE hour(tick) = 7))"""
_FIVE = "gold_fact_country_5min"
_SQL_FIVE_DUPLICATES = _verdict(
    "duplicate_key", _FIVE, "ERROR", "sum(n)", _bad("n > 1"),
    "(SELECT count(*) AS n FROM planted GROUP BY geography_key, gold_timestamp)")


@query("gold_keys", f"""{_SQL_FIVE}
    {_verdict('null_key', _FIVE, 'ERROR', 'count(*)', '0', 'planted')} UNION ALL {_SQL_FIVE_DUPLICATES}""")
def gold_keys(t):
    keys = catalog.GOLD_TABLES[_FIVE].keys
    fact = _planted_five(t)
    return quality.row_checks(fact, _FIVE, {"null_key": quality.null_key(keys)}).unionByName(
        quality.duplicate_keys(fact, keys, _FIVE))


@query("load_gate", f"""{_SQL_FIVE} SELECT * FROM (
    {_verdict('geography_level', _FIVE, 'ERROR', 'count(*)', _bad("geography_key LIKE 'PROVINCE%'"), 'planted')} UNION ALL
    {_verdict('grid', _FIVE, 'ERROR', 'count(*)', _bad('minute(gold_timestamp) % 5 <> 0'), 'planted')} UNION ALL
    {_SQL_FIVE_DUPLICATES}) WHERE n_bad > 0""")
def load_gate(t):
    from meseta.plans.load import gold_checks

    return quality.failures(gold_checks({_FIVE: _planted_five(t)}))


@query("dim_reference_check", f"""
    WITH {SQL_LOCATED}
    {_verdict('dangling_reference', 'events', 'ERROR', 'count(DISTINCT province_code)',
              "count(DISTINCT province_code) FILTER (WHERE autonomous_community_name = 'ASIA')", 'located')}""")
def dim_reference_check(t):
    placed = located(t, t.events.select("user_id"))
    facts_keys = placed.select(F.concat(F.lit("PROVINCE|"), "province_code").alias("geography_key"))
    partial = facts.geography_dimension(t).filter(
        F.coalesce(F.col("autonomous_community_name") != "ASIA", F.lit(True)))
    return quality.dangling_references(facts_keys, partial, ["geography_key"], "events")


@query("idempotent_run", _verdict("idempotent", "dim_time", "ERROR", "count(*)", "0", f"({facts.SQL_DIM_TIME})"))
def idempotent_run(t):
    columns = [c for c in facts.time_dimension(t).columns if c != "gold_created_at"]
    later = gold.dim_time(facts._grain_instants(t), created_at=dt.datetime(2024, 4, 1))
    return quality.same_rows(
        facts.time_dimension(t).select(*columns), later.select(*columns), "dim_time")


@query("row_count_check", _verdict("row_count", "orders", "ERROR", "count(*)", "abs(count(*) - 1000)", "orders"))
def row_count_check(t):
    return quality.row_count_matches(t.orders, 1000, "orders")


# Composite keys -----------------------------------------------------------------------

_LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_returnflag")
_SQL_COMBINATIONS = " UNION ALL ".join(
    f"SELECT '{','.join(names)}' AS columns, {len(names)} AS n_columns, count(*) AS n_rows, "
    f"count(DISTINCT ({', '.join(names)},)) AS n_distinct FROM lineitem"
    for size in (1, 2, 3) for names in combinations(_LINE_COLUMNS, size))


@query("key_combinations", f"""
    WITH c AS ({_SQL_COMBINATIONS}), u AS (SELECT * FROM c WHERE n_distinct = n_rows)
    SELECT * FROM u WHERE NOT EXISTS (
        SELECT 1 FROM u d WHERE d.columns <> u.columns
          AND list_has_all(string_split(u.columns, ','), string_split(d.columns, ',')))""")
def key_combinations(t):
    return quality.minimal_keys(t.lineitem, _LINE_COLUMNS, 3)


@query("composite_dependency", """
    SELECT 'o_custkey_o_orderstatus_to_o_orderpriority' AS "check", 'orders' AS "table", 'ERROR' AS severity,
           count(*) AS n_total, count(*) FILTER (WHERE low <> high) AS n_bad
    FROM (SELECT min(o_orderpriority) AS low, max(o_orderpriority) AS high FROM orders GROUP BY o_custkey, o_orderstatus)""")
def composite_dependency(t):
    return quality.functional_dependency(t.orders, ("o_custkey", "o_orderstatus"), "o_orderpriority", "orders")


# Guards ---------------------------------------------------------------------------------


@query("guard_verdicts", """
    SELECT unnest(['fields', 'missing_field', 'struct', 'flat_column', 'struct_lacks_field', 'struct_elements',
                   'plain_elements', 'same_columns', 'other_order', 'typed_empty']) AS guard,
           unnest([true, false, true, false, false, true, false, true, false, true]) AS passed, n_rows
    FROM (SELECT count(*) AS n_rows FROM events)""")
def guard_verdicts(t):
    """What each guard says about frames of events, with the rows that stand behind the verdict."""
    point = F.struct("event_id", "value")
    frame = t.events.select("event_id", "ts", point.alias("data"), F.array(point).alias("points"), F.array("value").alias("plain"))

    def holds(check) -> bool:
        try:
            check()
        except ValueError:
            return False
        return True

    # value lists whose elements were inferred as text because all of them are empty
    indicator = F.struct(
        F.lit(1).cast("bigint").alias("id"), F.lit("n").alias("name"), F.lit("s").alias("short_name"),
        *[F.array(F.struct(F.lit(1).cast("bigint").alias("id"), F.lit("c").alias("name"))).alias(name)
          for name in ("magnitud", "tiempo")],
        F.array().cast("array<string>").alias("values"), F.lit("2024-02-01T00:00:00Z").alias("values_updated_at"))
    empty = t.events.select(
        F.struct(F.lit("2024-02-01T00:00:00Z").alias("ingestion_timestamp")).alias("metadata"),
        F.struct(indicator.alias("indicator")).alias("data"), F.lit("d").alias("dataset"))
    observed = silver.indicator_observations(empty)
    verdicts = {
        "fields": holds(lambda: guards.require_fields(frame, ["event_id", "data.value", "points.value"])),
        "missing_field": holds(lambda: guards.require_fields(frame, ["data.absent"])),
        "struct": holds(lambda: guards.require_struct(frame, "data", ["value"])),
        "flat_column": holds(lambda: guards.require_struct(frame, "ts", ["value"])),
        "struct_lacks_field": holds(lambda: guards.require_struct(frame, "data", ["absent"])),
        "struct_elements": guards.has_struct_elements(frame, "points"),
        "plain_elements": guards.has_struct_elements(frame, "plain"),
        "same_columns": guards.same_columns(frame, frame.filter("event_id > 0")),
        "other_order": guards.same_columns(frame, frame.select(*reversed(frame.columns))),
        "typed_empty": observed.columns == silver.indicator_observations(
            empty.limit(0)).columns and observed.isEmpty()}
    counted = frame.agg(F.count(F.lit(1)).alias("n_rows"))
    return union_all([
        counted.select(F.lit(name).alias("guard"), F.lit(passed).alias("passed"), "n_rows")
        for name, passed in verdicts.items()])


@query("alias_hygiene", """
    WITH a AS (SELECT n_name AS alias, CASE WHEN n_nationkey % 5 = 0 THEN 'Nowhere ' || n_nationkey ELSE n_name END AS canonical
               FROM (SELECT DISTINCT n_name, n_nationkey FROM customer JOIN nation ON c_nationkey = n_nationkey))
    SELECT 'alias_target' AS "check", 'aliases' AS "table", 'ERROR' AS severity, count(*) AS n_total,
           count(*) FILTER (WHERE canonical LIKE 'Nowhere%') AS n_bad FROM a""")
def alias_hygiene(t):
    """Aliases must lead to a name of the master; some here lead nowhere."""
    nations = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "n_nationkey", "n_name").distinct()
    names = nations.collect()  # settings: an entry for each place of the master
    aliases = {
        f"  {row['n_name'].lower()} ": f"Nowhere {row['n_nationkey']}" if row["n_nationkey"] % 5 == 0 else row["n_name"]
        for row in names}
    master = nations.select(geo.canonical_key(F.col("n_name"), {}).alias("canonical_key"), F.lit(True).alias("_known"))
    known = geo.alias_frame(t.spark, aliases).join(master, "canonical_key", "left")
    return quality.row_checks(known, "aliases", {"alias_target": (quality.ERROR, F.col("_known").isNull())})
