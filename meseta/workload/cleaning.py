"""Queries: text and coordinate functions, payload flattening, keys, landing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from meseta import schemas
from meseta.functions import (
    blank_to_null,
    decimal_comma,
    dms_is_valid,
    dms_to_degrees,
    instant,
    plain_name,
)
from meseta.operators import clean
from meseta.plans import silver
from meseta.session import scratch_path
from meseta.sources.bronze import Bronze, file_time
from meseta.sources.landing import land_envelopes, land_text
from meseta.workload.derived import BLOCK, iso, metric
from meseta.workload.registry import query, r4, sql_r4

_LANDED_AT = dt.datetime(2024, 2, 1, 6, 30, tzinfo=dt.timezone.utc)


@query("dedup_latest", """
    SELECT user_id, event_type, day, event_id, ts, value FROM (
        SELECT user_id, event_type, CAST(ts AS DATE) AS day, event_id, ts, value,
               row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
                                  ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) WHERE rn = 1""")
def dedup_latest(t):
    rows = t.events.select(
        "user_id", "event_type", F.to_date("ts").alias("day"), "event_id", "ts", "value")
    return clean.latest_by_key(rows, ["user_id", "event_type", "day"], ["ts", "event_id"])


def _places(t):
    """Nation and region of every customer: the masters as repeated deliveries."""
    return t.customer.select("c_nationkey").join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    ).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))


@query("dedup_master", """
    SELECT DISTINCT r.r_regionkey AS community_code, r.r_name AS community_name
    FROM customer JOIN nation n ON c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""")
def dedup_master(t):
    pairs = _places(t).select(
        F.col("r_regionkey").alias("community_code"), F.col("r_name").alias("community_name"))
    return clean.distinct_by_key(pairs, ["community_code"])


@query("decimal_comma", """
    SELECT l_returnflag, count(*) AS n,
           count(*) FILTER (WHERE l_returnflag = 'R') AS n_null,
           max(CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END) AS highest,
           min(CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END) AS lowest
    FROM lineitem GROUP BY l_returnflag""")
def decimal_comma_text(t):
    text = F.when(F.col("l_returnflag") == "R", "Ip").otherwise(
        F.replace(F.col("l_extendedprice").cast("string"), F.lit("."), F.lit(",")))
    number = decimal_comma(text)
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(number.isNull()).alias("n_null"),
        F.max(number).alias("highest"), F.min(number).alias("lowest"))


@query("blank_to_null", """
    SELECT nullif(trim(substr(o_orderpriority, 9)), '') AS tail, count(*) AS n
    FROM orders GROUP BY 1""")
def blank_tail(t):
    tail = blank_to_null(F.expr("substr(o_orderpriority, 9)"))
    return t.orders.groupBy(tail.alias("tail")).agg(F.count(F.lit(1)).alias("n"))


@query("normalize_name", """
    SELECT upper(trim(strip_accents(concat('  ', replace(replace(source, 's', 'š'), 'c', 'ç'), '-', replace(lang, 'e', 'é'), ' ')))) AS place,
           count(*) AS n FROM documents GROUP BY 1""")
def normalize_name(t):
    accented = F.concat(
        F.lit("  "), F.translate("source", "sc", "šç"), F.lit("-"), F.translate("lang", "e", "é"),
        F.lit(" "))
    return t.documents.groupBy(plain_name(accented).alias("place")).agg(F.count(F.lit(1)).alias("n"))


def _dms(key):
    """DDMMSSH text from a running number; some minutes and seconds are out of range."""
    return F.concat(
        F.lpad((key % 90).cast("string"), 2, "0"), F.lpad((key % 70).cast("string"), 2, "0"),
        F.lpad((key * 7 % 63).cast("string"), 2, "0"),
        F.element_at(F.array(F.lit("N"), F.lit("S"), F.lit("E"), F.lit("W")), (key % 4 + 1).cast("int")))


_SQL_DMS_SHAPE = "c_custkey % 70 < 60 AND c_custkey * 7 % 63 <= 60"
# a latitude is north or south, a longitude east or west; neither reads the other's text
_SQL_DMS_LATITUDE = f"({_SQL_DMS_SHAPE} AND c_custkey % 4 IN (0, 1))"
_SQL_DMS_LONGITUDE = f"({_SQL_DMS_SHAPE} AND c_custkey % 4 IN (2, 3))"
_SQL_DMS = (
    "(c_custkey % 90 + (c_custkey % 70) / 60.0 + (c_custkey * 7 % 63) / 3600.0)"
    " * CASE WHEN c_custkey % 4 IN (1, 3) THEN -1 ELSE 1 END"
)


@query("dms_to_decimal", f"""
    SELECT c_custkey, {_SQL_DMS_LATITUDE} AS valid_latitude, {_SQL_DMS_LONGITUDE} AS valid_longitude,
           CASE WHEN {_SQL_DMS_LATITUDE} THEN {sql_r4(_SQL_DMS)} END AS latitude,
           CASE WHEN {_SQL_DMS_LONGITUDE} THEN {sql_r4(_SQL_DMS)} END AS longitude
    FROM customer""")
def dms_to_decimal(t):
    text = _dms(F.col("c_custkey"))
    return t.customer.select(
        "c_custkey", *[dms_is_valid(text, axis).alias(f"valid_{axis}") for axis in ("latitude", "longitude")],
        *[r4(dms_to_degrees(text, axis)).alias(axis) for axis in ("latitude", "longitude")])


@query("arrays_zip_explode", "SELECT event_id, user_id, ts, event_type, value FROM events")
def arrays_zip_explode(t):
    points = F.array_sort(F.collect_list(F.struct("event_id", "ts", "event_type", "value")))
    payloads = t.events.groupBy(
        "user_id", F.floor(F.col("event_id") / BLOCK).alias("block")).agg(points.alias("points"))
    names = ["event_id", "ts", "event_type", "value"]
    return clean.explode_parallel(
        payloads, {"user_id": F.col("user_id")}, {name: F.col(f"points.{name}") for name in names})


@query("envelope_flatten", "SELECT conv_id, turn, role, text FROM conversations")
def envelope_flatten(t):
    block = F.floor(F.col("turn") / BLOCK).alias("block")
    envelopes = t.conversations.groupBy("conv_id", block).agg(
        F.collect_list(F.struct("conv_id", "turn", "role", "text")).alias("data")
    ).withColumn("metadata", F.struct(F.lit(_LANDED_AT.isoformat()).alias("ingestion_timestamp")))
    return clean.flatten_envelope(envelopes).drop("ingestion_timestamp")


# Fixed pairing of event types with indicator ids and classes.
_INDICATORS = {"click": 1159, "view": 1161, "purchase": 1293, "signup": 2038, "error": 1475}
_CLASSES = {"click": (13, 4), "view": (13, 4), "purchase": (20, 219), "signup": (20, 219), "error": (20, 2)}


def _by_type(values):
    pairs = []
    for name, value in values.items():
        pairs += [F.lit(name), F.lit(value).cast("bigint")]
    return F.create_map(*pairs)[F.col("event_type")]


def indicator_envelopes(t):
    """Events as indicator payloads of bounded size."""
    point = F.struct(
        iso(F.col("ts")).alias("datetime"), iso(F.col("ts")).alias("datetime_utc"),
        iso(F.col("ts")).alias("tz_time"), F.col("user_id").alias("geo_id"),
        F.concat(F.lit("User "), F.col("user_id")).alias("geo_name"), "value")
    grouped = t.events.groupBy(
        "event_type", F.floor(F.col("event_id") / BLOCK).alias("block")
    ).agg(F.collect_list(point).alias("values"))
    kind = lambda i: F.array(F.struct(
        _by_type({k: v[i] for k, v in _CLASSES.items()}).alias("id"), F.lit("class").alias("name")))
    indicator = F.struct(
        _by_type(_INDICATORS).alias("id"), F.col("event_type").alias("name"),
        F.col("event_type").alias("short_name"), kind(0).alias("magnitud"), kind(1).alias("tiempo"),
        "values", F.lit("2024-02-01T00:00:00Z").alias("values_updated_at"))
    return grouped.select(
        F.struct(F.lit(_LANDED_AT.isoformat()).alias("ingestion_timestamp")).alias("metadata"),
        F.struct(indicator.alias("indicator")).alias("data"), F.col("event_type").alias("dataset"))


def _sql_case(values):
    whens = " ".join(f"WHEN '{name}' THEN {value}" for name, value in values.items())
    return f"CAST(CASE event_type {whens} END AS BIGINT)"


@query("indicator_explode", f"""
    SELECT {_sql_case(_INDICATORS)} AS indicator_id, event_type AS dataset,
           {_sql_case({k: v[0] for k, v in _CLASSES.items()})} AS magnitude_id,
           {_sql_case({k: v[1] for k, v in _CLASSES.items()})} AS time_id,
           ts AS observation_timestamp, user_id AS esios_geo_id,
           concat('User ', user_id) AS esios_geo_name, value
    FROM events""")
def indicator_explode(t):
    return silver.indicator_observations(indicator_envelopes(t)).select(
        "indicator_id", "dataset", "magnitude_id", "time_id", "observation_timestamp",
        "esios_geo_id", "esios_geo_name", "value")


@query("indicator_families", f"""
    SELECT family, count(*) AS n, count(DISTINCT indicator_id) AS n_indicators,
           count(DISTINCT esios_geo_id) AS n_geographies FROM (
        SELECT CASE WHEN event_type IN ('click', 'view') THEN 'energy_hourly'
                    WHEN event_type IN ('purchase', 'signup') THEN 'power_5min'
                    ELSE 'capacity_monthly' END AS family,
               {_sql_case(_INDICATORS)} AS indicator_id, user_id AS esios_geo_id, ts
        FROM events GROUP BY ALL) GROUP BY family""")
def indicator_families(t):
    rows = silver.indicator_observations(indicator_envelopes(t))
    names = ("energy_hourly", "power_5min", "capacity_monthly")
    families = [
        silver.indicator_family(rows, family).withColumn("family", F.lit(name))
        for name, family in zip(names, silver.FAMILIES)
    ]
    return clean.union_all(families).groupBy("family").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("indicator_id").alias("n_indicators"),
        F.countDistinct("esios_geo_id").alias("n_geographies"))


@query("class_filter", """
    SELECT event_id, user_id, value FROM events WHERE event_type = 'click' AND event_id % 2 = 0""")
def class_filter(t):
    parity = F.col("event_id") % 2
    return clean.of_class(t.events, F.col("event_type"), parity, ("click", 0)).select(
        "event_id", "user_id", "value")


@query("traceability_filename", """
    SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN ts END AS ingestion_timestamp FROM events""")
def traceability_filename(t):
    stamp = F.when(F.col("event_id") % 10 != 0, F.date_format("ts", "yyyyMMdd'T'HHmmssSSSSSS'Z'"))
    name = F.concat(
        F.lit("cnig_provinces_"), F.coalesce(stamp, F.lit("undated")), F.lit("_"),
        F.md5(F.col("event_id").cast("string")), F.lit(".csv"))
    return t.events.select("event_id", file_time(name).alias("ingestion_timestamp"))


@query("json_props", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, ts FROM events""")
def json_props(t):
    return t.events.select(
        "event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        instant(iso(F.col("ts"))).alias("ts"))


@query("window_filter", """
    SELECT event_id, ts FROM events
    WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-11 00:00:00'""")
def window_filter(t):
    start = dt.datetime(2024, 1, 10)
    rows = t.events.select("event_id", "ts")
    # typed like the column, so that the bounds reach the Parquet scan
    bounds = [F.lit(d).cast("timestamp_ntz") for d in (start, start + dt.timedelta(days=1))]
    return clean.in_window(rows, "ts", *bounds)


@query("union_by_name", """
    SELECT 'customer' AS holder, c_custkey AS holder_id, c_nationkey AS nation, c_acctbal AS value FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_nationkey, s_acctbal FROM supplier
    UNION ALL SELECT 'order', o_orderkey, NULL, o_totalprice FROM orders""")
def union_by_name(t):
    customers = t.customer.select(
        F.lit("customer").alias("holder"), F.col("c_custkey").alias("holder_id"),
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("value"))
    suppliers = t.supplier.select(
        F.col("s_acctbal").alias("value"), F.col("s_nationkey").alias("nation"),
        F.col("s_suppkey").alias("holder_id"), F.lit("supplier").alias("holder"))
    orders = t.orders.select(
        F.col("o_orderkey").alias("holder_id"), F.lit("order").alias("holder"),
        F.col("o_totalprice").alias("value"), F.lit(None).cast("int").alias("nation"))
    return clean.latest_by_key(clean.union_all([customers, suppliers, orders]), ["holder", "holder_id"])


# Silver transforms on payloads derived from the tables ------------------------------


@query("silver_stations", f"""
    SELECT CAST(c_custkey AS VARCHAR) AS station_id, c_name AS nombre, n.n_name AS provincia,
           c_acctbal AS altitud,
           CASE WHEN {_SQL_DMS_LATITUDE} THEN {sql_r4(_SQL_DMS)} END AS latitude,
           CASE WHEN {_SQL_DMS_LONGITUDE} THEN {sql_r4(_SQL_DMS)} END AS longitude, c_mktsegment AS indsinop, 'aemet' AS source
    FROM customer JOIN nation n ON c_nationkey = n.n_nationkey""")
def silver_stations(t):
    text = _dms(F.col("c_custkey"))
    bronze = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("indicativo"), F.col("c_name").alias("nombre"),
        F.col("n_name").alias("provincia"),
        F.replace(F.col("c_acctbal").cast("string"), F.lit("."), F.lit(",")).alias("altitud"),
        text.alias("latitud"), text.alias("longitud"), F.col("c_mktsegment").alias("indsinop"),
        F.lit("2024-02-01T00:00:00Z").alias("ingestion_timestamp"))
    # every record is delivered twice
    built = silver.stations(bronze.unionByName(bronze))
    return built.select(
        "station_id", "nombre", "provincia", "altitud", r4(F.col("latitude")).alias("latitude"),
        r4(F.col("longitude")).alias("longitude"),
        "indsinop", "source")


@query("silver_daily_climatology", """
    SELECT CAST(user_id AS VARCHAR) AS station_id, CAST(ts AS DATE) AS observation_date,
           max(value) AS tmax, min(value) AS tmin,
           max(CASE WHEN event_type <> 'error' THEN value END) AS prec,
           'aemet' AS source
    FROM events GROUP BY 1, 2""")
def silver_daily_climatology(t):
    from meseta import catalog

    comma = lambda c: F.replace(c.cast("string"), F.lit("."), F.lit(","))
    rained = F.max(F.when(F.col("event_type") != "error", F.col("value")))
    daily = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.max("value").alias("high"), F.min("value").alias("low"), rained.alias("rain"))
    given = {
        "indicativo": F.col("user_id").cast("string"), "fecha": F.col("day").cast("string"),
        "tmax": comma(F.col("high")), "tmin": comma(F.col("low")),
        "prec": F.coalesce(comma(F.col("rain")), F.lit("Ip")),
    }
    blank = F.lit(None).cast("string")
    bronze = daily.select(*[
        given.get(name, blank).alias(name)
        for name in ("indicativo", "fecha", *catalog.DAILY_FIELD_ORDER)
    ])
    return silver.daily_climatology(bronze).select(
        "station_id", "observation_date", "tmax", "tmin", "prec", "source")


@query("silver_current_observations", """
    SELECT CAST(user_id AS VARCHAR) AS station_id, ts AS observation_timestamp,
           CASE WHEN event_type = 'click' THEN value END AS ta,
           CASE WHEN event_type = 'view' THEN value END AS hr, event_type AS ubi, 'aemet' AS source
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS rn FROM events)
    WHERE rn = 1""")
def silver_current_observations(t):
    from meseta import catalog

    given = {
        "idema": F.col("user_id").cast("string"), "fint": iso(F.col("ts")),
        "ta": metric("click"), "hr": metric("view"), "ubi": F.col("event_type"),
    }
    blank = F.lit(None).cast("double")
    # the delivery instant grows with the id, so the latest delivery is the highest id
    delivered = F.timestamp_seconds(F.col("event_id")).alias("ingestion_timestamp")
    bronze = t.events.select(*[
        given.get(name, blank).alias(name)
        for name in ("idema", "fint", "lat", "lon", *catalog.CURRENT_MEASURES)
    ], delivered)
    return silver.current_observations(bronze).select(
        "station_id", "observation_timestamp", "ta", "hr", "ubi", "source")


def weather_payloads(t, size=BLOCK):
    """Events as lists of points, one per user and block of ids."""
    points = F.array_sort(F.collect_list(F.struct("event_id", "ts", "value")))
    return t.events.groupBy(
        "user_id", F.floor(F.col("event_id") / size).alias("block")).agg(points.alias("points"))


def weather_arrays(payloads, *carried):
    """The arrays that the layouts repeat: times as text, values, and values as whole numbers."""
    return payloads.select(
        "user_id", "block", F.transform("points.ts", iso).alias("time"), F.col("points.value").alias("value"),
        F.transform("points.value", lambda v: F.floor(v).cast("bigint")).alias("whole"), *carried)


def weather_envelopes(t, layout, arrays_of=None, *carried):
    """Payloads as parallel arrays, an envelope each; ``carried`` columns stay beside it."""
    from meseta import catalog

    payloads = weather_arrays(weather_payloads(t)) if arrays_of is None else arrays_of
    arrays = {"time": F.col("time")}
    for name in layout.variables:
        arrays[name] = F.col("whole" if name in catalog.INTEGER_VARIABLES else "value")
    series = F.struct(*[column.alias(name) for name, column in arrays.items()])
    return payloads.select(
        F.struct(
            F.lit(600.0).alias("elevation"), F.lit(40.4).alias("latitude"),
            F.lit(-3.7).alias("longitude"), series.alias(layout.container)).alias("data"),
        F.struct(
            F.col("user_id").cast("string").alias(layout.id_field),
            F.concat(F.lit("Point "), F.col("user_id")).alias("station_name"),
            F.lit("MADRID").alias("province"), F.lit("open_meteo").alias("source"),
            F.timestamp_seconds(F.col("block")).cast("string").alias("ingestion_timestamp"),
        ).alias("metadata"), *carried)


def _weather_sql(columns):
    return f"""
    SELECT CAST(user_id AS VARCHAR) AS station_id, ts AS observation_timestamp,
           concat('Point ', user_id) AS station_name, {columns}
    FROM (SELECT DISTINCT user_id, ts, value FROM events)"""


@query("silver_weather_hourly", _weather_sql(
    "value AS temperature_2m, CAST(floor(value) AS BIGINT) AS relative_humidity_2m, "
    "value AS precipitation, CAST(floor(value) AS BIGINT) AS wind_direction_10m"))
def silver_weather_hourly(t):
    return silver.weather_series(weather_envelopes(t, silver.HOURLY), silver.HOURLY).select(
        "station_id", "observation_timestamp", "station_name", "temperature_2m",
        "relative_humidity_2m", "precipitation", "wind_direction_10m")


@query("silver_weather_forecast", _weather_sql(
    "value AS wind_speed_80m, CAST(floor(value) AS BIGINT) AS wind_direction_120m"))
def silver_weather_forecast(t):
    layout = silver.HISTORICAL_FORECAST
    return silver.weather_series(weather_envelopes(t, layout), layout).select(
        "station_id", "observation_timestamp", "station_name", "wind_speed_80m",
        "wind_direction_120m")


@query("silver_weather_15min", _weather_sql(
    "value AS shortwave_radiation, value AS wind_speed_120m, "
    "CAST(floor(value) AS BIGINT) AS wind_direction_80m"))
def silver_weather_15min(t):
    layout = silver.QUARTER_HOURLY
    return silver.weather_series(weather_envelopes(t, layout), layout).select(
        "station_id", "observation_timestamp", "station_name", "shortwave_radiation",
        "wind_speed_120m", "wind_direction_80m")


@query("silver_provinces", """
    SELECT DISTINCT CAST(n_nationkey AS VARCHAR) AS province_code, n_name AS province_name,
           CAST(r_regionkey AS VARCHAR) AS autonomous_community_code, r_name AS autonomous_community_name,
           concat('Capital of ', n_name) AS capital_name, 'cnig' AS source
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def silver_provinces(t):
    return silver.provinces(provinces_csv(t)).drop("ingestion_timestamp")


def provinces_csv(t):
    """The province snapshot, one delivery per customer."""
    return _places(t).select(
        F.col("n_nationkey").cast("string").alias("COD_PROV"), F.col("n_name").alias("PROVINCIA"),
        F.col("r_regionkey").cast("string").alias("COD_CA"),
        F.col("r_name").alias("COMUNIDAD_AUTONOMA"),
        F.concat(F.lit("Capital of "), F.col("n_name")).alias("CAPITAL"))


@query("silver_communities", """
    SELECT DISTINCT CAST(r_regionkey AS VARCHAR) AS autonomous_community_code,
           r_name AS autonomous_community_name, 'cnig' AS source
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def silver_communities(t):
    built = silver.autonomous_communities(silver.provinces(provinces_csv(t)))
    return built.drop("ingestion_timestamp")


@query("silver_municipalities", """
    SELECT lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS municipality_ine_code,
           '00000' AS municipality_code, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS province_code,
           c_name AS municipality_name, c_custkey * 3 AS municipality_population,
           c_acctbal AS surface_area, -c_acctbal AS longitude, 'cnig' AS source
    FROM customer""")
def silver_municipalities(t):
    comma = lambda c: F.replace(c.cast("string"), F.lit("."), F.lit(","))
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    given = {
        "COD_INE": F.lpad(key, 11, "0"), "COD_GEO": F.lit("00000"), "COD_PROV": F.lpad(nation, 2, "0"),
        "NOMBRE_ACTUAL": F.col("c_name"), "POBLACION_MUNI": (F.col("c_custkey") * 3).cast("string"),
        "SUPERFICIE": comma(F.col("c_acctbal")), "LONGITUD_ETRS89_REGCAN95": comma(-F.col("c_acctbal")),
    }
    blank = F.lit(None).cast("string")
    bronze = t.customer.select(*[
        given.get(name, blank).alias(name) for name in schemas.MUNICIPALITIES_CSV.fieldNames()])
    return silver.municipalities(bronze).select(
        "municipality_ine_code", "municipality_code", "province_code", "municipality_name",
        "municipality_population", "surface_area", "longitude", "source")


# Landing round trips ---------------------------------------------------------------


@query("landing_envelopes", """
    SELECT event_id, user_id, event_type, value, 'incremental' AS ingestion_mode,
           TIMESTAMP '2024-02-01 06:30:00' AS ingestion_timestamp FROM events""")
def landing_envelopes(t):
    root = scratch_path(t.spark, "landing")
    payload = t.events.select(
        F.struct("event_id", "user_id", "event_type", "value").alias("data"), "event_type")
    land_envelopes(
        payload, root, source="shop", dataset="events", ingestion_mode="incremental",
        ingested_at=_LANDED_AT, extra_metadata={"kind": F.col("event_type")})
    schema = schemas.envelope(payload.schema["data"].dataType)
    landed = Bronze(
        t.spark, root, (dt.date(2024, 2, 1), dt.date(2024, 2, 2)), multiline=False)
    return landed.json(schema, "shop", "events").select(
        "data.*", "metadata.ingestion_mode",
        instant(F.col("metadata.ingestion_timestamp")).alias("ingestion_timestamp"))


@query("landing_text", "SELECT html FROM pages")
def landing_text(t):
    root = scratch_path(t.spark, "landing")
    land_text(t.pages, root, source="shop", dataset="pages", ingested_at=_LANDED_AT, text="html")
    landed = Bronze(t.spark, root, (dt.date(2024, 2, 1), dt.date(2024, 2, 2)))
    return landed.text("shop", "pages", packed=True).select(F.col("value").alias("html"))


@query("landing_csv", """
    SELECT DISTINCT CAST(n_nationkey AS VARCHAR) AS province_code, concat('Ávila – León 5 € ', n_name) AS province_name,
           TIMESTAMP '2024-02-01 06:30:00.123456' AS ingestion_timestamp
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def landing_csv(t):
    root = scratch_path(t.spark, "landing")
    # the euro sign and the dash as the bytes that Windows-1252 has for them
    rows = provinces_csv(t).withColumn("PROVINCIA", F.concat(F.lit("Ávila \x96 León 5 \x80 "), "PROVINCIA"))
    # the snapshot's file name cannot be chosen on write; its folder carries the stamp
    folder = f"{root}/cnig/provinces"
    rows.write.options(header=True, sep=";", encoding="iso-8859-1").csv(folder)
    frame = Bronze(t.spark, root).csv(schemas.PROVINCES_CSV, "cnig", "provinces")
    stamped = frame.withColumn(
        "ingestion_timestamp", file_time(F.lit("cnig_provinces_20240201T063000123456Z_0.csv")))
    return silver.provinces(stamped).select("province_code", "province_name", "ingestion_timestamp")
