"""Queries: whole loads, from a landing zone derived from the tables to Silver and Gold read back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meseta import catalog, schemas
from meseta.functions import floor_grain
from meseta.operators import quality
from meseta.operators.clean import union_all
from meseta.plans import load, silver
from meseta.session import scratch_path, stage
from meseta.sources import tables
from meseta.sources.bronze import Bronze
from meseta.sources.landing import land_envelopes, land_snapshot
from meseta.workload.cleaning import _dms, provinces_csv, weather_arrays, weather_envelopes, weather_payloads
from meseta.workload.derived import BLOCK, iso, metric
from meseta.workload.registry import query

LANDED = dt.datetime(2024, 2, 1, 6, 30, 0, 123456, tzinfo=dt.timezone.utc)
_DAY = (LANDED.date(), LANDED.date() + dt.timedelta(days=1))
_ENERGY, _POWER, _CAPACITY = (
    list(datasets.values()) for datasets in (
        catalog.HOURLY_ENERGY_DATASETS, catalog.FIVE_MINUTE_POWER_DATASETS, catalog.MONTHLY_CAPACITY_DATASETS))


_SERIES_BLOCK = 20 * BLOCK  # ids, each in one of the datasets of a family, or of one of many users
_FILE_POINTS = 100_000  # objects of a landed file, or the records in them where those are many


class Landing:
    """A landing zone below a folder of its own."""

    def __init__(self, t):
        self.t, self.root = t, scratch_path(t.spark, "landing")
        self.bronze = Bronze(t.spark, self.root, _DAY, multiline=False)

    def _places(self) -> DataFrame:
        return self.t.customer.join(self.t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("user_id"), F.col("n_name").alias("province"))

    def _records(self, rows: DataFrame, key: str, dataset: str, schema) -> None:
        """Arrays of records of bounded size, with every field of the schema."""
        fields = schema["data"].dataType.elementType
        record = F.struct(*[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
        payload = rows.groupBy(F.floor(F.col(key) / BLOCK).alias("block")).agg(F.collect_list(record).alias("data"))
        land_envelopes(
            payload, self.root, source="aemet", dataset=dataset, ingestion_mode="incremental", ingested_at=LANDED,
            packed=_FILE_POINTS // BLOCK)

    def masters(self) -> Landing:
        land_snapshot(provinces_csv(self.t).distinct(), self.root, source="cnig", dataset="provinces", ingested_at=LANDED)
        comma = lambda c: F.replace(c.cast("string"), F.lit("."), F.lit(","))
        given = {
            "COD_INE": F.lpad(F.col("c_custkey").cast("string"), 11, "0"), "COD_GEO": F.lit("00000"),
            "COD_PROV": F.col("c_nationkey").cast("string"), "NOMBRE_ACTUAL": F.col("c_name"),
            "POBLACION_MUNI": (F.col("c_custkey") * 3).cast("string"), "SUPERFICIE": comma(F.col("c_acctbal"))}
        rows = self.t.customer.select(*[
            given.get(name, F.lit(None).cast("string")).alias(name) for name in schemas.MUNICIPALITIES_CSV.fieldNames()])
        land_snapshot(rows, self.root, source="cnig", dataset="municipalities", ingested_at=LANDED)
        return self

    def aemet(self, *datasets: str) -> Landing:
        """``datasets`` limits them to some of stations, daily and current."""
        for dataset in datasets or ("stations", "daily", "current"):
            getattr(self, f"_{dataset}")()
        return self

    def _stations(self) -> None:
        t, comma = self.t, lambda c: F.replace(c.cast("string"), F.lit("."), F.lit(","))
        text = _dms(F.col("c_custkey"))
        stations = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            "c_custkey", F.col("c_custkey").cast("string").alias("indicativo"), F.col("c_name").alias("nombre"),
            F.col("n_name").alias("provincia"), comma(F.col("c_acctbal")).alias("altitud"), text.alias("latitud"),
            text.alias("longitud"), F.col("c_mktsegment").alias("indsinop"))
        self._records(stations, "c_custkey", "stations", schemas.STATIONS)

    def _daily(self) -> None:
        t, comma = self.t, lambda c: F.replace(c.cast("string"), F.lit("."), F.lit(","))
        daily = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
            F.max("value").alias("high"), F.min("value").alias("low"), F.min("event_id").alias("event_id")).join(
            self._places(), "user_id").select(
            "event_id", F.col("user_id").cast("string").alias("indicativo"), F.col("day").cast("string").alias("fecha"),
            F.col("province").alias("provincia"), comma(F.col("high")).alias("tmax"), comma(F.col("low")).alias("tmin"),
            F.lit("Ip").alias("prec"))
        self._records(daily, "event_id", "daily_climatological_values", schemas.DAILY_CLIMATOLOGY)

    def _current(self) -> None:
        current = self.t.events.select(
            "event_id", F.col("user_id").cast("string").alias("idema"), iso(F.col("ts")).alias("fint"),
            metric("click").alias("ta"), metric("view").alias("hr"), F.col("event_type").alias("ubi"))
        self._records(current, "event_id", "current_observations", schemas.CURRENT_OBSERVATIONS)

    def weather(self) -> Landing:
        # points and places meet once, before each layout repeats the points in all of its arrays; small files of
        # points become large ones of text, so all tasks get some
        payloads = weather_payloads(self.t, _SERIES_BLOCK).join(self._places(), "user_id")
        payloads = stage(weather_arrays(payloads.repartition("user_id", "block"), "province"), "weather-payloads")
        for layout, dataset in ((silver.HOURLY, "weather_hourly"), (silver.QUARTER_HOURLY, "weather_15min"),
                                (silver.HISTORICAL_FORECAST, "weather_historical_forecast")):
            rows = weather_envelopes(self.t, layout, payloads, "province").select(
                "data", F.col(f"metadata.{layout.id_field}").alias("_id"), F.col("metadata.station_name").alias("_name"),
                "province")
            land_envelopes(
                rows, self.root, source="open_meteo", dataset=dataset, ingestion_mode="incremental", ingested_at=LANDED,
                packed=max(1, _FILE_POINTS * BLOCK // _SERIES_BLOCK),
                extra_metadata={layout.id_field: F.col("_id"), "station_name": F.col("_name"), "province": F.col("province")})
        return self

    def indicators(self, *families: str, power_minutes: str | None = None) -> Landing:
        """Each event in one of the 35 datasets, by its id; provinces, Spain or communities as places.

        ``families`` limits them to some of energy, power and capacity. Power is landed at
        the instants of the events, or with ``power_minutes`` once in each of such intervals,
        as the facts of national power expect it.
        """
        power_at = floor_grain(F.col("ts"), power_minutes) if power_minutes else F.col("ts")
        located = self.t.events.join(self._places(), "user_id").join(
            self.t.nation.select(F.col("n_name").alias("province"), "n_nationkey", "n_regionkey"), "province").join(
            self.t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            "event_id", "ts", "value", "n_nationkey", "province", "n_regionkey", "r_name")
        if len(families) != 1:  # places are looked up once for all families
            located = stage(located, "located-events")
        layouts = {
            "energy": (catalog.HOURLY_ENERGY_DATASETS, catalog.ENERGY_BY_HOUR, F.date_trunc("hour", "ts"),
                       F.col("n_nationkey"), F.col("province")),
            "power": (catalog.FIVE_MINUTE_POWER_DATASETS, catalog.POWER_BY_FIVE_MINUTES, power_at,
                      F.lit(catalog.SPAIN_GEO_ID), F.lit("España")),
            "capacity": (catalog.MONTHLY_CAPACITY_DATASETS, catalog.CAPACITY_BY_MONTH, F.date_trunc("month", "ts"),
                         F.col("n_regionkey") + 100, F.col("r_name"))}
        for datasets, (magnitude, time), at, geo, name in (layouts[family] for family in families or layouts):
            series = located.withColumn("number", F.pmod("event_id", F.lit(len(datasets)))).select(
                "number", "event_id", "value", iso(at).alias("at"), geo.cast("bigint").alias("geo"), name.alias("name"))
            point = F.struct(
                F.col("at").alias("datetime"), F.col("at").alias("datetime_utc"), F.col("at").alias("tz_time"),
                F.col("geo").alias("geo_id"), F.col("name").alias("geo_name"), "value")
            classes = [F.array(F.struct(F.lit(c).cast("bigint").alias("id"), F.lit("class").alias("name"))) for c in (magnitude, time)]
            # a point takes the block of its first event, which has no other point: blocks bound the lists
            values = series.groupBy("number", "at", "geo", "name").agg(
                F.max("value").alias("value"), F.min("event_id").alias("event_id")).groupBy(
                "number", F.floor(F.col("event_id") / _SERIES_BLOCK).alias("block")).agg(F.collect_list(point).alias("values"))
            values = stage(values, "indicator-values")
            for number, (key, dataset) in enumerate(datasets.items()):
                indicator = F.struct(
                    F.lit(key).cast("bigint").alias("id"), F.lit(dataset).alias("name"), F.lit(dataset).alias("short_name"),
                    classes[0].alias("magnitud"), classes[1].alias("tiempo"), F.lit("2024-02-01T00:00:00Z").alias("values_updated_at"), "values")
                land_envelopes(
                    values.where(F.col("number") == number).select(F.struct(indicator.alias("indicator")).alias("data")),
                    self.root, source="esios", dataset=dataset, ingestion_mode="incremental", ingested_at=LANDED,
                    packed=_FILE_POINTS * len(datasets) // _SERIES_BLOCK)
        return self


_PARTS = ("masters", "aemet", "weather", "indicators")
_landed: dict[tuple[str, str], tuple[Landing, set[str]]] = {}
_loaded: dict[tuple[str, str], str] = {}


def whole_landing(t, *parts: str) -> Landing:
    """The landing zone of a folder's tables, complete or with the named parts at least.

    It never changes, so queries of a session share it; each part is landed for the first
    query that reads it.
    """
    key = t.spark.sparkContext.applicationId, t.folder
    landing, done = _landed.get(key) or (Landing(t), set())
    for part in parts or _PARTS:
        if part not in done:
            _landed.pop(key, None)  # a part that fails half way is not read by anyone
            getattr(landing, part)()
            done.add(part)
    _landed[key] = landing, done
    return landing


def loaded_silver(t) -> str:
    """A namespace with all Silver tables of the landing zone, loaded once in a session."""
    key = t.spark.sparkContext.applicationId, t.folder
    if key not in _loaded:
        namespace = _namespace()
        load.load_silver(t.spark, whole_landing(t).bronze, namespace)
        _loaded[key] = namespace
    return _loaded[key]


def _counted(t, namespace: str, names) -> DataFrame:
    """Rows and distinct keys of the stored tables."""
    counts = None
    for name in sorted(names):
        keys = (catalog.SILVER_TABLES | catalog.GOLD_TABLES)[name].keys
        one = t.spark.table(f"{namespace}.{name}").agg(
            F.lit(name).alias("table"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct(*keys).alias("n_keys"))
        counts = one if counts is None else counts.unionByName(one)
    return counts


def _namespace() -> str:
    return f"meseta_{uuid.uuid4().hex[:12]}"


# Hours, fives and months of a landed value in SQL; a dataset per remainder of the event's id.
_SQL_LOADED = f"""
    WITH e AS (SELECT e.*, c_nationkey AS place, n_regionkey FROM events e JOIN customer ON user_id = c_custkey
        JOIN nation ON c_nationkey = n_nationkey),
    points AS (SELECT DISTINCT user_id, ts FROM e),
    counted AS (
        SELECT 'silver_aemet_stations' AS "table", count(*) AS n FROM customer
        UNION ALL SELECT 'silver_cnig_municipalities', count(*) FROM customer
        UNION ALL SELECT 'silver_cnig_provinces', count(DISTINCT c_nationkey) FROM customer
        UNION ALL SELECT 'silver_cnig_autonomous_communities', count(DISTINCT n_regionkey)
            FROM customer JOIN nation ON c_nationkey = n_nationkey
        UNION ALL SELECT 'silver_aemet_daily_climatology', count(*) FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) FROM e)
        UNION ALL SELECT 'silver_aemet_current_observations', count(*) FROM (SELECT DISTINCT user_id, ts FROM events)
        UNION ALL SELECT 'silver_open_meteo_hourly', count(*) FROM points
        UNION ALL SELECT 'silver_open_meteo_historical_forecast', count(*) FROM points
        UNION ALL SELECT 'silver_open_meteo_15min', count(*) FROM points
        UNION ALL SELECT 'silver_esios_energy_hourly', count(*) FROM (
            SELECT DISTINCT event_id % {len(_ENERGY)}, date_trunc('hour', ts), place FROM e)
        UNION ALL SELECT 'silver_esios_power_5min', count(*) FROM (SELECT DISTINCT event_id % {len(_POWER)}, ts FROM e)
        UNION ALL SELECT 'silver_esios_installed_capacity_monthly', count(*) FROM (
            SELECT DISTINCT event_id % {len(_CAPACITY)}, date_trunc('month', ts), n_regionkey FROM e))
"""


def _sql_loaded(*tables: str) -> str:
    chosen = ", ".join(f"'{name}'" for name in tables)
    return f"""{_SQL_LOADED}
    SELECT "table", n AS n_rows, n AS n_keys FROM counted WHERE "table" IN ({chosen})"""


@query("load_silver_all", _sql_loaded(*catalog.SILVER_TABLES))
def load_silver_all(t):
    """Every landed source through readers, builders, checks and merges, twice; read back from the tables.

    Landing and tables are its own: what other queries of the session landed or loaded doesn't stand in for them.
    """
    landing, namespace = Landing(t).masters().aemet().weather().indicators(), _namespace()
    for _ in range(2):
        load.load_silver(t.spark, landing.bronze, namespace)
    return _counted(t, namespace, catalog.SILVER_TABLES)


def _moved(t, landing: Landing) -> None:
    """A later province snapshot in which every province belongs to another community."""
    moved = provinces_csv(t).distinct().withColumn("COD_CA", F.concat(F.lit("9"), "COD_CA"))
    land_snapshot(moved, landing.root, source="cnig", dataset="provinces", ingested_at=LANDED + dt.timedelta(hours=1))


def _by_community(t, namespace: str, names, after: str) -> DataFrame:
    moved = F.col("autonomous_community_code").startswith("9")
    counts = None
    for name in sorted(names):
        one = t.spark.table(f"{namespace}.{name}").agg(
            F.lit(after).alias("after"), F.lit(name).alias("table"), F.count(F.lit(1)).alias("n_rows"),
            F.count_if(moved).alias("n_moved"))
        counts = one if counts is None else counts.unionByName(one)
    return counts


_WEATHER_MODE = ("silver_open_meteo_hourly", "silver_open_meteo_historical_forecast", "silver_open_meteo_15min",
                 "silver_aemet_stations", "silver_aemet_daily_climatology")
_ENERGY_MODE = ("silver_esios_energy_hourly",)


@query("load_modes", f"""{_SQL_LOADED}
    SELECT 'geography-fix' AS "after", "table", n AS n_rows,
           CASE WHEN "table" = 'silver_esios_energy_hourly' THEN 0 ELSE n END AS n_moved
    FROM counted WHERE "table" IN ({", ".join(repr(name) for name in (*_WEATHER_MODE, *_ENERGY_MODE))})
    UNION ALL SELECT 'esios-geography-fix', "table", n, n FROM counted WHERE "table" = 'silver_esios_energy_hourly'""")
def load_modes(t):
    """A corrected province master reaches the tables of each mode when that mode is loaded, and no others."""
    landing, namespace = Landing(t).masters().aemet("stations", "daily").weather().indicators("energy"), _namespace()
    placed = {*_WEATHER_MODE, *_ENERGY_MODE}
    load.load_silver(t.spark, landing.bronze, namespace, tables=placed)
    _moved(t, landing)
    load.load_silver(t.spark, landing.bronze, namespace, mode="geography-fix")
    first = stage(_by_community(t, namespace, placed, "geography-fix"), "first")
    load.load_silver(t.spark, landing.bronze, namespace, mode="esios-geography-fix")
    return first.unionByName(_by_community(t, namespace, _ENERGY_MODE, "esios-geography-fix"))


@query("bronze_readers", """
    WITH e AS (SELECT e.*, c_nationkey AS place FROM events e JOIN customer ON user_id = c_custkey)
    SELECT 'stations' AS reader, count(*) AS n FROM customer
    UNION ALL SELECT 'daily_climatology', count(*) FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) FROM e)
    UNION ALL SELECT 'current_observations', count(*) FROM events
    UNION ALL SELECT 'provinces', count(DISTINCT c_nationkey) FROM customer
    UNION ALL SELECT 'municipalities', count(*) FROM customer
    UNION ALL SELECT 'weather_hourly', count(*) FROM e
    UNION ALL SELECT 'weather_historical_forecast', count(*) FROM e
    UNION ALL SELECT 'weather_15min', count(*) FROM e""")
def bronze_readers(t):
    """Records that each reader finds in the landing zone; an instant from the file name where it holds one."""
    bronze = whole_landing(t, "masters", "aemet", "weather").bronze
    points = lambda frame, container: frame.select(F.explode(f"data.{container}.time"))
    stamped = lambda frame: frame.filter(F.col("ingestion_timestamp") == F.lit(LANDED))
    found = {
        "stations": bronze.stations(), "daily_climatology": bronze.daily_climatology(),
        "current_observations": bronze.current_observations(), "provinces": stamped(bronze.provinces()),
        "municipalities": stamped(bronze.municipalities()), "weather_hourly": points(bronze.weather_hourly(), "hourly"),
        "weather_historical_forecast": points(bronze.weather_historical_forecast(), "hourly"),
        "weather_15min": points(bronze.weather_15min(), "minutely_15")}
    counts = [frame.agg(F.lit(name).alias("reader"), F.count(F.lit(1)).alias("n")) for name, frame in found.items()]
    return union_all(counts)


@query("indicator_scan", f"""
    WITH e AS (SELECT e.*, c_nationkey AS place, n_regionkey FROM events e JOIN customer ON user_id = c_custkey
        JOIN nation ON c_nationkey = n_nationkey),
    landed AS (
        SELECT DISTINCT list_value({", ".join(repr(name) for name in _ENERGY)})[event_id % {len(_ENERGY)} + 1] AS dataset,
               date_trunc('hour', ts) AS at, place AS geo FROM e
        UNION ALL SELECT DISTINCT list_value({", ".join(repr(name) for name in _POWER)})[event_id % {len(_POWER)} + 1], ts, 3 FROM e
        UNION ALL SELECT DISTINCT list_value({", ".join(repr(name) for name in _CAPACITY)})[event_id % {len(_CAPACITY)} + 1],
               date_trunc('month', ts), n_regionkey FROM e)
    SELECT dataset, count(*) AS n FROM landed GROUP BY dataset""")
def indicator_scan(t):
    """One scan over the 35 landed indicator datasets, deduplicated once."""
    rows = silver.all_observations(whole_landing(t, "indicators").bronze)
    return rows.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))


_FACTS = ("gold_fact_province_hourly", "gold_fact_installed_capacity_monthly", "gold_fact_country_15min",
          "gold_fact_country_5min")


def _silver_on_grid(t) -> str:
    """The loaded Silver tables with power of their own: one sample of a series in five minutes.

    The shared landing holds power at the instants of the events. Two of them in one step
    stop the facts of national power, as they should.
    """
    shared, namespace = loaded_silver(t), _namespace()
    landing = Landing(t).indicators("power", power_minutes="FIVE_MINUTES")
    load.load_silver(t.spark, landing.bronze, namespace, tables=[silver.POWER_5MIN.table])
    for name in catalog.SILVER_TABLES:
        if name != silver.POWER_5MIN.table:
            t.spark.sql(f"CREATE VIEW {namespace}.{name} AS SELECT * FROM {shared}.{name}")
    return namespace


@query("load_gold_windows", f"""
    SELECT unnest([{", ".join(repr(name) for name in _FACTS)}]) AS "table", true AS has_rows, CAST(0 AS BIGINT) AS n_bad""")
def load_gold_windows(t):
    """Gold in one full load, and again in two windows: the stored facts hold the same rows."""
    namespace, created = _silver_on_grid(t), dt.datetime(2024, 3, 1)

    def clear() -> None:
        for name in catalog.GOLD_TABLES:
            tables.drop_table(t.spark, f"{namespace}.{name}")

    load.load_gold(t.spark, namespace, created_at=created)
    whole = {name: stage(t.spark.table(f"{namespace}.{name}"), name) for name in _FACTS}
    clear()
    # all instants of the facts: months begin before their first event, energy is shifted by an hour
    first, last = t.events.agg(
        F.date_trunc("month", F.min("ts")).cast("timestamp_ntz"), F.max("ts").cast("timestamp_ntz")).first()
    start, end = first - dt.timedelta(days=1), last + dt.timedelta(days=2)
    middle = (start + (end - start) / 2).replace(hour=0, minute=0, second=0, microsecond=0)
    for window in ((start, middle), (middle, end)):
        load.load_gold(t.spark, namespace, created_at=created, window=window)
    verdicts = [
        quality.same_values(
            whole[name], t.spark.table(f"{namespace}.{name}"), catalog.GOLD_TABLES[name].keys, name,
            directions=("wind_direction_80m", "wind_direction_120m"),
        ).select("table", (F.col("n_total") > 0).alias("has_rows"), "n_bad") for name in _FACTS]
    return union_all(verdicts)
