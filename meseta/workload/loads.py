"""Queries: reloads and increments of Silver, and what a province fact cannot hold."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from meseta.operators import quality
from meseta.operators.geo import attach_station_place
from meseta.operators.upsert import upsert
from meseta.plans import silver
from meseta.session import scratch_path
from meseta.sources.bronze import Bronze
from meseta.sources.landing import land_envelopes
from meseta.sources.tables import PathStore
from meseta.workload.cleaning import provinces_csv, weather_envelopes
from meseta.workload.derived import stations
from meseta.workload.registry import query


@query("geography_fix", """
    SELECT CAST(c_custkey AS VARCHAR) AS station_id, CAST(c_nationkey AS VARCHAR) AS province_code,
           n_name AS province_name, TIMESTAMP '2024-02-01 00:00:00' AS ingestion_timestamp
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def geography_fix(t):
    """A store without places, then a rebuild of the same deliveries with them: every row is corrected."""
    placed = stations(t).select("station_id", "province_code", "province_name").withColumn(
        "ingestion_timestamp", F.lit(dt.datetime(2024, 2, 1)).cast("timestamp"))
    store = PathStore(t.spark, scratch_path(t.spark, "places"), placed.schema)
    upsert(store, placed.withColumns({
        name: F.lit(None).cast("string") for name in ("province_code", "province_name")}), ["station_id"])
    upsert(store, placed, ["station_id"], newest_by=["ingestion_timestamp"])
    return store.read()


@query("incremental_silver", """
    SELECT CAST(e.user_id AS VARCHAR) AS station_id, e.ts AS observation_timestamp,
           n.n_name AS province_name, CAST(r.r_regionkey AS VARCHAR) AS autonomous_community_code
    FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY ALL""")
def incremental_silver(t):
    """Weather that landed days after the provinces, loaded by its own landing days only."""
    root = scratch_path(t.spark, "landing")
    provinces_csv(t).distinct().coalesce(1).write.options(header=True, sep=";", encoding="iso-8859-1").csv(
        f"{root}/cnig/provinces/year=2024/month=02/day=01")
    place = stations(t).select(F.col("station_id").alias("_id"), F.col("province_name").alias("province"))
    payloads = weather_envelopes(t, silver.HOURLY)
    rows = payloads.select("data", F.col("metadata.station_id").alias("station_id")).join(
        place, F.col("station_id") == F.col("_id"))
    land_envelopes(
        rows, root, source="open_meteo", dataset="weather_hourly", ingestion_mode="incremental",
        ingested_at=dt.datetime(2024, 2, 9, tzinfo=dt.timezone.utc), extra_metadata={
            "station_id": F.col("station_id"), "station_name": F.col("station_id"), "province": F.col("province")})
    landed = Bronze(t.spark, root, (dt.date(2024, 2, 9), dt.date(2024, 2, 10)), multiline=False)
    built = silver.build_silver(landed, ["silver_open_meteo_hourly"])["silver_open_meteo_hourly"]
    return built.select("station_id", "observation_timestamp", "province_name", "autonomous_community_code")


@query("unplaced_rows", """
    SELECT 'unplaced_observation' AS "check", 'events' AS "table", 'WARNING' AS severity, count(*) AS n_total,
           count(*) FILTER (WHERE c_custkey IS NULL OR c_custkey % 5 = 0) AS n_bad
    FROM events LEFT JOIN customer ON user_id = c_custkey""")
def unplaced_rows(t):
    """Observations whose station has no place are counted before the facts leave them out."""
    known = stations(t).filter(F.col("station_id").cast("bigint") % 5 != 0)
    counts = t.events.groupBy(F.col("user_id").cast("string").alias("station_id")).agg(F.count("*").alias("n"))
    return quality.unplaced(attach_station_place(counts, known, ("province_code",)), "events")
