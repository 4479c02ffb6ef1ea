"""Queries: tables, upserts, backfills and streams, each read back from storage."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from meseta.catalog import TableSpec
from meseta.operators import quality
from meseta.operators.clean import in_window, union_all
from meseta.operators.upsert import backfill, prepare, stage_source, upsert, upsert_table
from meseta.plans import gold
from meseta.session import scratch_path, stage
from meseta.sources import tables
from meseta.sources.snapshots import SnapshotTable
from meseta.sources.tables import PathStore
from meseta.streaming import incremental
from meseta.workload import facts
from meseta.workload.registry import query, rounded, sql_r4

_ORDER_KEY = ["o_orderkey", "o_orderdate"]
_ORDER_COLUMNS = ["o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice"]


def _orders(t):
    """Orders with their month, which follows from the key."""
    return t.orders.select(*_ORDER_COLUMNS).withColumn(
        "part_month", F.date_format("o_orderdate", "yyyy-MM"))


def _snapshot_table(t, name, schema, **layout):
    return SnapshotTable.create(
        t.spark, f"{_namespace(t)}.{name}", schema, location=scratch_path(t.spark, name), **layout)


def _order_store(t, rows=None):
    store = _snapshot_table(t, "orders", _orders(t).schema, partition_column="part_month")
    store.replace((_orders(t) if rows is None else rows).hint("rebalance", "part_month"))
    return store


@query("upsert_result", """
    SELECT o_orderkey, o_orderdate, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
           strftime(o_orderdate, '%Y-%m') AS part_month FROM orders""")
def upsert_result(t):
    orders = _orders(t)
    late = F.col("o_orderkey") % 20 == 0
    store = _order_store(t, orders.filter(~late))
    changed = orders.filter(F.col("o_orderkey") % 10 == 0).withColumns({
        "o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1})
    upsert(store, changed, _ORDER_KEY)
    return store.read()


@query("backfill_range", """
    SELECT o_orderkey, o_orderdate, o_orderstatus,
           CASE WHEN o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01'
                THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
           strftime(o_orderdate, '%Y-%m') AS part_month FROM orders""")
def backfill_range(t):
    store = _order_store(t)
    recalculated = _orders(t).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    bounds = [F.lit(d).cast("timestamp_ntz") for d in (dt.datetime(1997, 3, 1), dt.datetime(1997, 4, 1))]
    backfill(store, recalculated, _ORDER_KEY, "o_orderdate", *bounds)
    return store.read()


@query("backfill_untouched", """
    SELECT 'changed_outside_range' AS "check", 'orders' AS "table", 'ERROR' AS severity,
           count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1997-03-01' OR o_orderdate >= TIMESTAMP '1997-04-01') AS n_total,
           CAST(0 AS BIGINT) AS n_bad FROM orders""")
def backfill_untouched(t):
    start, end = (F.lit(d).cast("timestamp_ntz") for d in (dt.datetime(1997, 3, 1), dt.datetime(1997, 4, 1)))
    outside = (F.col("o_orderdate") < start) | (F.col("o_orderdate") >= end)
    return quality.changed_outside(_orders(t), backfill_range(t), outside, "orders", by=["part_month"])


@query("upsert_unpartitioned", """
    SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'MERGED' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def upsert_unpartitioned(t):
    rows = t.customer.select("c_custkey", "c_mktsegment")
    store = _snapshot_table(t, "customers", rows.schema)
    upsert(store, rows.filter(F.col("c_custkey") % 6 != 0), ["c_custkey"])
    changed = rows.filter(F.col("c_custkey") % 3 == 0).withColumn("c_mktsegment", F.lit("MERGED"))
    upsert(store, changed, ["c_custkey"])
    return store.read()


@query("upsert_bucketed", """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 50 < 3 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice
    FROM orders""")
def upsert_bucketed(t):
    """A table bucketed and sorted by its key: merges shuffle the incoming rows alone."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    store = _snapshot_table(t, "orders", rows.schema, keys=["o_orderkey"], buckets=8)
    upsert(store, rows.where("o_orderkey % 50 <> 1"), ["o_orderkey"])
    upsert(store, rows.where("o_orderkey % 50 < 3").withColumn("o_totalprice", -F.col("o_totalprice")), ["o_orderkey"])
    return store.read()


@query("upsert_unpublished", """
    SELECT o_orderkey, o_totalprice FROM orders""")
def upsert_unpublished(t):
    """A merge that is written and checked but never published: readers keep the rows they had."""
    store = _order_store(t)
    doubled = _orders(t).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    merge = prepare(store, stage_source(doubled, store, _ORDER_KEY), _ORDER_KEY)
    seen = stage(store.read().select("o_orderkey", "o_totalprice"), "seen")
    merge.abandon()
    return seen


# Catalog tables --------------------------------------------------------------------------


def _namespace(t):
    name = f"meseta_{uuid.uuid4().hex[:12]}"
    tables.create_namespace(t.spark, name)
    return name


@query("table_upsert", """
    SELECT CAST(user_id AS VARCHAR) AS station_id, ts AS observation_timestamp, max(value) AS value,
           CAST(ts AS DATE) AS part_day
    FROM events GROUP BY ALL""")
def table_upsert(t):
    """Create a day-partitioned table from a frame's schema, then upsert two deliveries."""
    spec = TableSpec("observations", ("station_id", "observation_timestamp"), ("days", "observation_timestamp"))
    rows = t.events.groupBy(
        F.col("user_id").cast("string").alias("station_id"), F.col("ts").alias("observation_timestamp")
    ).agg(F.max("value").alias("value"))
    namespace = _namespace(t)
    name = f"{namespace}.{spec.name}"
    location = scratch_path(t.spark, "observations")
    tables.create_table(t.spark, rows, spec, namespace=namespace, location=location)
    tables.create_table(t.spark, rows, spec, namespace=namespace, location=location)
    first = rows.withColumn("value", F.lit(-1.0)).filter(F.hour("observation_timestamp") < 12)
    for delivery in (first, rows):
        upsert_table(
            t.spark, name, tables.with_partition(delivery, spec), spec.keys, spec.partition_column)
    return t.spark.table(name)


@query("table_layout", """
    SELECT 'events_by_day' AS table_name, true AS table_exists, 'parquet' AS provider, 'part_day' AS partitions,
           count(*) AS n_rows FROM events
    UNION ALL SELECT 'orders_by_month', true, 'parquet', 'part_month', count(*) FROM orders
    UNION ALL SELECT 'orders_plain', true, 'parquet', '', count(*) FROM orders
    UNION ALL SELECT 'orders_absent', false, NULL, '', NULL""")
def table_layout(t):
    """Three partition layouts, and a table that is missing."""
    orders = t.orders.select(*_ORDER_COLUMNS)
    layouts = [
        (TableSpec("events_by_day", ("event_id", "ts"), ("days", "ts")), t.events),
        (TableSpec("orders_by_month", tuple(_ORDER_KEY), ("months", "o_orderdate")), orders),
        (TableSpec("orders_plain", tuple(_ORDER_KEY)), orders),
    ]
    namespace = _namespace(t)
    stored = []
    for spec, rows in layouts:
        name = f"{namespace}.{spec.name}"
        tables.create_table(
            t.spark, rows, spec, namespace=namespace, location=scratch_path(t.spark, spec.name))
        upsert_table(
            t.spark, name, tables.with_partition(rows, spec), spec.keys, spec.partition_column)
        stored.append((spec.name, t.spark.table(name).count()))
    counts = t.spark.createDataFrame(stored, "table_name string, n_rows bigint")
    names = [f"{namespace}.{name}" for name in (*dict(stored), "orders_absent")]
    layout = tables.describe_layout(t.spark, names).select(
        F.element_at(F.split("table_name", r"\."), -1).alias("table_name"), "table_exists",
        F.lower("provider").alias("provider"), F.concat_ws(",", "partition_columns").alias("partitions"))
    return layout.join(counts, "table_name", "left")


@query("stored_window", """
    SELECT 'days' AS layout, count(*) AS n FROM events
    WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-12 18:00:00'
    UNION ALL SELECT 'months', count(*) FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-02-10 00:00:00' AND o_orderdate < TIMESTAMP '1997-04-03 00:00:00'""")
def stored_window(t):
    """Windows by instant over tables partitioned by day and by month; the scan lists their partitions only."""
    layouts = [
        (TableSpec("events_by_day", ("event_id", "ts"), ("days", "ts")), t.events.select("event_id", "ts"), "days",
         (dt.datetime(2024, 1, 10, 6), dt.datetime(2024, 1, 12, 18))),
        (TableSpec("orders_by_month", tuple(_ORDER_KEY), ("months", "o_orderdate")), t.orders.select(*_ORDER_KEY), "months",
         (dt.datetime(1997, 2, 10), dt.datetime(1997, 4, 3)))]
    namespace, counts = _namespace(t), []
    for spec, rows, layout, window in layouts:
        name = f"{namespace}.{spec.name}"
        tables.create_table(t.spark, rows, spec, namespace=namespace, location=scratch_path(t.spark, spec.name))
        upsert_table(t.spark, name, tables.with_partition(rows, spec), spec.keys, spec.partition_column)
        bounds = [F.lit(bound).cast("timestamp_ntz") for bound in window]
        counts.append(in_window(t.spark.table(name), spec.partition[1], *bounds).agg(
            F.lit(layout).alias("layout"), F.count(F.lit(1)).alias("n")))
    return union_all(counts)


@query("gold_incremental", f"""
    WITH {facts._SQL_POWER}
    SELECT tick AS gold_timestamp, geography_key, max(CASE WHEN event_type = 'click' THEN mw END) AS real_demand_mw,
           {sql_r4("max(CASE WHEN event_type = 'click' THEN mw END) / 12")} AS real_demand_energy_mwh_5min
    FROM power GROUP BY tick, geography_key""")
def gold_incremental(t):
    """A fact built from half of the data, then completed by merges; keys never repeat."""
    created = dt.datetime(2024, 3, 1)
    power = facts.silver_power(t)
    half = power.filter(F.col("observation_timestamp") < F.lit(dt.datetime(2024, 1, 15)).cast("timestamp"))
    spec = TableSpec(
        "gold_fact_country_5min", ("geography_key", "gold_timestamp"), ("days", "gold_timestamp"))
    complete = tables.with_partition(gold.fact_country_5min(power, created_at=created), spec)
    store = PathStore(
        t.spark, scratch_path(t.spark, "fact"), complete.schema, spec.partition_column)
    upsert(store, tables.with_partition(gold.fact_country_5min(half, created_at=created), spec), spec.keys)
    upsert(store, complete, spec.keys)
    stored = store.read().select(
        "gold_timestamp", "geography_key", "real_demand_mw", "real_demand_energy_mwh_5min")
    return rounded(stored, "real_demand_energy_mwh_5min")


# Streams ---------------------------------------------------------------------------------


def _arrivals(t):
    """Events as a file stream; the glob also matches when the table is a folder of files."""
    return t.spark.readStream.schema(t.events.schema).parquet(f"{t.folder}/events.parquet*")


@query("stream_upsert", """
    SELECT user_id, event_type, day, event_id, value FROM (
        SELECT user_id, event_type, CAST(ts AS DATE) AS day, event_id, value,
               row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY event_id DESC) AS rn
        FROM events) WHERE rn = 1""")
def stream_upsert(t):
    columns = ["user_id", "event_type", "day", "event_id", "value"]

    def daily(batch):
        return batch.withColumn("day", F.to_date("ts")).select(*columns)

    store = PathStore(
        t.spark, scratch_path(t.spark, "stream"), daily(t.events).schema, "day")
    incremental.upsert_stream(
        _arrivals(t), store, ["user_id", "event_type", "day"], ["event_id"],
        scratch_path(t.spark, "progress"), daily,
    ).awaitTermination()
    return store.read().select(*columns)


@query("stream_dedup", "SELECT event_id, user_id, event_type, value FROM events")
def stream_dedup(t):
    """Events delivered again in later batches; each is kept once.

    The newest half comes first, then the older half with the newest half again, whose
    keys are still in state. The last delivery comes when the state is lost, so that its
    repeats are known from the stored rows only.
    """
    folder, progress = scratch_path(t.spark, "arrivals"), scratch_path(t.spark, "progress")
    low, high = t.events.agg(F.min(F.unix_timestamp("ts")), F.max(F.unix_timestamp("ts"))).first()
    newest = F.unix_timestamp("ts") >= F.lit((low + high) // 2)
    store = PathStore(
        t.spark, scratch_path(t.spark, "stream"),
        t.events.select("event_id", "user_id", "event_type", "value", F.to_date("ts").alias("day")).schema, "day")

    def deliver(rows, progress):
        rows.write.mode("append").parquet(folder)
        arrivals = t.spark.readStream.schema(t.events.schema).parquet(folder).select(
            "event_id", "user_id", "event_type", "value", F.to_date("ts").alias("day"))
        incremental.dedup_stream(arrivals, store, ["event_id", "day"], progress).awaitTermination()

    deliver(t.events.filter(newest & (F.col("event_id") % 5 != 0)), progress)
    deliver(t.events.filter(F.col("event_id") % 5 != 0), progress)
    deliver(t.events.filter(F.col("event_id") % 5 == 0), scratch_path(t.spark, "progress"))
    return store.read().drop("day")
