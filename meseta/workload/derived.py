"""Domain-shaped frames computed from the test tables.

Users stand for stations, customers for the station master, nations for
provinces, regions for communities, event types for indicators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meseta.workload.registry import Tables

# Envelopes built for the queries hold at most this many elements, whatever the
# distribution of users: ids are unique, so a block of ids bounds the group.
BLOCK = 1000

def direction() -> Column:
    return (F.col("value") * 7) % 360


def province_master(t: Tables) -> DataFrame:
    """Nations with their region under the names of the province master."""
    return t.nation.join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    ).select(
        F.col("n_nationkey").cast("string").alias("province_code"),
        F.col("n_name").alias("province_name"),
        F.col("r_regionkey").cast("string").alias("autonomous_community_code"),
        F.col("r_name").alias("autonomous_community_name"),
    )


def located(t: Tables, events: DataFrame) -> DataFrame:
    """Events with nation and region.

    The customer side grows with the data: Spark broadcasts it below its size
    threshold and otherwise shuffles, splitting hot users at run time.
    """
    master = province_master(t)
    places = t.customer.select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").cast("string").alias("province_code")
    ).join(master, "province_code")
    return events.join(places, "user_id")


def stations(t: Tables) -> DataFrame:
    """Customers as a station master with its place."""
    return t.customer.select(
        F.col("c_custkey").cast("string").alias("station_id"),
        F.col("c_nationkey").cast("string").alias("province_code"),
    ).join(province_master(t), "province_code")


def iso(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


def metric(event_type: str) -> Column:
    return F.when(F.col("event_type") == event_type, F.col("value"))


# Oracle counterpart of `located`.
SQL_LOCATED = """
    located AS (
        SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value, e.props,
               CAST(n.n_nationkey AS VARCHAR) AS province_code, n.n_name AS province_name,
               CAST(r.r_regionkey AS VARCHAR) AS autonomous_community_code,
               r.r_name AS autonomous_community_name
        FROM events e JOIN customer c ON e.user_id = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey)
"""
