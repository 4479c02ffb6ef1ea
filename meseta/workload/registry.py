"""Query registry and the table accessor the queries share."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Attribute access to the Parquet tables of one scale."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._opened[name]


def _portable(df: DataFrame) -> DataFrame:
    """Instants as zone-free timestamps, the type the oracle uses."""
    zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned}) if zoned else df


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return _portable(build(Tables(spark, folder)))

        if name in QUERIES:
            raise ValueError(f"Query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


# Four decimals on both sides. Test values have two decimals, so means often lie
# exactly between two results; the nudge keeps summation noise from deciding.
_NUDGE = 1e-7


def r4(column: Column) -> Column:
    return F.round(column + F.lit(_NUDGE), 4) + F.lit(0.0)


def sql_r4(expression: str) -> str:
    return f"(round(({expression}) + 1e-7, 4) + 0.0)"


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: r4(F.col(name)) for name in names})


def angle4(column: Column) -> Column:
    return F.round(column + F.lit(_NUDGE), 4) % F.lit(360.0)


def sql_angle4(expression: str) -> str:
    return f"(round(({expression}) + 1e-7, 4) % 360.0)"


def sql_circular(degrees: str) -> str:
    east, north = f"avg(sin(radians({degrees})))", f"avg(cos(radians({degrees})))"
    return (
        f"CASE WHEN sqrt({east} * {east} + {north} * {north}) >= 1e-9 "
        f"THEN (degrees(atan2({east}, {north})) + 360.0) % 360.0 END"
    )
