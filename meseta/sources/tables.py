"""Catalog tables: creation, probes, introspection and replaceable storage."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import partitioning
from pyspark.sql.types import StructType

from meseta.catalog import TableSpec
from meseta.operators.clean import PARTITION_TRANSFORMS
from meseta.sources.snapshots import SnapshotTable, is_snapshot_table

# Providers with partition transforms and MERGE of their own.
TRANSACTIONAL = frozenset({"iceberg", "delta"})


def create_namespace(spark: SparkSession, namespace: str) -> None:
    if not namespace.strip():
        raise ValueError("The namespace cannot be blank.")
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace.strip()}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def require_table(spark: SparkSession, name: str) -> None:
    if not table_exists(spark, name):
        raise ValueError(f"Required table does not exist: {name}")


def partition_value(spec: TableSpec) -> Column | None:
    """Expression of the physical partition column, a function of the natural key."""
    if spec.partition is None:
        return None
    kind, column = spec.partition
    return PARTITION_TRANSFORMS[kind](F.col(column)) if kind in PARTITION_TRANSFORMS else F.col(column)


def with_partition(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add the physical partition column that formats without transforms need.

    Its comment names what it is derived from, for readers that filter by the source column.
    """
    value = partition_value(spec)
    if value is None or spec.partition_column in df.columns:
        return df
    kind, column = spec.partition
    return df.withColumn(spec.partition_column, value).withMetadata(
        spec.partition_column, {"comment": f"{kind}({column})"})


def create_table(
    spark: SparkSession,
    df: DataFrame,
    spec: TableSpec,
    *,
    namespace: str | None = None,
    provider: str = "parquet",
    location: str | None = None,
) -> bool:
    """Create an empty table with the schema of ``df``; an existing one is untouched.

    Formats without transactions of their own become tables with snapshots.
    """
    name = f"{namespace}.{spec.name}" if namespace else spec.name
    if table_exists(spark, name):
        return False
    if provider in TRANSACTIONAL:
        writer = df.limit(0).writeTo(name).using(provider)
        if spec.partition:
            kind, column = spec.partition
            transform = {"days": partitioning.days, "months": partitioning.months}.get(kind, F.col)
            writer = writer.partitionedBy(transform(column))
        writer.create()
        return True
    SnapshotTable.create(
        spark, name, with_partition(df, spec).schema, keys=spec.keys, buckets=spec.buckets, location=location,
        provider=provider, partition_column=spec.partition_column if spec.partition else None)
    return True


def drop_table(spark: SparkSession, name: str) -> None:
    if is_snapshot_table(spark, name):
        SnapshotTable(spark, name).drop()
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def physical_name(spark: SparkSession, name: str) -> str:
    """The table whose files are read: the current snapshot of a table that has them."""
    return SnapshotTable(spark, name).snapshot if is_snapshot_table(spark, name) else name


def _description(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}")


def provider_of(spark: SparkSession, name: str) -> str:
    rows = _description(spark, physical_name(spark, name)).filter("col_name = 'Provider'").take(1)
    return rows[0]["data_type"].lower() if rows else "unknown"


def describe_layout(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """One row per table: exists, provider, location, columns, partition columns."""
    rows = []
    for name in names:
        if not table_exists(spark, name):
            rows.append((name, False, None, None, [], []))
            continue
        physical = physical_name(spark, name)
        properties = {
            row["col_name"]: row["data_type"]
            for row in _description(spark, physical).filter("col_name IN ('Provider','Location')").collect()
        }
        columns = spark.catalog.listColumns(physical)
        rows.append((
            name, True, properties.get("Provider"), properties.get("Location"),
            [column.name for column in columns],
            [column.name for column in columns if column.isPartition],
        ))
    return spark.createDataFrame(
        rows,
        "table_name string, table_exists boolean, provider string, location string, "
        "columns array<string>, partition_columns array<string>",
    )


def missing_tables(spark: SparkSession, names: Iterable[str], namespace: str) -> list[str]:
    present = {table.name for table in spark.catalog.listTables(namespace)}
    return sorted(name for name in names if name not in present)


class PathStore:
    """A Parquet directory as an upsert target; its partitions are replaced one by one.

    The schema is given, so that partition values keep their type and an
    interrupted first load cannot be mistaken for another schema.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, partition_column: str | None = None
    ):
        self.spark, self.path, self.schema = spark, path, schema
        self.partition_column = partition_column

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def like(self, rows: DataFrame) -> DataFrame:
        """Stored rows of the partitions that occur in ``rows``; none before the first write."""
        try:
            stored = self.read()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)
        if not self.partition_column:
            return stored
        occurring = [row[0] for row in rows.select(self.partition_column).distinct().collect()]
        same = F.col(self.partition_column).isin([value for value in occurring if value is not None])
        return stored.where(same | F.col(self.partition_column).isNull() if None in occurring else same)

    def append(self, df: DataFrame) -> None:
        """Add rows as new files of their partitions."""
        writer = df.hint("rebalance", *([self.partition_column] if self.partition_column else [])).write.mode("append")
        (writer.partitionBy(self.partition_column) if self.partition_column else writer).parquet(self.path)

    def replace(self, df: DataFrame) -> None:
        """Overwrite the partitions that occur in ``df`` (everything if unpartitioned)."""
        writer = df.write.mode("overwrite")
        if self.partition_column:
            writer = writer.option("partitionOverwriteMode", "dynamic")
            writer = writer.partitionBy(self.partition_column)
        writer.parquet(self.path)


class TableStore:
    """A catalog table of a plain file format, made elsewhere, as an upsert target."""

    def __init__(self, spark: SparkSession, name: str, partition_column: str | None = None):
        require_table(spark, name)
        self.spark, self.name, self.partition_column = spark, name, partition_column

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def replace(self, df: DataFrame) -> None:
        (
            df.select(*self.read().columns)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic" if self.partition_column else "static")
            .insertInto(self.name)
        )
