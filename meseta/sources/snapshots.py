"""Tables of plain files whose loads appear all at once.

Folders of rows are written once and never changed. A snapshot is a catalog table that
names the folder of each partition; the table's own name is a view of the current
snapshot. A load writes its partitions to new folders, registers a snapshot of old and
new folders, and replaces the view, which is one catalog operation: a reader sees all of
a load or nothing of it, and a load that dies leaves no trace in what is read.

With ``buckets`` a table is also split by the hash of its key, each bucket a partition of
its own and one bucket file of Spark's. A merge then shuffles the incoming rows only, and
buckets that receive none keep their files.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKET = "part_bucket"
_PROPERTIES = ("snapshot", "location", "provider", "partition", "keys", "buckets", "previous", "managed")
_PREFIX = "snapshots."
_AT_ONCE = 200  # partitions of one ALTER TABLE


def _quoted(names: Sequence[str]) -> str:
    return ", ".join(f"`{name}`" for name in names)


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    """What the view of a snapshot table records; empty for other tables and views.

    Values are stored as hex: Spark redacts plain ones that look like secrets or URLs, as "hourly" does.
    """
    if not spark.catalog.tableExists(name):
        return {}
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {
        row["key"].removeprefix(_PREFIX): bytes.fromhex(row["value"]).decode()
        for row in rows if row["key"].startswith(_PREFIX)}


def is_snapshot_table(spark: SparkSession, name: str) -> bool:
    return "snapshot" in properties(spark, name)


def _delete(spark: SparkSession, folders: Sequence[str]) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@dataclass(frozen=True)
class Load:
    """Partitions written to new folders, not yet part of the table."""

    root: str
    folders: Mapping[str, str]  # partition as in a path, such as part_day=2024-01-01, to its folder
    schema: StructType | None = None  # of the rows written, where they have no buckets


class SnapshotTable:
    """A table of plain files as an upsert target, read through its view."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self._recorded = properties(spark, name)
        if not self._recorded:
            raise ValueError(f"Not a table with snapshots: {name}")
        self.partition_column = self._recorded["partition"] or None
        self.keys = tuple(filter(None, self._recorded["keys"].split(",")))
        self.buckets = int(self._recorded["buckets"])

    @classmethod
    def create(
        cls, spark: SparkSession, name: str, schema: StructType, *, partition_column: str | None = None,
        keys: Sequence[str] = (), buckets: int = 0, location: str | None = None, provider: str = "parquet",
    ) -> SnapshotTable:
        """An empty table. Without a location the rows lie in the warehouse.

        Buckets are cut by the whole key, which then can't hold the partition column itself.
        """
        if buckets and (not keys or partition_column in keys):
            raise ValueError("Buckets need the key they are cut by, apart from the partition column.")
        place = location or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/snapshots/{name}-{uuid.uuid4().hex[:8]}"
        table = cls.__new__(cls)
        table.spark, table.name, table.partition_column = spark, name, partition_column
        table.keys, table.buckets = tuple(keys), buckets
        table._recorded = {
            "location": place.rstrip("/"), "provider": provider, "partition": partition_column or "",
            "keys": ",".join(keys), "buckets": str(buckets), "managed": str(location is None).lower()}
        last = [field for field in schema.fields if field.name == partition_column]
        schema = StructType([field for field in schema.fields if field not in last] + last)
        table._point(table._register(schema, {}), "", schema, "CREATE VIEW")
        return table

    # reading ---------------------------------------------------------------------------

    @property
    def snapshot(self) -> str:
        return self._recorded["snapshot"]

    @property
    def partitions(self) -> list[str]:
        return [*([self.partition_column] if self.partition_column else []), *([BUCKET] if self.buckets else [])]

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def files(self) -> DataFrame:
        """Rows of the snapshot this object last saw, with the bucket."""
        return self.spark.table(self.snapshot)

    def bucket(self) -> Column:
        """The bucket of a key, the same number that Spark gives its bucket files."""
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets))

    def located(self, rows: DataFrame) -> DataFrame:
        """Rows with every physical partition column."""
        return rows.withColumn(BUCKET, self.bucket()) if self.buckets else rows

    def of_partitions(self, wanted: Sequence[Row]) -> DataFrame:
        """Stored rows of the given partitions; the others are pruned from the scan."""
        rows = self.files()
        if not self.partitions:
            return rows
        for name in self.partitions:
            rows = rows.where(F.col(name).isin(sorted({row[name] for row in wanted})))
        if len(self.partitions) > 1:
            pair = F.concat_ws("/", *[F.col(name).cast("string") for name in self.partitions])
            rows = rows.where(pair.isin(sorted({"/".join(str(row[name]) for name in self.partitions) for row in wanted})))
        return rows

    # writing ---------------------------------------------------------------------------

    def write(self, rows: DataFrame) -> Load:
        """Write rows, with their partition columns, to new folders that nothing reads yet."""
        root = f"{self._recorded['location']}/load-{uuid.uuid4().hex}"
        written, schema = f"{self.snapshot}_load", None
        columns = [name for name in self.files().columns if name not in self.partitions]
        writer = rows.select(*columns, *self.partitions).write.format(self._recorded["provider"])
        if self.partitions:
            writer = writer.partitionBy(*self.partitions)
        if self.buckets:  # only tables can be bucketed; this one is dropped, its files stay
            self.spark.sql(f"DROP TABLE IF EXISTS {written}")
            writer.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", root).saveAsTable(written)
            folders = self._folders(written)
            self.spark.sql(f"DROP TABLE {written}")
        else:
            writer.save(root)
            schema = rows.select(*columns, *self.partitions).schema
            folders = self._folders(self._written(root, schema))
        return Load(root, folders, schema)

    def _written(self, root: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).format(self._recorded["provider"]).load(root)

    def rows_of(self, load: Load) -> DataFrame:
        """Rows of a load without buckets."""
        return self._written(load.root, load.schema)

    def abandon(self, load: Load) -> None:
        _delete(self.spark, [load.root])

    def publish(self, load: Load) -> None:
        """Make the load visible: its partitions replace stored ones of the same name."""
        now = properties(self.spark, self.name)
        if now.get("snapshot") != self.snapshot:
            raise RuntimeError(f"{self.name} was changed by another load; run this one again.")
        before = self._folders(self.snapshot) if self.partitions else {}
        schema = self.files().schema
        new = self._register(schema, {**before, **load.folders}, load.root)
        old, older = self.snapshot, self._recorded.get("previous", "")
        self._point(new, old, schema, "CREATE OR REPLACE VIEW")
        if older:  # readers of the snapshot before still run; those of older ones are done
            kept = {*self._folders(new).values(), *self._folders(old).values()}
            stale = [folder for folder in self._folders(older).values() if folder not in kept]
            self.spark.sql(f"DROP TABLE IF EXISTS {older}")
            _delete(self.spark, stale)

    def replace(self, rows: DataFrame) -> None:
        """Overwrite the partitions that occur in ``rows`` (everything if unpartitioned)."""
        self.publish(self.write(self.located(rows)))

    def drop(self) -> None:
        """Remove the table; rows in a location that the caller chose stay."""
        self.spark.sql(f"DROP VIEW IF EXISTS {self.name}")
        for snapshot in filter(None, (self.snapshot, self._recorded.get("previous"))):
            self.spark.sql(f"DROP TABLE IF EXISTS {snapshot}")
        if self._recorded["managed"] == "true":
            _delete(self.spark, [self._recorded["location"]])

    # catalog -----------------------------------------------------------------------------

    def _folders(self, source: str | DataFrame) -> dict[str, str]:
        """Folder of each partition that holds rows, by its name in paths."""
        frame = self.spark.table(source) if isinstance(source, str) else source
        depth = len(self.partitions)
        folders = {file.rsplit("/", 1)[0] for file in frame.inputFiles()}
        return {unquote("/".join(folder.split("/")[-depth:])) if depth else "": unquote(folder) for folder in folders}

    def _register(self, schema: StructType, folders: Mapping[str, str], root: str = "") -> str:
        """A snapshot that reads the given folders."""
        space, _, table = self.name.rpartition(".")
        home = f"{space}__snapshots" if space else "snapshots"  # apart, so that a listing shows tables only
        self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {home}")
        name = f"{home}.{table}_{uuid.uuid4().hex[:12]}"
        columns = {
            field.name: field.dataType.simpleString() + (
                f" COMMENT '{field.metadata['comment']}'" if "comment" in field.metadata else "")
            for field in schema.fields}
        if self.buckets:
            columns[BUCKET] = "int"
        body = ", ".join(f"`{column}` {kind}" for column, kind in columns.items())
        layout = f" PARTITIONED BY ({_quoted(self.partitions)})" if self.partitions else ""
        if self.buckets:
            layout += (f" CLUSTERED BY ({_quoted(self.keys)}) SORTED BY ({_quoted(self.keys)})"
                       f" INTO {self.buckets} BUCKETS")
        place = root if root and not self.partitions else f"{self._recorded['location']}/none"
        self.spark.sql(f"CREATE TABLE {name} ({body}) USING {self._recorded['provider']}{layout} LOCATION '{place}'")
        if self.partitions:
            entries = []
            for partition, folder in sorted(folders.items()):
                values = [part.split("=", 1) for part in partition.split("/")]
                literals = ", ".join("`{}` = '{}'".format(column, value.replace("'", "\\'")) for column, value in values)
                entries.append(f"PARTITION ({literals}) LOCATION '{folder}'")
            for start in range(0, len(entries), _AT_ONCE):
                self.spark.sql(f"ALTER TABLE {name} ADD " + " ".join(entries[start:start + _AT_ONCE]))
        return name

    def _point(self, snapshot: str, previous: str, schema: StructType, statement: str) -> None:
        """Let the view read ``snapshot``."""
        self._recorded = {**self._recorded, "snapshot": snapshot, "previous": previous}
        recorded = ", ".join(f"'{_PREFIX}{key}' = '{self._recorded[key].encode().hex()}'" for key in _PROPERTIES)
        columns = _quoted([field.name for field in schema.fields if field.name != BUCKET])
        self.spark.sql(f"{statement} {self.name} TBLPROPERTIES ({recorded}) AS SELECT {columns} FROM {snapshot}")
