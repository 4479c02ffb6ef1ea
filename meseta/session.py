"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def build_session(app_name: str, **conf: str) -> SparkSession:
    """A session with the settings the engine relies on: UTC and adaptive execution."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # streaming state on local disk with remote checkpoints, not on the heap
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        # no Python call-site capture per expression; wide facts build hundreds of them
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster a
    machine-local path would be unreadable from other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder shared by all executors.")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _local_roots[context.applicationId]


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def discard(*frames: DataFrame) -> None:
    """Delete staged folders that nothing reads any more."""
    for frame in frames:
        spark = frame.sparkSession
        root = shared_root(spark)
        # a staged file lies below <root>/<purpose>-<hex>
        for name in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            if root.removeprefix("file:").lstrip("/") in name:
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, purpose: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage like a reliable checkpoint, but columnar: later readers
    prune columns and the rows survive the loss of any executor.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
