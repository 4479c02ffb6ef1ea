"""Helpers the operators share: staging, words of a text, sorted groups of Arrow batches."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from meseta.session import scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings for the time of one job."""
    names = {key.replace("__", "."): value for key, value in conf.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage, survives lost executors, and frees the shuffle files of the
    job at its end, so that a chain of stages needs the disk of its largest one.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    with setting(spark, **{_CLEANUP.replace(".", "__"): "true"}):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete staged folders that no later step reads."""
    for frame in frames:
        spark = frame.sparkSession
        folders = {name.rsplit("/", 1)[0] for name in frame.inputFiles()}
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the next one like it that no column of ``df`` has, whatever its case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(text: str = "text") -> Column:
    """The text as UTF-8 bytes, empty for null."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose sizes add up to about ``limit``; a larger row stands alone."""
    start, total = 0, 0
    for row, size in enumerate(sizes):
        if row > start and total + size > limit:
            yield start, row
            start, total = row, 0
        total += int(size)
    if start < len(sizes):
        yield start, len(sizes)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, from batches sorted by the keys; keys hold no nulls.

    A group must fit in memory, so callers bound its size.
    """
    carry: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows - 1, bool)
        for key in keys:
            values = batch.column(key).to_numpy(zero_copy_only=False)
            change |= values[1:] != values[:-1]
        bounds = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for start, end in zip(bounds, bounds[1:]):
            key = tuple(batch.column(name)[start].as_py() for name in keys) if start == 0 or end == batch.num_rows else None
            if carry and (start > 0 or key != last):
                yield pa.Table.from_batches(carry)
                carry = []
            part = batch.slice(start, end - start)
            if end == batch.num_rows:
                carry.append(part)
                last = key
            elif carry:
                yield pa.Table.from_batches([*carry, part])
                carry = []
            else:
                yield pa.Table.from_batches([part])
    if carry:
        yield pa.Table.from_batches(carry)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, also where only the driver has it on its path."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='ship-')}/{package.name}", "zip", package.parent, package.name)
    context.addPyFile(archive)  # Spark hands it to every executor
    _shipped.add(context.applicationId)


def arrow_stream(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str | StructType,
) -> DataFrame:
    """``mapInArrow`` for a function from the batches of a partition to dictionaries of columns."""
    ship(df.sparkSession)
    schema = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in function(batches):
            yield record_batch(columns, target)

    return df.mapInArrow(run, schema)


def arrow_map(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` for a function from one batch to dictionaries of columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)

    return arrow_stream(df, run, schema)


def record_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    arrays = []
    for field in schema:
        value = columns[field.name]
        if isinstance(value, pa.ChunkedArray):
            value = value.combine_chunks()
        if not isinstance(value, pa.Array):
            value = pa.array(value, type=field.type)
        elif value.type != field.type:
            value = value.cast(field.type)
        arrays.append(value)
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
