"""Append-only landing of payload rows in the Bronze layout."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LAYOUT = ("year", "month", "day")
RECORD_SEPARATOR = "\x1e"


def _dated(df: DataFrame, ingested_at: dt.datetime) -> DataFrame:
    parts = (f"{ingested_at:%Y}", f"{ingested_at:%m}", f"{ingested_at:%d}")
    return df.withColumns({name: F.lit(value) for name, value in zip(_LAYOUT, parts)})


def _checked_path(root: str, source: str, dataset: str) -> str:
    if not (root.strip() and source.strip() and dataset.strip()):
        raise ValueError("Root, source and dataset cannot be blank.")
    return f"{root.rstrip('/')}/{source.strip()}/{dataset.strip()}"


def land_envelopes(
    df: DataFrame,
    root: str,
    *,
    source: str,
    dataset: str,
    ingestion_mode: str,
    ingested_at: dt.datetime,
    requested_start_date: str | None = None,
    requested_end_date: str | None = None,
    extra_metadata: dict[str, Column] | None = None,
    payload: str = "data",
    packed: int = 0,
) -> str:
    """Append one ``{"metadata", "data"}`` object per row of ``df``.

    Objects are written one per line, so the files stay splittable; read them
    back with ``multiline=False``. A second run over the same window adds
    objects and never overwrites. With ``packed`` the files are compressed and
    hold at most that many objects, as one task has to read a whole file.
    """
    fixed = {
        "source": source,
        "dataset": dataset,
        "ingestion_mode": ingestion_mode,
        "ingestion_timestamp": ingested_at.isoformat(),
        "requested_start_date": requested_start_date,
        "requested_end_date": requested_end_date,
    }
    metadata = [F.lit(value).cast("string").alias(name) for name, value in fixed.items()]
    metadata += [column.alias(name) for name, column in (extra_metadata or {}).items()]
    path = _checked_path(root, source, dataset)
    rows = df.select(F.struct(*metadata).alias("metadata"), F.col(payload).alias("data"))
    writer = _dated(rows, ingested_at).write.mode("append").partitionBy(*_LAYOUT)
    if packed:
        writer = writer.options(compression="gzip", maxRecordsPerFile=packed)
    writer.json(path)
    return path


def land_text(
    df: DataFrame, root: str, *, source: str, dataset: str, ingested_at: dt.datetime,
    text: str = "value",
) -> str:
    """Append one document per row, many documents per file.

    Documents keep their line breaks; a record separator character stands
    between them, so files stay few and splittable. Read them back with
    ``Bronze.text(..., packed=True)``.
    """
    path = _checked_path(root, source, dataset)
    rows = _dated(df.select(F.col(text).alias("value")), ingested_at)
    (
        rows.write.mode("append").partitionBy(*_LAYOUT)
        .option("lineSep", RECORD_SEPARATOR).text(path)
    )
    return path


def land_snapshot(
    df: DataFrame, root: str, *, source: str, dataset: str, ingested_at: dt.datetime, sep: str = ";",
) -> str:
    """Append a delimited snapshot with a header whose file names carry the landing instant.

    ``<source>_<dataset>_YYYYMMDDTHHMMSSffffffZ_<id>.csv`` is what readers take the instant
    from. Spark writes the parts below a name that readers skip; they are renamed into place.
    """
    path = _checked_path(root, source, dataset)
    folder = f"{path}/year={ingested_at:%Y}/month={ingested_at:%m}/day={ingested_at:%d}"
    staging = f"{path}/_landing-{uuid.uuid4().hex}"
    df.write.options(header=True, sep=sep, encoding="iso-8859-1").csv(staging)
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(folder)
    files = target.getFileSystem(conf)
    files.mkdirs(target)
    for status in files.listStatus(jvm.org.apache.hadoop.fs.Path(staging)):
        if status.getPath().getName().startswith("part-"):
            name = f"{source}_{dataset}_{ingested_at:%Y%m%dT%H%M%S%f}Z_{uuid.uuid4().hex}.csv"
            files.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"))
    files.delete(jvm.org.apache.hadoop.fs.Path(staging), True)
    return path
