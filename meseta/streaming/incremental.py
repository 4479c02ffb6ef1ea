"""New files only: upsert per micro-batch, and deduplication against what is stored."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meseta.operators.clean import latest_by_key
from meseta.operators.upsert import upsert
from meseta.session import discard, stage
from meseta.sources.snapshots import SnapshotTable
from meseta.sources.tables import PathStore, TableStore


def upsert_stream(
    arrivals: DataFrame,
    store: PathStore | TableStore | SnapshotTable,
    keys: Sequence[str],
    newest_by: Sequence[str],
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Process all files that arrived since the last run, then stop.

    Each micro-batch keeps one row per key and is merged into the store. The
    merge is idempotent, so a batch repeated after a failure changes nothing.
    """

    def merge(batch: DataFrame, _batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        upsert(store, latest_by_key(rows, keys, newest_by), keys, newest_by=newest_by)

    return (
        arrivals.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dedup_stream(
    arrivals: DataFrame, store: PathStore, keys: Sequence[str], checkpoint: str, remember: str = "7 days",
) -> StreamingQuery:
    """Keep one row of each key, whatever the order of the files, then stop.

    Keys that arrived within the time ``remember`` are held in state and their repeats end
    there. State is bounded: the watermark follows the time of arrival, so a key leaves
    when that time is over. No row is ever late for that watermark, however old its own
    instant, so nothing is dropped for its age: repeats that come later, or after the
    state was lost, are found by an anti join with the stored rows, in the partitions of
    the batch only. New rows are appended; stored files are never rewritten. A batch that
    is repeated after a failure finds its rows stored. Which of several rows of a key that
    arrive together stays is not defined.
    """
    fresh = (
        arrivals.withColumn("_arrived", F.current_timestamp())
        .withWatermark("_arrived", remember)
        .dropDuplicatesWithinWatermark(list(keys))
        .drop("_arrived")
    )

    def append(batch: DataFrame, _batch_id: int) -> None:
        rows = stage(batch, "arrivals")
        store.append(rows.join(store.like(rows).select(*keys), list(keys), "left_anti"))
        discard(rows)

    return (
        fresh.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
