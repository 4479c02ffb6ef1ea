"""Idempotent upsert by natural key and range backfill."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F

from meseta.operators.clean import any_null, in_window, latest_by_key
from meseta.operators.guards import require_fields
from meseta.session import discard, stage
from meseta.sources.snapshots import Load, SnapshotTable, is_snapshot_table
from meseta.sources.tables import TRANSACTIONAL, PathStore, TableStore, provider_of, require_table


@dataclass(frozen=True)
class UpsertReport:
    source_rows: int
    merged_rows: int  # rows of the partitions written; all rows where the format merges in place


def check_source(source: DataFrame, keys: Sequence[str], what: str) -> int:
    """Reject NULL or repeated keys; returns the row count. One pass over the keys."""
    groups = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    totals = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(any_null(keys), F.col("_n"))), F.lit(0)).alias("nulls"),
        F.count_if(F.col("_n") > 1).alias("repeated"),
    ).first()
    if totals["nulls"]:
        raise ValueError(f"{what}: {totals['nulls']} rows contain NULL natural keys.")
    if totals["repeated"]:
        raise ValueError(f"{what}: {totals['repeated']} natural keys occur more than once.")
    return totals["rows"]


def _touched(current: DataFrame, source: DataFrame, partition: str) -> DataFrame:
    """Target rows of the partitions the source writes to; Spark prunes the others from the scan."""
    return current.join(source.select(partition).distinct(), partition, "left_semi")


def merge_rows(
    current: DataFrame, source: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = ()
) -> DataFrame:
    """Target state after the upsert: matched keys replaced, others kept, new ones added.

    With ``newest_by`` the newer of the two rows wins, so a late delivery of old
    data cannot overwrite a later value. Where both are equally new the source wins:
    a rebuild of the same deliveries replaces what is stored.
    """
    source = source.select(*current.columns)
    if newest_by:
        sided = current.withColumn("_incoming", F.lit(False)).unionByName(
            source.withColumn("_incoming", F.lit(True)))
        return latest_by_key(sided, keys, [*newest_by, "_incoming"]).drop("_incoming")
    kept = current.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source)


def upsert(
    store: PathStore | TableStore | SnapshotTable,
    source: DataFrame,
    keys: Sequence[str],
    *,
    newest_by: Sequence[str] = (),
    staged: bool = False,
    insert_only: bool = False,
) -> UpsertReport:
    """Upsert into plain files: only the partitions of the source are rewritten.

    A table with snapshots shows the load when it is complete; in the others readers see
    partitions change one by one.

    The source is staged first (unless it already is), so that it is evaluated
    once and does not depend on the files being replaced. The partition value
    must follow from the key; otherwise a key could survive in its former
    partition. With ``insert_only`` stored rows win over rows of the same key.
    """
    require_fields(source, keys, "upsert source")
    if isinstance(store, SnapshotTable):
        rows = stage_source(source, store, keys)
        merge = prepare(store, rows, keys, newest_by=newest_by, insert_only=insert_only)
        discard(rows.frame)
        return merge.publish()
    partition = store.partition_column
    staged_rows = source if staged else stage(source, "upsert-source")
    rows = check_source(staged_rows, keys, "upsert source")
    try:
        current = store.read()
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        current = None

    if current is None:
        merged = staged_rows
    else:
        touched = _touched(current, staged_rows, partition) if partition else current
        incoming = staged_rows.join(touched.select(*keys), list(keys), "left_anti") if insert_only else staged_rows
        merged = merge_rows(touched, incoming, keys, newest_by)
    # even file sizes per partition, also when one partition is much larger
    merged = merged.hint("rebalance", *([partition] if partition else []))
    written = rows
    if current is not None:
        merged = stage(merged, "upsert-merged")
        written = merged.count()  # from file footers; the target itself is not counted
    if rows or current is None:
        store.replace(merged)
    discard(*([merged] if current is not None else []), *([] if staged else [staged_rows]))
    return UpsertReport(source_rows=rows, merged_rows=written)


# Tables with snapshots ------------------------------------------------------------------


@dataclass(frozen=True)
class StagedSource:
    """Evaluated rows with what was counted while they were written."""

    frame: DataFrame
    rows: int
    nulls: int  # rows without a complete key
    partitions: Sequence[Row]  # physical partitions that occur
    bad: Mapping[str, int]  # rows that meet each of the extra predicates
    load: Load | None = None  # the rows as partitions of the table, where they were written as such

    def discard(self, store: SnapshotTable) -> None:
        if self.load:
            store.abandon(self.load)
        else:
            discard(self.frame)


def stage_source(
    source: DataFrame, store: SnapshotTable, keys: Sequence[str], checks: Mapping[str, Column] | None = None,
    as_load: bool = False,
) -> StagedSource:
    """Write the rows once; row count, missing keys, partitions and row checks are metrics of that write.

    With ``as_load`` they are written as partitions of the table that nothing reads yet. A merge publishes
    them as they are where they replace all stored rows; the caller discards them if there is no merge.
    """
    checks = checks or {}
    seen = Observation()
    located = store.located(source)
    places = [F.collect_set(F.struct(*store.partitions)).alias("partitions")] if store.partitions else []
    watched = located.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(any_null(keys)).alias("nulls"), *places,
        *[F.count_if(predicate).alias(f"bad_{i}") for i, predicate in enumerate(checks.values())])
    load = None
    if as_load and not store.buckets:
        load = store.write(watched.hint("rebalance", *store.partitions))
        frame = store.rows_of(load)
    else:
        frame = stage(watched, "upsert-source")
    found = seen.get
    return StagedSource(
        frame, found["rows"], found["nulls"], found.get("partitions") or [],
        {name: found[f"bad_{i}"] for i, name in enumerate(checks)}, load)


@dataclass(frozen=True)
class PreparedMerge:
    """A merge whose rows are written and checked, but not yet read by anyone."""

    store: SnapshotTable
    load: Load | None  # nothing to change without one
    report: UpsertReport

    def publish(self) -> UpsertReport:
        if self.load:
            self.store.publish(self.load)
        return self.report

    def abandon(self) -> None:
        if self.load:
            self.store.abandon(self.load)


def _sides(
    current: DataFrame, source: DataFrame, keys: Sequence[str], newest_by: Sequence[str], insert_only: bool,
) -> tuple[DataFrame, Column]:
    """Both sides by key as ``t`` and ``s``, and whether the source row is the one to take.

    Only the source is numbered, in the partitioning of the join: ``_copy`` is the number of a source
    row among those with its key. A bucketed target joins as it lies.
    """
    columns = current.columns
    copy = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    sided = source.select(*columns).withColumn("_copy", copy).alias("s")
    same = reduce(lambda a, b: a & b, [F.col(f"t.{key}") == F.col(f"s.{key}") for key in keys])
    stored = F.col(f"t.{keys[0]}").isNotNull()
    if insert_only:
        take = ~stored
    elif newest_by:
        new, old = (F.struct(*[F.col(f"{side}.{name}") for name in newest_by]) for side in "st")
        take = F.col("_copy").isNotNull() & (~stored | (new >= old))
    else:
        take = F.col("_copy").isNotNull()
    return current.alias("t").join(sided, same, "full_outer"), take


def _merged(
    current: DataFrame, source: DataFrame, keys: Sequence[str], newest_by: Sequence[str], insert_only: bool,
) -> DataFrame:
    """Rows of the target after the merge, with the ``_copy`` of those that have a source row."""
    columns = current.columns
    sides, take = _sides(current, source, keys, newest_by, insert_only)
    return sides.select(
        *[F.when(take, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}")).alias(name) for name in columns], "_copy")


def _stays(
    current: DataFrame, source: DataFrame, keys: Sequence[str], newest_by: Sequence[str], insert_only: bool, what: str,
) -> bool:
    """Whether any stored row outlasts the merge. Reads and shuffles what decides it, not whole rows."""
    names = list(dict.fromkeys([*keys, *newest_by]))
    sides, take = _sides(current.select(*names), source.select(*names), keys, newest_by, insert_only)
    found = sides.agg(
        F.count_if(F.col("_copy") == 2).alias("repeated"), F.count_if(~F.coalesce(take, F.lit(False))).alias("kept")).first()
    if found["repeated"]:
        raise ValueError(f"{what}: {found['repeated']} natural keys occur more than once.")
    return found["kept"] > 0


def prepare(
    store: SnapshotTable, source: StagedSource, keys: Sequence[str], *, newest_by: Sequence[str] = (),
    insert_only: bool = False, what: str = "upsert source",
) -> PreparedMerge:
    """Merge staged rows into new folders of the partitions they touch.

    Raises for missing or repeated keys; then the table is as it was. Repeated keys and
    merged rows are counted by the write itself. With ``insert_only`` stored rows win.
    Where the source replaces all stored rows of its partitions, whole rows aren't joined.
    """
    if source.nulls:
        raise ValueError(f"{what}: {source.nulls} rows contain NULL natural keys.")
    if not source.rows:
        return PreparedMerge(store, None, UpsertReport(0, 0))
    if store.buckets and set(keys) != set(store.keys):
        raise ValueError(f"{store.name} is bucketed by {store.keys}, not by {tuple(keys)}.")
    incoming = source.frame.repartition(store.buckets, *store.keys) if store.buckets else source.frame
    stored = store.of_partitions(source.partitions)
    if not stored.inputFiles():  # nothing to merge with: the keys alone are shuffled to be checked
        repeated = source.frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").count()
        if repeated:
            raise ValueError(f"{what}: {repeated} natural keys occur more than once.")
        load = source.load or store.write(incoming if store.buckets else incoming.hint("rebalance", *store.partitions))
        return PreparedMerge(store, load, UpsertReport(source.rows, source.rows))
    if source.load and not _stays(stored, incoming, keys, newest_by, insert_only, what):
        return PreparedMerge(store, source.load, UpsertReport(source.rows, source.rows))
    seen = Observation()
    merged = _merged(
        stored, incoming, store.keys if store.buckets else keys, newest_by, insert_only,
    ).observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_copy") == 2).alias("repeated")).drop("_copy")
    if not store.buckets:  # even file sizes per partition, also when one partition is much larger
        merged = merged.hint("rebalance", *store.partitions)
    load = store.write(merged)
    found = seen.get
    if found["repeated"]:
        store.abandon(load)
        raise ValueError(f"{what}: {found['repeated']} natural keys occur more than once.")
    return PreparedMerge(store, load, UpsertReport(source.rows, found["rows"]))


def upsert_table(
    spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str],
    partition_column: str | None = None, newest_by: Sequence[str] = (), staged: bool = False,
) -> UpsertReport:
    """Upsert into a catalog table: MERGE where the format has it, rewrite elsewhere."""
    require_table(spark, name)
    if is_snapshot_table(spark, name):
        return upsert(SnapshotTable(spark, name), source, keys, newest_by=newest_by)
    if provider_of(spark, name) not in TRANSACTIONAL:
        store = TableStore(spark, name, partition_column)
        return upsert(store, source, keys, newest_by=newest_by, staged=staged)
    rows_to_merge = source if staged else stage(source, "upsert-source")
    rows = check_source(rows_to_merge, keys, name)
    same_key = " AND ".join(f"t.`{key}` = s.`{key}`" for key in keys)
    as_new = "".join(f" AND s.`{name}` >= t.`{name}`" for name in newest_by)
    rows_to_merge.select(*spark.table(name).columns).createOrReplaceTempView("upsert_source")
    spark.sql(
        f"MERGE INTO {name} t USING upsert_source s ON {same_key} "
        f"WHEN MATCHED{as_new} THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )
    return UpsertReport(source_rows=rows, merged_rows=rows)


def backfill(
    store: PathStore | TableStore | SnapshotTable, recalculated: DataFrame, keys: Sequence[str], ts: str, start, end
) -> UpsertReport:
    """Merge the recalculated rows of ``[start, end)``; rows outside stay as they are."""
    return upsert(store, in_window(recalculated, ts, start, end), keys)
