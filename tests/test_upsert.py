import datetime as dt

import pytest
from pyspark.sql import functions as F

from meseta.catalog import TableSpec
from meseta.operators.upsert import backfill, upsert, upsert_table
from meseta.session import scratch_path
from meseta.sources import tables
from meseta.sources.tables import PathStore

SCHEMA = "k string, day date, v int"
MON, TUE, WED = (dt.date(2026, 8, d) for d in (17, 18, 19))


def rows(df):
    return sorted(tuple(r) for r in df.select("k", "day", "v").collect())


@pytest.fixture
def store(spark):
    frame = spark.createDataFrame([("A", MON, 1), ("B", MON, 2), ("A", TUE, 3)], SCHEMA)
    store = PathStore(spark, scratch_path(spark, "t"), frame.schema, "day")
    upsert(store, frame, ["k", "day"])
    return store


def test_update_insert_and_rerun(spark, store):
    source = spark.createDataFrame([("A", MON, 10), ("C", WED, 5)], SCHEMA)
    expected = [("A", MON, 10), ("A", TUE, 3), ("B", MON, 2), ("C", WED, 5)]
    for _ in range(2):
        report = upsert(store, source, ["k", "day"])
        assert rows(store.read()) == expected
        assert (report.source_rows, report.merged_rows) == (2, 3)


def test_untouched_partitions_are_not_rewritten(spark, store):
    def files():
        return {r[0] for r in store.read().filter(F.col("day") == F.lit(TUE)).select(F.input_file_name()).collect()}

    before = files()
    upsert(store, spark.createDataFrame([("A", MON, 10)], SCHEMA), ["k", "day"])
    assert files() == before


def test_bad_sources_leave_the_target_alone(spark, store):
    before = rows(store.read())
    for bad, text in ((("A", None, 1), "NULL"), (("Z", MON, 1), "more than once")):
        source = spark.createDataFrame([bad, ("Z", MON, 2)], SCHEMA)
        with pytest.raises(ValueError, match=text):
            upsert(store, source, ["k", "day"])
    assert rows(store.read()) == before
    upsert(store, spark.createDataFrame([], SCHEMA), ["k", "day"])
    assert rows(store.read()) == before


def test_late_delivery_of_old_data_loses(spark, store):
    source = spark.createDataFrame([("A", MON, 0), ("B", MON, 7)], SCHEMA)
    upsert(store, source, ["k", "day"], newest_by=["v"])
    assert rows(store.read()) == [("A", MON, 1), ("A", TUE, 3), ("B", MON, 7)]


def test_backfill_changes_its_range_only(spark, store):
    recalculated = spark.createDataFrame([("A", MON, 100), ("A", TUE, 300), ("D", TUE, 400)], SCHEMA)
    backfill(store, recalculated, ["k", "day"], "day", TUE, WED)
    assert rows(store.read()) == [("A", MON, 1), ("A", TUE, 300), ("B", MON, 2), ("D", TUE, 400)]


def test_unpartitioned(spark):
    frame = spark.createDataFrame([("A", MON, 1), ("B", MON, 2)], SCHEMA)
    store = PathStore(spark, scratch_path(spark, "t"), frame.schema)
    upsert(store, frame, ["k"])
    upsert(store, spark.createDataFrame([("B", TUE, 9)], SCHEMA), ["k"])
    assert rows(store.read()) == [("A", MON, 1), ("B", TUE, 9)]


@pytest.mark.parametrize("partition, column, value", [
    (("days", "ts"), "part_day", dt.date(2026, 8, 18)), (("months", "ts"), "part_month", "2026-08"), (None, None, None)])
def test_catalog_tables(spark, partition, column, value):
    kind = partition[0] if partition else "plain"
    spec = TableSpec(f"t_{kind}", ("k", "ts"), partition)
    frame = spark.createDataFrame([("A", dt.datetime(2026, 8, 18, 12))], "k string, ts timestamp_ntz").withColumn("v", F.lit(1))
    tables.create_namespace(spark, "stored")
    assert tables.create_table(spark, frame, spec, namespace="stored")
    assert not tables.create_table(spark, frame, spec, namespace="stored")
    name = f"stored.{spec.name}"
    assert spark.table(name).count() == 0
    for v in (1, 2):
        changed = tables.with_partition(frame.withColumn("v", F.lit(v)), spec)
        upsert_table(spark, name, changed, spec.keys, spec.partition_column)
        assert [r["v"] for r in spark.table(name).collect()] == [v]
    if column:
        assert spark.table(name).first()[column] == value
    layout = tables.describe_layout(spark, [name, "stored.absent"]).collect()
    assert [(r["table_exists"], r["partition_columns"]) for r in layout] == [(True, [column] if column else []), (False, [])]
    assert tables.missing_tables(spark, [spec.name, "absent"], "stored") == ["absent"]
    assert tables.provider_of(spark, name) == "parquet"
    tables.drop_table(spark, name)
    assert not tables.table_exists(spark, name)


def test_table_guards(spark):
    with pytest.raises(ValueError):
        tables.create_namespace(spark, "  ")
    with pytest.raises(ValueError, match="does not exist"):
        upsert_table(spark, "nowhere_at_all", spark.range(1), ["id"])


def test_source_wins_where_both_are_equally_new(spark):
    """A rebuild of the same deliveries carries the same instants; its rows replace the stored ones."""
    schema = "k string, at int, place string"
    stored = spark.createDataFrame([(f"k{i}", 1, None) for i in range(20)], schema)
    rebuilt = spark.createDataFrame([(f"k{i}", 1, "here") for i in range(20)], schema)
    older = spark.createDataFrame([(f"k{i}", 0, "old") for i in range(20)], schema)
    store = PathStore(spark, scratch_path(spark, "ties"), stored.schema)
    for rows in (stored, rebuilt, older):
        upsert(store, rows, ["k"], newest_by=["at"])
    assert {r["place"] for r in store.read().collect()} == {"here"}


def test_insert_only_keeps_stored_rows_and_staging_is_removed(spark, store):
    from pathlib import Path

    from meseta.session import shared_root

    before = set(Path(shared_root(spark)).iterdir())
    upsert(store, spark.createDataFrame([("A", MON, 99), ("D", MON, 4)], SCHEMA), ["k", "day"], insert_only=True)
    assert rows(store.read()) == [("A", MON, 1), ("A", TUE, 3), ("B", MON, 2), ("D", MON, 4)]
    assert all(not any(p.rglob("*.parquet")) for p in set(Path(shared_root(spark)).iterdir()) - before)
