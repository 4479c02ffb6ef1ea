"""Tables whose loads appear all at once."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from meseta.operators.upsert import prepare, stage_source, upsert
from meseta.session import scratch_path
from meseta.sources import snapshots
from meseta.sources.snapshots import SnapshotTable

SCHEMA = "k string, day date, v int"
MON, TUE, WED = (dt.date(2026, 8, d) for d in (17, 18, 19))
START = [("A", MON, 1), ("B", MON, 2), ("A", TUE, 3)]


def rows(df):
    return sorted(tuple(r) for r in df.select("k", "day", "v").collect())


def frame(spark, data):
    """Rows with a partition column that follows from the key."""
    return spark.createDataFrame(data, SCHEMA).withColumn("month_day", F.dayofmonth("day"))


@pytest.fixture(params=[("day", 0), ("month_day", 3), (None, 4), (None, 0)], ids=str)
def table(spark, request):
    partition, buckets = request.param
    spark.sql("CREATE NAMESPACE IF NOT EXISTS snaps")
    made = SnapshotTable.create(
        spark, f"snaps.t_{uuid.uuid4().hex[:8]}",
        frame(spark, []).schema, partition_column=partition, keys=("k", "day"), buckets=buckets,
        location=scratch_path(spark, "snaps"))
    upsert(made, frame(spark, START), ["k", "day"])
    yield made
    made.drop()


def files(table):
    return {row[0] for row in table.files().select(F.input_file_name()).collect()}


def test_merge_and_rerun(spark, table):
    expected = [("A", MON, 10), ("A", TUE, 3), ("B", MON, 2), ("C", WED, 5)]
    for _ in range(3):
        report = upsert(table, frame(spark, [("A", MON, 10), ("C", WED, 5)]), ["k", "day"])
        assert rows(table.read()) == rows(spark.table(table.name)) == expected
        assert sorted(table.read().columns) == ["day", "k", "month_day", "v"]
        assert report.source_rows == 2


def test_newest_and_insert_only(spark, table):
    upsert(table, frame(spark, [("A", MON, 0), ("B", MON, 7), ("A", TUE, 3)]), ["k", "day"], newest_by=["v"])
    assert rows(table.read()) == [("A", MON, 1), ("A", TUE, 3), ("B", MON, 7)]
    upsert(table, frame(spark, [("A", MON, 99), ("D", MON, 4)]), ["k", "day"], insert_only=True)
    assert rows(table.read()) == [("A", MON, 1), ("A", TUE, 3), ("B", MON, 7), ("D", MON, 4)]


def test_bad_sources_leave_no_trace(spark, table):
    before = rows(table.read())
    for bad, text in ((("A", None, 1), "1 rows contain NULL"), (("Z", MON, 1), "1 natural keys occur more than once")):
        with pytest.raises(ValueError, match=text):
            upsert(table, frame(spark, [bad, ("Z", MON, 2)]), ["k", "day"])
    upsert(table, frame(spark, []), ["k", "day"])
    assert rows(table.read()) == before


def test_a_load_that_dies_between_two_partitions(spark, table):
    """Some tasks have written, one fails: readers see the old rows, and the next load works."""
    before = rows(table.read())
    source = stage_source(frame(spark, [("A", MON, 10), ("A", TUE, 30), ("C", WED, 5)]), table, ["k", "day"])
    poisoned = F.when(F.col("day") == F.lit(TUE), F.raise_error(F.lit("executor lost"))).otherwise(F.col("v")).cast("int")
    with pytest.raises(Exception, match="executor lost"):
        table.write(table.located(frame(spark, [("A", MON, 10), ("A", TUE, 30)]).withColumn("v", poisoned)))
    assert rows(table.read()) == before
    merge = prepare(table, source, ["k", "day"])  # complete, but the driver dies before it is published
    assert rows(table.read()) == before
    merge.publish()
    assert rows(table.read()) == [("A", MON, 10), ("A", TUE, 30), ("B", MON, 2), ("C", WED, 5)]


def test_untouched_partitions_keep_their_files(spark, table):
    if not table.partitions:
        pytest.skip("one part")
    before = files(table)
    upsert(table, frame(spark, [("A", MON, 10)]), ["k", "day"])
    assert before & files(table) and len(files(table)) == len(before)


def test_readers_of_the_snapshot_before_go_on(spark, table):
    reading = table.read()
    upsert(table, frame(spark, [("A", MON, 10)]), ["k", "day"])
    assert rows(reading) == sorted(START)
    upsert(table, frame(spark, [("A", MON, 11)]), ["k", "day"])
    assert spark.catalog.tableExists(table._recorded["previous"])


def test_two_loads_at_once(spark, table):
    other = SnapshotTable(spark, table.name)
    first = prepare(table, stage_source(frame(spark, [("A", MON, 10)]), table, ["k", "day"]), ["k", "day"])
    second = prepare(other, stage_source(frame(spark, [("B", MON, 20)]), other, ["k", "day"]), ["k", "day"])
    first.publish()
    with pytest.raises(RuntimeError, match="another load"):
        second.publish()
    assert ("A", MON, 10) in rows(table.read()) and ("B", MON, 2) in rows(table.read())


def test_bucketed_merge_shuffles_the_source_alone(spark, monkeypatch):
    rows_ = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    spark.sql("CREATE NAMESPACE IF NOT EXISTS snaps")
    table = SnapshotTable.create(spark, "snaps.keyed", rows_.schema, keys=("k",), buckets=8, location=scratch_path(spark, "k"))
    upsert(table, rows_, ["k"])
    before = files(table)
    plans = []
    write = SnapshotTable.write
    monkeypatch.setattr(SnapshotTable, "write", lambda self, df: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or write(self, df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        changed = rows_.where("k IN (5, 17)").withColumn("v", F.lit(-1).cast("long"))
        upsert(table, changed, ["k"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans[0].count("Exchange") == 1 and "Bucketed: true" in plans[0]
    touched = changed.select(F.pmod(F.hash("k"), F.lit(8))).distinct().count()
    assert len(before - files(table)) == touched and len(files(table)) == 8
    assert table.read().where("v = -1").count() == 2 and table.read().count() == 2000


def test_no_jobs_for_counts(spark):
    """A merge runs the staging write and the merging write; counts and checks are theirs."""
    spark.sql("CREATE NAMESPACE IF NOT EXISTS snaps")
    table = SnapshotTable.create(spark, "snaps.counted", frame(spark, []).schema, keys=("k", "day"), partition_column="day",
                                 location=scratch_path(spark, "c"))
    upsert(table, frame(spark, START), ["k", "day"])
    source = stage_source(frame(spark, [("A", MON, 10), ("C", WED, None)]), table, ["k", "day"],
                          {"empty": F.col("v").isNull(), "late": F.col("day") > F.lit(TUE)})
    assert (source.rows, source.nulls, source.bad) == (2, 0, {"empty": 1, "late": 1})
    assert {row["day"] for row in source.partitions} == {MON, WED}
    assert prepare(table, source, ["k", "day"]).report.merged_rows == 3


def test_guards(spark):
    with pytest.raises(ValueError, match="Not a table with snapshots"):
        SnapshotTable(spark, "nowhere_at_all")
    with pytest.raises(ValueError, match="Buckets need the key"):
        SnapshotTable.create(spark, "snaps.bad", frame(spark, []).schema, buckets=2)
    with pytest.raises(ValueError, match="Buckets need the key"):
        SnapshotTable.create(
            spark, "snaps.bad", frame(spark, []).schema, keys=("k", "day"), buckets=2, partition_column="day")
    assert not snapshots.is_snapshot_table(spark, "nowhere_at_all")
