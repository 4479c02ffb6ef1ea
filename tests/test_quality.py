import datetime as dt

import pytest
from pyspark.sql import functions as F

from meseta.operators import quality


def verdict(df):
    return {r["check"]: (r["n_total"], r["n_bad"]) for r in df.collect()}


def test_planted_faults_are_counted_in_one_pass(spark):
    ts = dt.datetime(2026, 8, 18, 12, 7)
    rows = [("A", 95.0, 0.0, "28", ts), (None, 40.0, None, "28", ts.replace(minute=15)), ("B", 40.0, -3.0, None, ts)]
    frame = spark.createDataFrame(rows, "k string, lat double, lon double, province string, ts timestamp_ntz")
    checks = {
        "null_key": quality.null_key(["k", "ts"]), **quality.coordinate_checks("lat", "lon"),
        "grid": quality.off_grid("ts", "FIFTEEN_MINUTES"), **quality.null_fields(["province"]),
    }
    found = quality.row_checks(frame, "t", checks)
    assert verdict(found) == {
        "null_key": (3, 1), "coordinate_out_of_range": (3, 1), "coordinate_missing": (3, 1), "grid": (3, 2),
        "null_province": (3, 1)}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_null_keys_in_any_component(spark):
    frame = spark.createDataFrame([("A", 1), (None, 2), ("B", None), (None, None)], "a string, b int")
    assert verdict(quality.row_checks(frame, "t", {"null_key": quality.null_key(["a", "b"])})) == {"null_key": (4, 3)}


def test_duplicates_and_surplus(spark):
    frame = spark.createDataFrame([("A", 1), ("A", 1), ("B", 1)], "k string, v int")
    assert verdict(quality.duplicate_keys(frame, ["k"], "t")) == {"duplicate_key": (3, 1)}
    assert tuple(quality.surplus_rows(frame, ["k"]).first()) == (3, 2, 1)
    assert verdict(quality.duplicate_keys(frame.filter("false"), ["k"], "t")) == {"duplicate_key": (0, 0)}


def test_sign_and_provenance(spark):
    frame = spark.createDataFrame([(-60.0, -5.0), (-60.0, 5.0), (0.0, 0.0), (None, None)], "mw double, mwh double")
    assert verdict(quality.row_checks(frame, "t", {
        "sign": quality.sign_changed(F.col("mw"), F.col("mwh")),
        "energy": quality.wrong_interval_energy("mw", "mwh", 5)})) == {"sign": (4, 1), "energy": (4, 1)}
    chosen = spark.createDataFrame(
        [(1.0, 2.0, 1.0, "A"), (None, 2.0, 2.0, "B"), (None, 2.0, 2.0, "A"), (1.0, 2.0, 2.0, "A"), (None, None, None, None)],
        "a double, b double, v double, s string")
    check = quality.wrong_provenance("v", "s", {"A": "a", "B": "b"})
    assert verdict(quality.row_checks(chosen, "t", {"p": check})) == {"p": (5, 2)}


def test_fidelity_sees_lost_and_changed_keys(spark):
    source = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0), (4, 4.0)], "k int, v double")
    stored = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.5), (5, None)], "k int, v double")
    assert verdict(quality.value_fidelity(source, stored, ["k"], "v", "t")) == {"value_fidelity": (5, 3)}
    assert verdict(quality.lost_coverage(source, stored, ["k"], "v", "t")) == {"lost_coverage": (3, 1)}


def test_changes_outside_a_range(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (9, "x")], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (9, "y")], "k int, v string")
    assert verdict(quality.changed_outside(before, after, F.col("k") < 9, "t")) == {"changed_outside_range": (3, 2)}
    assert verdict(quality.same_rows(before, before, "t")) == {"idempotent": (4, 0)}


def test_references_profile_and_dependency(spark):
    facts = spark.createDataFrame([("a",), ("a",), ("z",)], "key string")
    dim = spark.createDataFrame([("a",)], "key string")
    assert verdict(quality.dangling_references(facts, dim, ["key"], "t")) == {"dangling_reference": (2, 1)}
    codes = spark.createDataFrame([("1", "x", "q"), ("1", "y", ""), ("2", "z", None)], "c string, n string, e string")
    assert verdict(quality.functional_dependency(codes, "c", "n", "t")) == {"c_to_n": (2, 1)}
    profile = {r["column"]: tuple(r)[1:] for r in quality.key_profile(codes, ["c", "e"]).collect()}
    assert profile == {"c": (3, 3, 2, 1), "e": (3, 1, 1, 0)}


def test_gate(spark):
    good = spark.createDataFrame([("A",)], "k string")
    fine = quality.row_checks(good, "t", {"null_key": quality.null_key(["k"])})
    warned = quality.row_checks(good, "t", {"odd": (quality.WARNING, F.lit(True))})
    assert quality.require_passed([fine, warned]).count() == 2
    assert quality.failures([fine, warned]).count() == 0
    bad = quality.row_checks(good, "t", {"wrong": (quality.ERROR, F.lit(True))})
    with pytest.raises(ValueError, match="t.wrong=1"):
        quality.require_passed([fine, bad])


def test_same_values_tolerates_summation_noise_only(spark):
    rows = [("a", 0.1 + 0.2, 359.9999999999999, "x"), ("b", 1.0, 10.0, "y"), ("c", None, None, None)]
    schema = "k string, mean double, direction double, name string"
    frame = spark.createDataFrame(rows, schema)
    noisy = spark.createDataFrame([("a", 0.3, 0.0, "x"), *rows[1:]], schema)
    assert verdict(quality.same_rows(frame, noisy, "t"))["idempotent"][1] > 0
    same = lambda other: verdict(quality.same_values(frame, other, ["k"], "t", directions=["direction"]))["idempotent"]
    assert same(noisy) == (3, 0)
    for row in (("b", 1.0001, 10.0, "y"), ("b", None, 10.0, "y"), ("b", 1.0, 10.1, "y"), ("b", 1.0, 10.0, "z")):
        assert same(spark.createDataFrame([rows[0], row, rows[2]], schema)) == (3, 1)
    assert same(frame.where("k <> 'b'")) == (3, 1)
    assert same(frame.unionByName(frame.where("k = 'b'"))) == (3, 1)
