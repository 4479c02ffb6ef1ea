from meseta.operators.analytics import mean_by_bin


def test_edges_do_not_depend_on_summation_noise(spark):
    below, above = 5.0 - 1e-15 * 4, 5.0 + 1e-15 * 4
    assert below < 5.0 < above
    frame = spark.createDataFrame([(below, 1.0), (5.0, 2.0), (above, 6.0), (4.9999, 7.0), (-1e-16, 3.0)], "x double, y double")
    found = {row["bin_start"]: (row["n"], row["mean"]) for row in mean_by_bin(frame, "x", "y", 5.0).collect()}
    assert found == {5.0: (3, 3.0), 0.0: (2, 5.0)}
