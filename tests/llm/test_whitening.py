"""Whitening against a dense singular value decomposition."""

import math

import numpy as np
import pytest

from meseta.llm import whitening as white



@pytest.fixture(autouse=True)
def few_groups(monkeypatch):
    monkeypatch.setattr(white, "_FAN", 2)


SCHEMA = "vec_id long, embedding array<double>, x string, component int, n string"


def run(spark, rows, components=16):
    frame = spark.createDataFrame([(i, v, "x", 1, "n") for i, v in rows], SCHEMA).repartition(5)
    numbers = white.whole_numbers(frame, "vec_id", "embedding")
    model = white.fit_whitening(numbers, components)
    return model, white.whiten(numbers, model, "vec_id").collect()


def plain(rows, components=16):
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), np.int64)
    n, sums = len(fit), fit.sum(0)
    centred = (fit * n - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    values, vectors = values[order], vectors[:, order]
    count = min(components, int((values > 1e-12 * values[0]).sum()))
    out = {}
    for row, (i, x) in enumerate(kept):
        off = np.array(x) * n - sums
        scores = off / n @ vectors[:, :count] / np.sqrt(values[:count])
        out[i] = (n, int((off.astype(object) ** 2).sum()), scores, values[:count] / values.sum())
    return out


def same(rows, model, found):
    expected = plain(rows)
    assert {row["vec_id"] for row in found} == set(expected)
    assert model.identity_error < 1e-9
    signs: dict[int, set] = {}
    for row in found:
        n, deviation, scores, explained = expected[row["vec_id"]]
        k = row["component"] - 1
        assert (row["n"], row["deviation"]) == (n, deviation)
        assert row["explained"] == pytest.approx(explained[k], rel=1e-9)
        assert abs(row["whitened"]) == pytest.approx(abs(scores[k]), abs=1e-6)
        if abs(scores[k]) > 1e-3:
            signs.setdefault(k, set()).add(math.copysign(1, row["whitened"] * scores[k]))
    assert all(len(found) == 1 for found in signs.values())
    assert len(found) == len(expected) * len(next(iter(expected.values()))[2])


def test_equals_a_dense_decomposition(spark):
    draw = np.random.default_rng(5)
    vectors = (draw.normal(size=(400, 24)) * np.geomspace(9, 0.2, 24)) @ np.linalg.qr(draw.normal(size=(24, 24)))[0]
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    rows += [(1000 + k, v.tolist()) for k, v in enumerate(vectors[:30])]  # copies count once in the fit
    rows += [(2000 + k, vectors[0].tolist()) for k in range(300)]
    rows += [(3000, None), (3001, [None] * 24), (3002, [math.nan] * 24), (3003, [math.inf] * 24), (3004, [0.0] * 23), (3005, [])]
    model, found = run(spark, rows)
    same([row for row in rows if row[0] < 3004], model, found)
    assert model.passes >= 3


def test_fewer_directions_than_dimensions(spark):
    draw = np.random.default_rng(6)
    vectors = draw.integers(-3, 4, (60, 3)) @ draw.integers(-2, 3, (3, 8))  # rank 3
    rows = [(k, [*map(float, v), 7.0]) for k, v in enumerate(vectors)]  # and a constant
    model, found = run(spark, rows)
    assert len(model.eigenvalues) == 3
    same(rows, model, found)


def test_badly_scaled_columns(spark):
    draw = np.random.default_rng(7)
    vectors = np.floor(draw.normal(size=(300, 6)) * [1e8, 1e6, 1e4, 1e2, 10, 1])
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    model, found = run(spark, rows)
    centred = np.floor(64 * vectors) - np.floor(64 * vectors).mean(0)
    expected = np.linalg.svd(centred, compute_uv=False) ** 2 / len(np.unique(centred, axis=0))
    assert len(model.eigenvalues) == 6 and model.identity_error < 1e-4
    assert np.allclose(model.eigenvalues, expected, rtol=1e-6)


def test_nothing_to_fit(spark):
    assert run(spark, [])[1] == []
    assert run(spark, [(1, None)])[1] == []
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])[1] == []
    model, found = run(spark, [(None, [1.0, 2.0]), (None, [3.0, 2.0])])
    assert [abs(row["whitened"]) for row in found] == pytest.approx([1.0, 1.0]) and model.n == 2


def test_huge_entries(spark):
    model, found = run(spark, [(1, [1e300, 0.0]), (2, [-1e300, 0.0]), (3, [0.0, 1.0])])
    assert model.n == 3 and any(row["deviation"] is None for row in found)
