"""Whitening against numpy over all rows: copies, weights, exact deviations, flat and odd tables."""

import math

import numpy as np
import pytest

from ledgerloom.llm import group_whitening as t


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0.5) for r in rows], "vec_id long, embedding array<double>, whitened double")


def brute(rows, weights="counts", components=8):
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    dims = max(len(r[1]) for r in rows)
    x = np.array([[math.floor(1024 * c) + 100_000 for c in [*r[1], *[0.0] * (dims - len(r[1]))]] for r in rows], object)
    fit = x if weights == "counts" else np.array(sorted(set(map(tuple, x))), object)
    n, sums = len(fit), fit.sum(axis=0)
    y = (fit * n - sums).astype(float) / n
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    white = (x * n - sums).astype(float) / n @ axes / np.sqrt(values)
    return [r[0] for r in rows], n, [sum(int(v) ** 2 for v in row) for row in x * n - sums], white, values / np.trace(y.T @ y / n)


def check(spark, rows, weights="counts", components=8):
    ids, n, deviation, white, explained = brute(rows, weights, components)
    got = t.whiten(frame(spark, rows), components, weights).collect()
    assert len(got) == len(ids) * white.shape[1] and {r.n for r in got} == {n}
    # rows are told apart by id and deviation; signs are the same for all rows
    key = lambda i, d: (i is None, i or 0, d)
    order = sorted(range(len(ids)), key=lambda k: key(ids[k], deviation[k]))
    for c in range(white.shape[1]):
        mine = sorted((r for r in got if r.component == c + 1), key=lambda r: key(r.vec_id, r.deviation))
        assert [(r.vec_id, r.deviation) for r in mine] == [(ids[k], deviation[k]) for k in order]
        a, b = np.array([r.whitened for r in mine]), white[order, c]
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9
        assert all(abs(r.explained - explained[c]) < 1e-9 for r in mine)
    assert all(r.identity_error < 1e-8 for r in got)
    return got


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_against_numpy_with_copies(spark, weights):
    rng = np.random.default_rng(1)
    base = rng.normal(0, 0.3, (60, 12)) * np.linspace(1, 2, 12)
    rows = [(i, base[i % 60].tolist()) for i in range(150)] + [(500 + i, base[3].tolist()) for i in range(100)]     # one vector in 2 of 5 rows
    rows += [(900, None), (901, [1.0, None]), (902, [float("nan")] * 12), (903, [float("inf")] * 12), (None, base[5].tolist()),
             (4, base[4].tolist()), (904, [0.25, 0.5]), (905, [])]
    check(spark, rows, weights)


def test_hot_and_cold_groups_join_alike(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 0.2, 5).tolist()) for i in range(40)] + [(100 + i, [0.1] * 5) for i in range(30)]
    whole = sorted(map(tuple, check(spark, rows, components=3)), key=str)
    monkeypatch.setattr(t, "HOT", 2)                    # nothing is hot
    assert sorted(map(tuple, t.whiten(frame(spark, rows), 3).collect()), key=str) == whole


def test_fewer_dimensions_and_flat_tables(spark):
    check(spark, [(i, [i * 0.1, (i * i % 7) * 0.1]) for i in range(20)], components=2)
    assert t.whiten(frame(spark, [(1, [0.5, 0.2])] * 5)).count() == 0             # no variance, no component
    assert t.whiten(frame(spark, [(1, [])] * 2)).count() == 0
    assert t.whiten(frame(spark, [(1, None)])).count() == 0
    assert t.whiten(frame(spark, [(1, [0.5])]).limit(0)).count() == 0
    line = t.whiten(frame(spark, [(i, [i * 0.5, i * 1.0]) for i in range(9)])).collect()
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-9


def test_large_entries(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 0.5]), (3, [0.0, 0.25]), (4, [5.0, -0.25])]
    got = t.whiten(frame(spark, rows)).collect()
    assert {r.vec_id for r in got} == {1, 2, 3, 4} and all(math.isfinite(r.whitened) for r in got)
    assert {r.deviation for r in got if r.vec_id == 1} == {None}                  # no long holds it


def test_exact_whole_numbers():
    model = t.Fit(3, [2 ** 60, -5])
    x = np.array([[2 ** 59, 7], [0, 0]], np.int64)
    assert model.apart(x).tolist() == [[3 * 2 ** 59 - 2 ** 60, 26], [-2 ** 60, 5]]
    assert model.deviation(x) == [None, None] and t.Fit(2, [3, 1]).deviation(np.array([[4, 2]], np.int64)) == [34]
    with pytest.raises(ValueError):
        t.fit(None, "most")
