"""One-bit codes: recall against brute force, exact scores, the bounds, bad vectors."""

import math

import numpy as np
import pytest

from ledgerloom.llm import one_bit_ann as t


def good(r):
    return r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])


def brute(rows, queries, k):
    out = []
    for q in filter(good, queries):
        found = sorted((-sum(float(x) * float(y) for x, y in zip(q[1], c[1])), c[0]) for c in filter(good, rows) if c[0] != q[0])[:k]
        out += [(q[0], i + 1, c, -s) for i, (s, c) in enumerate(found)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, rank string")


@pytest.mark.parametrize("dims,block", [(16, 32), (64, 256), (300, 1024)])
def test_recall_and_exact_scores(spark, dims, block):
    rng = np.random.default_rng(dims)
    base = rng.normal(0.05, 0.1, (900, dims)).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    queries = [r for r in rows if r[0] % 20 == 0]
    found = t.neighbours(frame(spark, rows), frame(spark, queries), k=20, block=block, query_block=16)
    exact = spark.createDataFrame(brute(rows, queries, 20), "query_id long, rank int, vec_id long, score double")
    assert t.recall(found, exact) >= 0.99
    by = {r[0]: np.array(r[1]) for r in rows}
    got = found.collect()
    assert len(got) == 20 * len(queries) and len({(r.query_id, r.vec_id) for r in got}) == len(got)
    assert all(abs(r.score - by[r.query_id] @ by[r.vec_id]) < 1e-12 for r in got)
    for q in queries[:5]:
        mine = sorted((r for r in got if r.query_id == q[0]), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21)) and mine == sorted(mine, key=lambda r: (-r.score, r.vec_id))


def test_ties_repeats_and_bad_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 8).astype(np.float32)]) for i in range(60)]
    rows += [(100 + i, rows[7][1]) for i in range(30)]
    rows += [(200, None), (201, [1.0, None]), (202, [float("nan")] * 8), (203, [float("-inf")] * 8), (204, [0.0] * 8), (205, []),
             (206, [0.5, -0.5]), (None, rows[0][1]), (5, rows[5][1]), (208, [1e30] * 8), (209, [-3e38] * 8)]
    queries = [r for r in rows if r[0] is None or r[0] % 10 == 0 or r[0] > 200] + [rows[7]] * 2
    got = t.neighbours(frame(spark, rows), frame(spark, queries), k=12, block=16, query_block=8).collect()
    want = brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows],
                 [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in queries], 12)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == sorted(w[:3] for w in want)
    assert np.allclose(sorted(r.score for r in got), sorted(w[3] for w in want), rtol=1e-12)


def test_components_beyond_the_squares_of_doubles(spark):
    rows = [(1, [1e200, 1.0]), (2, [1e200, 0.0]), (3, [1.0, 1.0]), (4, [-1e200, 1e200]), (20, [1e-3, 2.0]), (40, [1e200, 1e200])]
    wide = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in t.neighbours(wide, wide.where("vec_id % 20 = 0"), k=5, block=2).collect()}
    assert [got[20, k][0] for k in range(1, 6)] == [40, 4, 1, 2, 3]
    # 40 with 4: infinity minus infinity is no number, and counts as minus infinity
    assert [got[40, k] for k in range(1, 6)] == [(1, math.inf), (2, math.inf), (3, 2e200), (20, 1e-3 * 1e200 + 2e200), (4, -math.inf)] \
        or got[40, 3][0] == 20


def test_empty_tables(spark):
    one = frame(spark, [(20, [0.5, 0.1])])
    assert t.neighbours(one.limit(0), one).count() == 0 and t.neighbours(one, one.limit(0)).count() == 0
    assert t.neighbours(one, one).count() == 0
    assert t.neighbours(frame(spark, [(1, None)]), frame(spark, [(20, None)])).count() == 0


def test_bounds_hold_and_choose_few():
    """The slack holds for nearly all pairs, and what is reranked is a small part of the index."""
    rng = np.random.default_rng(11)
    values = rng.normal(0, 1, (4000, 64))
    values /= np.linalg.norm(values, axis=1)[:, None]
    centre, turn = values.mean(axis=0), t.rotation(64, 256)
    assert np.allclose(turn.T @ turn, np.eye(64))
    codes, norms, cosines = t.encode(values, centre, turn)
    assert codes.shape == (4000, 32)
    guess, slack = t.estimates(codes, norms, cosines, values[:100], centre, turn)
    off = np.abs(guess - values[:100] @ values.T)
    assert (off <= slack).mean() > 0.98 and abs((guess - values[:100] @ values.T).mean()) < 1e-3
    row = {"n": 0, "ids": np.arange(100).tobytes(), "originals": values[:100].tobytes(), "dims": 64}
    search = t.Search(row, 20, centre, turn, t.EPS)
    for at in range(0, 4000, 1000):
        part = slice(at, at + 1000)
        search.add({"ids": np.arange(at, at + 1000).tobytes(), "originals": values[part].tobytes(), "dims": 64, "codes": codes[part].tobytes(),
                    "norms": norms[part].tobytes(), "cosines": cosines[part].tobytes()})
    assert search.reranked < 0.2 * 100 * 4000
