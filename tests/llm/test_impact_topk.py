"""Exact top-k against brute force: ties, bad vectors, repeats, early stops."""

import math

import numpy as np
import pytest

from ledgerloom.llm import impact_topk as t


def brute(rows, queries, k, scale=64):
    def good(r):
        return r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])

    def dot(a, b):
        return sum(math.floor(scale * float(x)) * math.floor(scale * float(y)) for x, y in zip(a, b))

    out = []
    for q in filter(good, queries):
        found = sorted((-dot(q[1], c[1]), c[0]) for c in filter(good, rows) if c[0] != q[0])[:k]
        out += [(q[0], i + 1, c, -s) for i, (s, c) in enumerate(found)]
    return sorted(out)


def table_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")


@pytest.mark.parametrize("block", [7, 64, 2048])
def test_all_rows_against_brute_force(spark, block):
    rng = np.random.default_rng(block)
    base = rng.normal(0, 0.2, (150, 16)).astype(np.float32)
    rows = [(i, [float(x) for x in v], "x") for i, v in enumerate(base)]
    rows += [(200 + i, rows[3][1], "x") for i in range(40)]                     # ties beyond k
    rows += [(300, None, "x"), (301, [1.0, None], "x"), (302, [float("nan")] * 16, "x"), (303, [float("inf")] + [0.0] * 15, "x"),
             (304, [0.0] * 16, "x"), (305, [0.5, -0.5], "x"), (306, [], "x"), (None, rows[0][1], "x"), (5, rows[5][1], "x")]
    queries = [r for r in rows if r[0] is None or r[0] % 5 == 0]
    got = t.top_k(table_of(spark, rows), table_of(spark, queries), k=20, block=block, query_block=16).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute(rows, queries, 20)


def test_empty_and_small_tables(spark):
    none = table_of(spark, [(1, [0.5], "x")]).limit(0)
    assert t.top_k(none, none).count() == 0
    one = table_of(spark, [(20, [0.5, 0.1], "x")])
    assert t.top_k(one, one).count() == 0                                       # its own row is no candidate
    two = table_of(spark, [(20, [0.5, 0.1], "x"), (3, [0.25, 0.0], "x")])
    assert [tuple(r) for r in t.top_k(two, one).collect()] == [(20, 1, 3, 32 * 16)]


def test_large_components(spark):
    """Any finite component takes part; scores beyond a long are held at its ends."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 6)]) for i in range(40)]
    rows += [(50, [1e300, 1.0, 0.0, 0.0, 0.0, 0.0]), (51, [1e300, 0.0, 0.0, 0.0, 0.0, 0.0]), (52, [3e8] * 6), (53, [-3e8] * 6), (54, [1.7e308] * 6),
             (55, [1.0] * 6), (56, [1e6, -1e6, 0.0, 0.0, 0.0, 0.0]), (57, [5e5] * 6), (60, [1e5, 1e-1, 0.0, 0.0, 0.0, 0.0])]
    wide = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ends = np.iinfo(np.int64)
    whole = {i: [math.floor(min(max(64 * x, -1.7976931348623157e308), 1.7976931348623157e308)) for x in v] for i, v in rows}
    want = []
    for q in (i for i, _ in rows if i % 10 == 0 or i > 49):
        found = sorted((-min(max(sum(a * b for a, b in zip(whole[q], whole[c])), ends.min), ends.max), c) for c in whole if c != q)[:20]
        want += [(q, n + 1, c, -x) for n, (x, c) in enumerate(found)]
    for block in (8, 2048):
        got = t.top_k(wide, wide.where("vec_id % 10 = 0 OR vec_id > 49"), block=block, query_block=16).collect()
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)


def test_walk_stops_on_proof_only():
    """With a few strong matches the walk ends early, and the result is still exact."""
    rng = np.random.default_rng(2)
    values = np.floor(64 * rng.normal(0, 0.05, (2000, 64))).astype(np.int64)
    queries = np.floor(64 * rng.normal(0, 0.3, (50, 64))).astype(np.int64)
    for i, q in enumerate(queries):
        values[i * 30:i * 30 + 25] = q + rng.integers(-1, 2, (25, 64))
    dim, impact, start, rows = t.segments(values)
    assert (np.diff(np.abs(impact)) <= 0).all() and len(rows) == (values != 0).sum()
    block = t.Block(np.arange(2000).astype("<i8").tobytes(), 64, values.astype("<i8").tobytes(), dim.astype("<i4").tobytes(),
                    impact.astype("<i8").tobytes(), start.astype("<i4").tobytes(), rows.astype("<i4").tobytes())
    seen = []
    rest = block.rest_norm
    block.rest_norm = lambda level: seen.append(level) or rest(level)
    query, found, score = t.search(block, np.full(50, -1), queries, 20)
    assert min(seen) > 1                                                        # low impacts were never walked
    exact = queries @ values.T
    for q in range(50):
        order = np.lexsort((np.arange(2000), -exact[q]))[:20]
        assert found[query == q].tolist() == order.tolist() and score[query == q].tolist() == exact[q][order].tolist()
