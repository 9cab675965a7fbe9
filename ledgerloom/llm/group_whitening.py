"""Whitening of embeddings from distinct vectors and their multiplicities.

1. Every entry c becomes the long ``x = floor(scale * c) + shift``. Identical x vectors are one group with its count;
   Spark's partial aggregation folds the copies where they are read, so that a vector that
   makes up a third of all rows is a few rows in the shuffle.
2. The fit list is all vectors (``weights="counts"``: a group counts as often as it occurs) or one of each
   (``weights="one"``). n and the sums S are exact. Each task adds ``X' W X`` of its centred groups (centred before
   multiplying, by matrix products); the d x d sums are added by Spark.
3. The driver decomposes one d x d matrix. Components are its unit eigenvectors by falling
   eigenvalue; the entry of the largest magnitude is positive.
4. Each group is whitened once: ``(x - S/n)`` on each component, over the root of its eigenvalue. Its rows get
   the result by a join on x. Groups of more than 1/``HOT`` of all rows (fewer than ``HOT`` by that) are
   broadcast, so no task of the other join gets more than that share of the rows for one vector.

Defined results: rows whose vector is null or holds null or non-finite entries are dropped; rows with a null id stay;
rows that repeat an id each stay; vectors of other lengths count as padded with entries c = 0; x is held within +-2^53 (its
doubles are exact); components without variance (eigenvalue not above 1e-12 of the largest) are left out,
so that a table of one vector, or an empty table, gives no rows; a deviation no long can hold is null; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import prepare, table
from ledgerloom.llm.vector_blocks import valid

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
#: Groups of more than 1/HOT of all rows are joined by broadcast; there are fewer than HOT.
HOT = 256
FLAT = 1e-12
#: Values of groups whitened or multiplied at once.
CELLS = 1 << 19


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """``x`` and ``count`` of each group of identical vectors."""
    return rows.groupBy("x").agg(F.count("*").alias("count"))


def whole(frame: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vec_id`` and ``x`` of the rows that can take part."""
    good = frame.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(valid())
    dims = good.agg(F.max(F.size("embedding"))).first()[0] or 0
    ends = F.lit(float(2 ** 53 - abs(shift) - 1))
    x = F.transform("embedding", lambda c: (F.floor(F.greatest(-ends, F.least(ends, scale * c))) + F.lit(shift)).cast("long"))
    more = F.array_repeat(F.lit(shift).cast("long"), F.lit(dims) - F.size("embedding"))
    return good.select("vec_id", F.concat(x, more).alias("x"))


def _parts(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of batches with their x as a matrix of longs."""
    step = max(1, CELLS // max(dims, 1))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            lists = part.column("x")
            a, b = lists.offsets[0].as_py(), lists.offsets[-1].as_py()
            yield part, lists.values.to_numpy()[a:b].reshape(part.num_rows, dims)


class Fit:
    """n, the exact sums, the covariance, its components and eigenvalues."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray | None = None, components: int = COMPONENTS):
        self.n, self.sums = n, sums
        if covariance is not None:
            values, axes = np.linalg.eigh(covariance)
            values, axes = values[::-1], axes[:, ::-1]
            used = int((values[:components] > FLAT * values.max(initial=0.0)).sum())
            axes = axes[:, :used]
            if used:
                axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(used)])
            self.trace, self.values, self.axes = float(np.trace(covariance)), values[:used], axes

    def apart(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: longs where they fit, else Python's whole numbers."""
        bound = self.n * max(int(np.abs(x).max(initial=0)), 1) + max((abs(s) for s in self.sums), default=0)
        if bound < 2 ** 62:
            return self.n * x - np.array(self.sums, np.int64)
        return np.array([[self.n * int(v) - s for v, s in zip(row, self.sums)] for row in x], object).reshape(x.shape)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.apart(x).astype(float) / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        apart = self.apart(x)
        if apart.dtype == object or x.shape[1] * float(np.abs(apart).max(initial=0)) ** 2 >= 2 ** 62:
            made = [sum(int(v) * int(v) for v in row) for row in apart]
            return [v if v < 2 ** 63 else None for v in made]
        return (apart * apart).sum(axis=1).tolist()

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.axes / np.sqrt(self.values)


def _products(groups: DataFrame, dims: int, rows_of, weighted: bool) -> np.ndarray:
    """Sum over all groups of weight * y' y, for y = ``rows_of(x)`` (at most dims x dims numbers on the driver)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for part, x in _parts(batches, dims):
            y = rows_of(x)
            w = part.column("count").to_numpy().astype(float)[:, None] if weighted else 1.0
            total = (0 if total is None else total) + (y * w).T @ y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
                                             ["i", "row"])

    cells = groups.mapInArrow(run, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v")) \
        .groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    size = max((c.i for c in cells), default=-1) + 1
    out = np.zeros((size, size))
    for c in cells:
        out[c.i, c.j] = c.v
    return (out + out.T) / 2


def fit(groups: DataFrame, weights: str = "counts", components: int = COMPONENTS) -> Fit:
    """Fit over ``distinct_vectors``, each as often as it occurs (``counts``) or once (``one``)."""
    if weights not in ("counts", "one"):
        raise ValueError(f"weights are counts or one, not {weights}")
    dims = (groups.agg(F.max(F.size("x"))).first()[0] or 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, many = [0] * dims, 0
        for part, x in _parts(batches, dims):
            w = part.column("count").to_numpy() if weights == "counts" else np.ones(part.num_rows, np.int64)
            fits = int(np.abs(x).max(initial=0)) * int(w.sum()) < 2 ** 62
            found = w @ x if fits else [sum(int(c) * int(v) for c, v in zip(w, column)) for column in x.T]
            total, many = [t + int(f) for t, f in zip(total, found)], many + int(w.sum())
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, dims), pa.int32()), pa.array([Decimal(v) for v in (many, *total)], pa.decimal128(38, 0))],
                                         ["d", "s"])

    # one row per task and dimension; the number of vectors as dimension -1
    sums = groups.mapInArrow(run, "d int, s decimal(38,0)").groupBy("d").agg(F.sum("s").alias("s")).orderBy("d").collect()
    n, sums = (int(sums[0].s), sums[1:]) if sums else (0, [])
    made = Fit(n, [int(s.s) for s in sums])
    if not n or not sums:
        return Fit(n, made.sums, np.zeros((0, 0)))
    return Fit(n, made.sums, _products(groups, len(sums), made.centred, weights == "counts") / n, components)


def identity_error(groups: DataFrame, model: Fit, weights: str = "counts") -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, from the whitened vectors themselves."""
    if not len(model.values):
        return 0.0
    # a leading one gives the sums of each component along with the products
    rows_of = lambda x: np.column_stack([np.ones(len(x)), model.whitened(x)])
    sums = _products(groups, len(model.sums), rows_of, weights == "counts") / model.n
    covariance = sums[1:, 1:] - np.outer(sums[0, 1:], sums[0, 1:])
    return float(np.abs(covariance - np.eye(len(covariance))).max())


def whiten(frame: DataFrame, components: int = COMPONENTS, weights: str = "counts", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error`` for each row and component."""
    prepare(frame.sparkSession)
    rows = whole(frame, scale, shift)
    groups = table(distinct_vectors(rows), "distinct-vectors")
    model = fit(groups, weights, components)
    error = identity_error(groups, model, weights)
    dims = len(model.sums)
    explained = (model.values / model.trace).tolist() if len(model.values) else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _parts(batches, dims):
            yield pa.RecordBatch.from_arrays([part.column("x"), part.column("count"), pa.array(model.deviation(x), pa.int64()),
                                              pa.array(list(model.whitened(x)), pa.list_(pa.float64()))],
                                             ["x", "count", "deviation", "whitened"])

    if not explained:
        return rows.where("false").selectExpr("vec_id", "0 AS component", "0L AS n", "0L AS deviation", "0D AS whitened", "0D AS explained",
                                              "0D AS identity_error")
    done = table(groups.mapInArrow(run, "x array<bigint>, count bigint, deviation bigint, whitened array<double>"), "whitened-vectors")
    total = groups.agg(F.sum("count")).first()[0]     # of rows, also where each group counts once
    often = F.col("count") > total / HOT
    hot, cold = F.broadcast(done.where(often)), done.where(~often)
    made = rows.join(hot, "x").unionByName(rows.join(hot, "x", "left_anti").join(cold.hint("merge"), "x"))
    shares = F.array(*[F.lit(e) for e in explained])
    return made.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"))
