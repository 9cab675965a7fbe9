"""Approximate nearest neighbours by inner product over randomly rotated one-bit codes.

A vector ``o`` becomes ``r = o - centre`` (the mean of all vectors); ``r`` is padded with zeros to ``bits`` dimensions,
rotated by one random rotation, and kept as the signs of the result: ``bits`` packed bits. Two correction
scalars go with them: the norm ``|r|`` and ``f``, the cosine between the rotated ``r`` and its signs. With ``b`` the
signs divided by ``sqrt(bits)`` and ``q`` a rotated query,

    <centre, query> + |r| <b, q> / f

estimates ``<o, query>`` without bias, and is off by more than

    slack = eps |r| |query| sqrt((1 - f^2) / f^2) / sqrt(bits - 1)

with a probability that falls like exp(-c eps^2), whatever the data. Index blocks hold codes, scalars and the
original vectors. A query block takes one index block after the other: codes are unpacked and estimated
by one matrix product, a vector is chosen for reranking when ``estimate + slack`` reaches the k-th best
score known so far (the k-th exact score of earlier blocks, or the k-th largest ``estimate - slack`` of this one), and the
chosen ones are scored exactly on the original vectors in double precision. No number of candidates is
fixed: only the bounds choose. Every vector is in the index and meets every query; no cells are skipped,
since vectors that spread evenly over many dimensions have none. The only way to lose a neighbour
is a bound that fails; recall is measured against brute force in the tests.

Defined results: vectors that are null, zero or hold null or non-finite components, or whose id is null, take no
part; vectors of other lengths count as padded with zeros; a query never meets rows with its own id; rows
that repeat an id each count; a query row given twice is answered twice; an empty table gives an empty
result; extra columns are ignored. Ties go to the smaller id. Vectors with components beyond 1e150 have no
code and are always reranked; an inner product that is no number counts as minus infinity.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.llm.vector_blocks import blocks, first, matrix, meet, padded, vectors

BITS = 256
EPS = 2.4
BLOCK = 1024
QUERIES = 512
#: Components beyond this have squares a double cannot sum.
LARGE = 1e150
SEED = 13

_INDEX = "ids binary, originals binary, dims int, codes binary, norms binary, cosines binary"
_QUERIES = "ids binary, originals binary, dims int"
_FOUND = "n long, nth long, query_id long, vec_id long, score double"


def rotation(dims: int, bits: int, seed: int = SEED) -> np.ndarray:
    """``bits`` x ``dims``: what a random rotation of ``bits`` dimensions does to the first ``dims`` of them."""
    if not dims:
        return np.zeros((bits, 0))
    made, upper = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, dims)))
    return made * np.sign(np.diag(upper))


def encode(values: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, norms and cosines of the rows of ``values``; the norm is infinite where there is no code."""
    large = np.abs(values).max(axis=1, initial=0) > LARGE
    rest = np.where(large[:, None], 0.0, values - centre)
    norms = np.sqrt((rest * rest).sum(axis=1))
    turned = rest @ turn.T
    with np.errstate(invalid="ignore", divide="ignore"):
        cosines = np.abs(turned).sum(axis=1) / (np.sqrt(len(turn)) * norms)
    cosines = np.where(norms > 0, np.minimum(cosines, 1.0), 1.0)
    return np.packbits(turned >= 0, axis=1), np.where(large, np.inf, norms), cosines


def estimates(codes: np.ndarray, norms: np.ndarray, cosines: np.ndarray, queries: np.ndarray, centre: np.ndarray,
              turn: np.ndarray, eps: float = EPS) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries x rows) and their slack."""
    bits = len(turn)
    sizes = np.sqrt((queries * queries).sum(axis=1))
    unit = queries / sizes[:, None]
    signs = np.unpackbits(codes, axis=1, count=bits).astype(np.float32) * 2 - 1
    found = (unit @ turn.T).astype(np.float32) @ signs.T
    scale = norms / (cosines * np.sqrt(bits))
    off = eps * norms * np.sqrt(np.maximum(1 / cosines ** 2 - 1, 0) / max(bits - 1, 1))
    return (unit @ centre)[:, None] + found * scale, np.broadcast_to(off + 1e-5 * norms, found.shape)


def _index_block(batch: pa.RecordBatch, centre: np.ndarray, turn: np.ndarray) -> list:
    values = matrix(batch.column("embedding"), len(centre))
    codes, norms, cosines = encode(values, centre, turn)
    return [batch.column("vec_id").to_numpy().tobytes(), values.tobytes(), len(centre), codes.tobytes(), norms.tobytes(), cosines.tobytes()]


def _query_block(batch: pa.RecordBatch) -> list:
    values = matrix(batch.column("embedding"))
    return [batch.column("vec_id").to_numpy().tobytes(), values.tobytes(), values.shape[1]]


def _originals(row: dict, dims: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], "<i8")
    return ids, padded(np.frombuffer(row["originals"], "<f8").reshape(len(ids), row["dims"]), dims)


class Search:
    """A block of queries, which index blocks are added to. Scores are divided by the query's norm until they are exact."""

    def __init__(self, row: dict, k: int, centre: np.ndarray, turn: np.ndarray, eps: float):
        self.k, self.n, self.centre, self.turn, self.eps = k, row["n"], centre, turn, eps
        self.ids, self.values = _originals(row, len(centre))
        # queries are wider than the index only where it holds nothing to multiply with
        self.values = self.values[:, :len(centre)]
        with np.errstate(over="ignore"):
            self.sizes = np.sqrt((self.values * self.values).sum(axis=1))
        self.coded = np.isfinite(self.sizes) & (self.sizes > 0)
        self.bar = np.full(len(self.ids), -np.inf)
        self.query, self.found, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.reranked = 0

    def chosen(self, row: dict, ids: np.ndarray) -> np.ndarray:
        """Which rows of the block (columns) are reranked for which queries (rows)."""
        norms, cosines = np.frombuffer(row["norms"], "<f8"), np.frombuffer(row["cosines"], "<f8")
        codes = np.frombuffer(row["codes"], np.uint8).reshape(len(ids), -1)
        other = self.ids[:, None] != ids[None, :]
        picked = other.copy()
        near = np.flatnonzero(np.isfinite(norms))
        asked = np.flatnonzero(self.coded)
        if not len(near) or not len(asked):
            return picked
        guess, slack = estimates(codes[near], norms[near], cosines[near], self.values[asked], self.centre, self.turn, self.eps)
        low = np.where(other[np.ix_(asked, near)], guess - slack, -np.inf)
        bar = self.bar[asked] / self.sizes[asked]
        if len(near) >= self.k:
            bar = np.maximum(bar, np.partition(low, len(near) - self.k, axis=1)[:, len(near) - self.k])
        picked[np.ix_(asked, near)] &= guess + slack >= (bar - 1e-9 * np.abs(bar))[:, None]
        return picked

    def add(self, row: dict) -> None:
        ids, originals = _originals(row, len(self.centre))
        query, at = np.nonzero(self.chosen(row, ids))
        self.reranked += len(query)
        score = np.empty(len(query))
        with np.errstate(over="ignore", invalid="ignore"):
            for k in range(0, len(query), 65536):        # bounds the rows gathered at once
                part = slice(k, k + 65536)
                score[part] = (originals[at[part]] * self.values[query[part]]).sum(axis=1)
        score[np.isnan(score)] = -np.inf
        query, found, score = (np.concatenate(x) for x in ((self.query, query), (self.found, ids[at]), (self.score, score)))
        best = first((-score, found), query, self.k)
        self.query, self.found, self.score = query[best], found[best], score[best]
        ends = np.searchsorted(self.query, np.arange(len(self.ids)), side="right")
        full = ends - np.searchsorted(self.query, np.arange(len(self.ids))) == self.k
        self.bar[full] = self.score[ends[full] - 1]

    def result(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(self.query), self.n)), pa.array(self.query), pa.array(self.ids[self.query]),
                                           pa.array(self.found), pa.array(self.score)], ["n", "nth", "query_id", "vec_id", "score"])


def nonzero(frame: DataFrame) -> DataFrame:
    return vectors(frame).where(F.exists("embedding", lambda x: x != 0))


def centre_of(rows: DataFrame) -> np.ndarray:
    """Mean of all vectors, as long as the longest; zeros where a mean is no finite number."""
    parts = rows.select(F.posexplode("embedding").alias("d", "x")).groupBy("d").agg(F.sum("x").alias("x")).collect()
    many = max(rows.count(), 1)
    centre = np.zeros(max((p.d for p in parts), default=-1) + 1)
    for p in parts:
        centre[p.d] = p.x / many if abs(p.x) < LARGE else 0.0
    return centre


def neighbours(frame: DataFrame, queries: DataFrame, k: int = 20, bits: int = BITS, eps: float = EPS, block: int = BLOCK,
               query_block: int = QUERIES) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for each row of ``queries`` its ``k`` nearest found in ``frame``.

    Codes have ``bits`` bits, or as many as there are dimensions if that is more."""
    rows = nonzero(frame)
    centre = centre_of(rows)
    turn = rotation(len(centre), max(bits, len(centre)))
    index = blocks(rows, block, partial(_index_block, centre=centre, turn=turn), _INDEX)
    asked = blocks(nonzero(queries), query_block, _query_block, _QUERIES)
    found = meet(index, asked, partial(Search, k=k, centre=centre, turn=turn, eps=eps), _FOUND)
    order = Window.partitionBy("n", "nth").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the rows of ``exact`` (``query_id``, ``vec_id``) that ``found`` holds; copies of a vector count by their score."""
    bar = exact.groupBy("query_id").agg(F.min("score").alias("bar"), F.count("*").alias("many"))
    hit = found.join(bar, "query_id").where("score >= bar - 1e-9 * abs(bar)").groupBy("query_id").agg(F.count("*").alias("hits"))
    row = bar.join(hit, "query_id", "left").agg(F.sum(F.least("many", F.coalesce("hits", F.lit(0)))).alias("h"), F.sum("many").alias("m")).first()
    return float(row.h / row.m) if row.m else 1.0
