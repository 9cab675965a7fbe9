"""Exact top-k inner products with an impact-ordered index, score at a time.

Components are quantised to ``floor(scale * x)``. The index holds, per block of at most
``BLOCK`` vectors, posting segments: one per (dimension, quantised impact), ordered by
descending absolute impact, and per level the norm of what each vector has left below it.
A query block walks a block's segments from the highest impact down and adds
``query component x impact`` to the accumulators of the segment's vectors. Between levels
the score of a vector is known up to ``norm(query) x norm(rest of the vector)``; a vector
whose upper bound is below the k-th best lower bound is proven out. The walk stops only when
so few vectors remain that their exact scores are cheaper, or when no segment is left;
every possible member is then scored exactly in integers. Impacts of zero have no segment.

Each query block meets each index block (see ``vector_blocks``); the best ``k`` per query are kept over all blocks
that a task sees, and those of the groups of blocks are merged by a window.

Defined results: vectors that are null, or hold null or non-finite components, or whose id is
null, take no part; vectors of other lengths count as padded with zeros; a query never meets
rows with its own id; rows that repeat an id each count; a repeated query row is answered
each time; an empty table gives an empty result; extra columns are ignored. Ties go to
the smaller id. Vectors with components beyond ``vector_blocks.safe`` are in no segment: they are scored with every
query in Python's whole numbers, as such queries are with every vector. Scores no long can hold are held at the ends
of its range (and are then ties).
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.llm.vector_blocks import blocks, exact_scores, first, matrix, meet, padded, safe, vectors, whole_numbers

SCALE = 64
BLOCK = 2048
QUERIES = 1024
#: Stop the walk when at most this share of a block can still be members.
FEW = 0.05

_BLOCKS = "ids binary, dims int, values binary, seg_dim binary, seg_impact binary, seg_start binary, postings binary, " \
    "large_rows binary, large_values binary"


def segments(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Dimension, impact and start of each posting segment by descending absolute impact, and the postings (row numbers)."""
    rows, dims = np.nonzero(values)
    impact = values[rows, dims]
    order = np.lexsort((rows, dims, impact, -np.abs(impact)))
    rows, dims, impact = rows[order], dims[order], impact[order]
    new = np.ones(len(rows), bool)
    new[1:] = (impact[1:] != impact[:-1]) | (dims[1:] != dims[:-1])
    start = np.flatnonzero(new)
    return dims[start], impact[start], np.append(start, len(rows)), rows


def _block(batch: pa.RecordBatch, scale: int) -> list:
    whole = whole_numbers(matrix(batch.column("embedding")), scale)
    large = np.flatnonzero(np.abs(whole).max(axis=1, initial=0) > safe(whole.shape[1]))
    values = whole.copy()
    values[large] = 0
    values = values.astype("<i8")
    dim, impact, start, rows = segments(values)
    return [batch.column("vec_id").to_numpy().astype("<i8").tobytes(), values.shape[1], values.tobytes(), dim.astype("<i4").tobytes(),
            impact.astype("<i8").tobytes(), start.astype("<i4").tobytes(), rows.astype("<i4").tobytes(), large.astype("<i8").tobytes(),
            whole[large].tobytes()]


def index(frame: DataFrame, scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """One row per block: ids, quantised vectors and posting segments. Vectors are dealt evenly, whatever their ids or values."""
    return blocks(vectors(frame), block, partial(_block, scale=scale), _BLOCKS)


class Block:
    """A block of the index, read from its row."""

    def __init__(self, ids: bytes, dims: int, values: bytes, seg_dim: bytes, seg_impact: bytes, seg_start: bytes,
                 postings: bytes, large_rows: bytes = b"", large_values: bytes = b""):
        self.ids = np.frombuffer(ids, "<i8")
        self.values = np.frombuffer(values, "<i8").reshape(len(self.ids), dims)
        self.large = np.frombuffer(large_rows, "<i8")
        self.large_values = np.frombuffer(large_values, "<f8").reshape(len(self.large), dims)
        self.dim, self.impact = np.frombuffer(seg_dim, "<i4").tolist(), np.frombuffer(seg_impact, "<i8")
        self.start = np.frombuffer(seg_start, "<i4").tolist()
        self.postings = np.frombuffer(postings, "<i4")

    def levels(self) -> list[tuple[int, int, int]]:
        """(absolute impact, first segment, end of segments) by descending impact."""
        level = np.abs(self.impact)
        cut = np.flatnonzero(np.diff(level)) + 1
        edges = [0, *cut.tolist(), len(level)] if len(level) else [0]
        return [(int(level[a]), a, b) for a, b in zip(edges, edges[1:])]

    def rest_norm(self, level: int) -> np.ndarray:
        """Norm of each vector's components of absolute impact below ``level``."""
        low = np.where(np.abs(self.values) < level, self.values, 0).astype(float)
        return np.sqrt((low * low).sum(axis=1))


def search(block: Block, query_ids: np.ndarray, queries: np.ndarray, k: int, few: float = FEW):
    """(query row, vector row, score) of the best ``k`` of the block for each query; ties to the smaller id."""
    n, dims = block.values.shape
    whole = padded(queries, dims)[:, :dims]
    beyond = np.abs(whole).max(axis=1, initial=0) > safe(dims)
    queries = np.where(beyond[:, None], 0, whole).astype(np.int64)
    norms = np.sqrt((queries.astype(float) ** 2).sum(axis=1))
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(block.values).max(initial=0)) * max(dims, 1)
    kind = np.float32 if largest < 2 ** 24 else np.float64       # whole numbers below are exact
    columns = np.ascontiguousarray(queries.T.astype(kind))
    score = np.zeros((n, len(queries)), kind)
    others = block.ids[:, None] != query_ids[None, :]
    score[~others] = -np.inf
    score[block.large] = -np.inf                # they raise no bar
    possible = None
    levels = block.levels()
    at = block.postings
    for position, (level, first, end) in enumerate(levels):
        for s in range(first, end):
            score[at[block.start[s]:block.start[s + 1]]] += columns[block.dim[s]] * kind(block.impact[s])
        rest = block.rest_norm(level)
        # worth a look only when what is left is small against the scores' spread
        if position + 1 < len(levels) and rest.mean() < 0.2 * np.sqrt((block.values.astype(float) ** 2).sum(axis=1)).mean():
            slack = np.outer(rest, norms) * (1 + 1e-6) + 1e-3
            found = _members(score, slack, k)
            if found.mean() <= few:
                possible = found
                break
    if possible is None:
        possible = _members(score, 0.0, k)
    possible[block.large] = others[block.large]
    possible[:, beyond] = others[:, beyond]
    row, query = np.nonzero(possible)
    exact = np.einsum("ij,ij->i", block.values[row], queries[query])
    apart = np.isin(row, block.large) | beyond[query]
    for q in np.unique(query[apart]):
        at = np.flatnonzero(apart & (query == q))
        held = block.values[row[at]].astype(float)
        for r, values in zip(block.large, block.large_values):
            held[row[at] == r] = values
        exact[at] = exact_scores(whole[q].astype(float), held)
    order = np.lexsort((block.ids[row], ~exact, query))
    row, query, exact = row[order], query[order], exact[order]
    begin = np.searchsorted(query, query, side="left")
    best = np.arange(len(query)) - begin < k
    return query[best], row[best], exact[best]


def _members(score: np.ndarray, slack, k: int) -> np.ndarray:
    """Vectors whose upper bound reaches the k-th best lower bound of the block."""
    if len(score) <= k:
        return score > -np.inf
    low = score - slack
    bar = np.partition(low, len(low) - k, axis=0)[len(low) - k]
    return (score + slack >= bar) & (score > -np.inf)


class Search:
    """A block of queries, which index blocks are added to."""

    def __init__(self, row: dict, k: int):
        self.k, self.n, held = k, row["n"], Block(**{c: x for c, x in row.items() if c != "n"})
        self.ids, self.values = held.ids, held.values.astype(float)
        self.values[held.large] = held.large_values
        self.query, self.found, self.score = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, row: dict) -> None:
        block = Block(**{c: x for c, x in row.items() if c != "n"})
        query, found, score = search(block, self.ids, self.values, self.k)
        query, found, score = (np.concatenate(x) for x in ((self.query, query), (self.found, block.ids[found]), (self.score, score)))
        best = first((~score, found), query, self.k)        # ~ falls as scores rise
        self.query, self.found, self.score = query[best], found[best], score[best]

    def result(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(self.query), self.n)), pa.array(self.query), pa.array(self.ids[self.query]),
                                           pa.array(self.found), pa.array(self.score)], ["n", "nth", "query_id", "vec_id", "score"])


def top_k(frame: DataFrame, queries: DataFrame, k: int = 20, scale: int = SCALE, block: int = BLOCK,
          query_block: int = QUERIES) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for each row of ``queries`` its ``k`` best rows of ``frame``."""
    best = meet(index(frame, scale, block), index(queries, scale, query_block), partial(Search, k=k),
                "n long, nth long, query_id long, vec_id long, score long")
    order = Window.partitionBy("n", "nth").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
