"""Hard negatives by BOND: a vertical scan over the columns of blocks of vectors.

Components become whole numbers, ``floor(scale * x)``; a row's score is its inner product with the
anchor. Blocks hold their vectors by column, sorted by label, with the least and the greatest value of
each column. For each anchor the columns are read in the descending magnitude of its own
components, ``STEP`` at a time. The columns not read yet can add between the sums of the least
and of the greatest contributions ``anchor x column``, so each candidate's score is known up to these;
the bitmap of candidates loses those that cannot matter any more, and who is left when all columns are read
has its exact score.

1. Positives: among other rows of the anchor's label, the first ``positives`` by score. A candidate goes
   when its upper bound is below the k-th best score of earlier blocks, or the k-th best lower bound of this one.
2. Negatives: for each positive the window ``low x p <= 100 x score <= high x p``. A row of another
   label goes when for every window it is certainly above, below, or below the k-th best of the rows
   known to be inside. Whole numbers decide the windows exactly.

Both passes meet every anchor block with every index block (see ``vector_blocks``); the best of each group
are merged by a window.

Defined results: rows with a null label or id, or a vector that is null or holds null or non-finite
components, take no part; vectors of other lengths count as padded with zeros; an anchor's own id is no
candidate; rows that repeat an id each count; an anchor given twice is answered twice; a positive that
scores below zero has an empty window; an empty table gives an empty result; extra columns are ignored.
Ties go to the smaller id. Scores no long can hold are held at the ends of its range (and are then ties).
Vectors with components beyond ``vector_blocks.safe`` are scored in Python's whole numbers instead of by columns.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.llm.common import table
from ledgerloom.llm.vector_blocks import blocks, exact_scores, first, matrix, meet, safe, vectors, whole_numbers

SCALE = 256
BLOCK = 1024
ANCHORS = 256
STEP = 8

_COLUMNS = "ids binary, labels binary, columns binary, dims int"


def _index_block(batch: pa.RecordBatch, scale: int) -> list:
    values = whole_numbers(matrix(batch.column("embedding")), scale)
    ids, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
    order = np.lexsort((ids, labels))
    return [ids[order].tobytes(), labels[order].tobytes(), np.ascontiguousarray(values[order].T).tobytes(), values.shape[1]]


def _anchor_block(batch: pa.RecordBatch, scale: int) -> list:
    values = whole_numbers(matrix(batch.column("embedding")), scale)
    return [batch.column("vec_id").to_numpy().tobytes(), batch.column("label").to_numpy().tobytes(),
            np.ascontiguousarray(values.T).tobytes(), values.shape[1]]


class Block:
    """Columns of a block, and the rows with components too large for sums in doubles."""

    def __init__(self, row: dict, dims: int = 0):
        self.ids, self.labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
        columns = np.frombuffer(row["columns"], "<f8").reshape(row["dims"], len(self.ids))
        self.columns = np.pad(columns, ((0, dims - len(columns)), (0, 0))) if len(columns) < dims else columns
        self.large = np.abs(self.columns).max(axis=0, initial=0) > safe(len(self.columns))
        whole = np.where(self.large, 0, self.columns) if self.large.any() else self.columns
        self.low, self.high = whole.min(axis=1), whole.max(axis=1)


def vertical(block: Block, query: np.ndarray, candidates: np.ndarray, keep, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the bitmap ``candidates`` that ``keep(lower, upper)`` never lets go, and their exact scores."""
    query = np.pad(query, (0, max(0, len(block.columns) - len(query))))
    if np.abs(query).max(initial=0) > safe(len(query)):
        rows = np.flatnonzero(candidates)
        return rows, exact_scores(query, block.columns[:, rows].T)
    apart = np.flatnonzero(candidates & block.large)
    alive = np.flatnonzero(candidates & ~block.large)
    order = np.argsort(-np.abs(query), kind="stable")
    ends = np.stack([query * block.low, query * block.high])[:, order]
    least, most = (np.append(np.cumsum(side[::-1])[::-1], 0.0) for side in (ends.min(axis=0), ends.max(axis=0)))
    score = np.zeros(len(alive))
    for at in range(0, len(order), step):
        dims = order[at:at + step]
        part = block.columns[dims]
        score += query[dims] @ (part if len(alive) == part.shape[1] else part[:, alive])
        left = min(at + step, len(order))
        if left < len(order):
            kept = keep(score + least[left], score + most[left])
            if not kept.all():
                alive, score = alive[kept], score[kept]
        if not len(alive):
            break
    scores = score.astype(np.int64)
    if len(apart):
        alive, scores = np.append(alive, apart), np.append(scores, exact_scores(query, block.columns[:, apart].T))
    return alive, scores


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


class Scan:
    """A block of anchors, which index blocks are added to."""

    def __init__(self, row: dict, k: int):
        self.k, self.n = k, row["n"]
        self.ids, self.labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
        self.values = np.frombuffer(row["columns"], "<f8").reshape(row["dims"], len(self.ids)).T
        self.best: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}

    def bar(self, key: tuple) -> float:
        scores = self.best[key][0] if key in self.best else ()
        return scores[-1] if len(scores) == self.k else -np.inf

    def offer(self, key: tuple, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(scores):
            return
        if key in self.best:
            scores, ids = np.append(self.best[key][0], scores), np.append(self.best[key][1], ids)
        by = np.lexsort((ids, ~scores))[:self.k]    # ~ falls as scores rise, without a least long that has no negative
        self.best[key] = scores[by], ids[by]

    def result(self) -> pa.RecordBatch:
        keys = [(self.n, *key) for key, (scores, _) in self.best.items() for _ in scores]
        made = list(zip(*keys)) if keys else [[]] * 3
        parts = list(self.best.values())
        score, ids = (np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64) for c in (0, 1))
        return pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.int64()) for c in made], pa.array(ids), pa.array(score)], ["n", "nth", "window", "vec_id", "score"])


class Positives(Scan):
    def add(self, row: dict) -> None:
        block = Block(row, self.values.shape[1])
        for i, (own, label) in enumerate(zip(self.ids, self.labels)):
            same = np.zeros(len(block.ids), bool)
            same[np.searchsorted(block.labels, label):np.searchsorted(block.labels, label, side="right")] = True
            same &= block.ids != own
            bar = self.bar((i, 0))
            if same.any():
                rows, scores = vertical(block, self.values[i], same, lambda lower, upper: upper >= max(bar, _kth(lower, self.k)))
                self.offer((i, 0), scores, block.ids[rows])


class Negatives(Scan):
    """Also holds the windows: ``window`` rows of (nth, least score, greatest score)."""

    def __init__(self, row: dict, k: int):
        super().__init__(row, k)
        self.windows: list[list[tuple[int, int]]] = [[] for _ in self.ids]
        for nth, low, high in np.frombuffer(row["windows"], "<i8").reshape(-1, 3).tolist():
            self.windows[nth].append((low, high))

    def add(self, row: dict) -> None:
        block = Block(row, self.values.shape[1])
        for i, (own, label) in enumerate(zip(self.ids, self.labels)):
            if not self.windows[i]:
                continue
            other = (block.labels != label) & (block.ids != own)
            bars = [max(low, self.bar((i, w))) for w, (low, _) in enumerate(self.windows[i])]

            def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
                kept = np.zeros(len(lower), bool)
                for bar, (low, high) in zip(bars, self.windows[i]):
                    certain = lower[(lower >= low) & (upper <= high)]
                    kept |= (upper >= max(bar, _kth(certain, self.k))) & (lower <= high)
                return kept

            if other.any():
                rows, scores = vertical(block, self.values[i], other, keep)
                for w, (low, high) in enumerate(self.windows[i]):
                    inside = (scores >= low) & (scores <= high)
                    self.offer((i, w), scores[inside], block.ids[rows[inside]])


_FOUND = "n long, nth long, window long, vec_id long, score long"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("n", "nth", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         scale: int = SCALE, block: int = BLOCK, anchor_block: int = ANCHORS) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``rows`` and ``anchors``: ``vec_id``, ``embedding``, ``label``. ``low`` and ``high`` are hundredths of the positive's score."""
    label = F.col("label").cast("long").alias("label")
    index = blocks(vectors(rows, label).where("label IS NOT NULL"), block, partial(_index_block, scale=scale), _COLUMNS)
    asked = blocks(vectors(anchors, label).where("label IS NOT NULL"), anchor_block, partial(_anchor_block, scale=scale), _COLUMNS)
    near = table(_ranked(meet(index, asked, partial(Positives, k=positives), _FOUND), positives), "positives")

    def bounded(batches):
        """Each anchor block with the windows of its positives, in order of anchor and rank."""
        for batch in batches:
            windows = []
            for found in batch.column("found").to_pylist():
                made = [(f["nth"], -(-low * f["score"] // 100), high * f["score"] // 100) for f in sorted(found or [], key=lambda f: (f["nth"], f["rank"]))]
                ends = np.iinfo(np.int64)
                windows.append(np.array([(n, min(max(a, ends.min), ends.max), min(max(b, ends.min), ends.max)) for n, a, b in made],
                                        np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(windows, pa.binary())], [*names, "windows"])

    names = asked.columns
    # at most (anchors of a block x positives) rows a block
    held = near.groupBy("n").agg(F.collect_list(F.struct("nth", "rank", "score")).alias("found"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asked.schema)
    framed = table(asked.join(held, "n", "left").select(*names, "found").mapInArrow(bounded, f"{kinds}, windows binary"), "anchor-windows")
    far = _ranked(meet(index, framed, partial(Negatives, k=negatives), _FOUND), negatives)
    named = table(asked.select("n", "ids").mapInArrow(_names, "n long, nth long, anchor_id long"), "anchor-ids")
    pairs = near.select("n", "nth", (F.col("rank") - 1).cast("long").alias("window"), F.col("vec_id").alias("positive_id"),
                        F.col("score").alias("positive_score"))
    return far.join(pairs, ["n", "nth", "window"]).join(named, ["n", "nth"]) \
        .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                F.col("score").alias("negative_score"))


def _names(batches):
    for batch in batches:
        for n, ids in zip(batch.column("n").to_pylist(), batch.column("ids").to_pylist()):
            held = np.frombuffer(ids, "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(held), n)), pa.array(np.arange(len(held))), pa.array(held)],
                                             ["n", "nth", "anchor_id"])
