"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become token ids (those of the vocabulary's JSON file, its added tokens too) plus an end id. A document longer than a sequence is cut
into full pieces, of which the first may be shorter; all else stays whole. Pieces are
dealt at random over shards of about ``shard_items`` pieces, and each shard is packed
by ``islands`` populations in tasks of their own:

* An individual is a grouping of pieces into bins; the first ones come from best fit
  over decreasing and over shuffled sizes.
* Crossover injects the well-filled bins of one parent whole into another, removes
  the bins that now hold duplicates, and best-fits the displaced pieces.
* Mutation empties some ill-filled bins and best-fits their pieces.
* After each epoch the elite of every island migrates to the next one (a shuffle of
  the small assignment arrays; texts and ids are never shuffled).

A shard stops early only on proof: when it uses the fewest bins that its sizes allow.

Defined results: a null text is empty (the end id alone, one piece); repeated rows are
packed one by one; a null ``doc_id`` stays null; an empty table gives an empty result;
extra columns are ignored. Ties in size are broken by ``doc_id``, piece and digest.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import prepare, slices, table
from ledgerloom.llm.vocab import byte_vocab

CAPACITY = 2048
END_ID = 0
SHARD_ITEMS = 4000
ISLANDS = 3
EPOCHS = 2
POPULATION = 6
GENERATIONS = 6

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens: full ones, after a shorter first one."""
    first = n % capacity
    starts = ([0] if first else []) + list(range(first, n, capacity))
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], n])]


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocab_path: str | None = None,
           with_ids: bool = False) -> DataFrame:
    """The pieces of every document; ``with_ids`` adds their ids (little-endian uint32)."""
    prepare(docs.sparkSession)
    schema = PIECES + (", ids binary" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = byte_vocab(vocab_path)
        for batch in slices(batches, "text", 1 << 20):
            rows = []
            encoded = vocab.encode_added([t or "" for t in batch.column("text").to_pylist()])
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded):
                ids += end
                for k, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                    part = ids[4 * start:4 * (start + n)]
                    rows.append((doc_id, k, start, n, zlib.crc32(part), part)[:len(names)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows), [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.binary()])],
                names)
        vocab.forget()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


class Bins:
    """A grouping of items 0..n-1, sizes in decreasing order. Bins are lists of items."""

    def __init__(self, sizes: list[int], capacity: int, bins: list[list[int]] | None = None):
        self.sizes, self.capacity = sizes, capacity
        self.bins = bins if bins is not None else []

    def best_fit(self, items) -> None:
        """Put each item where it leaves the least room, in the given order."""
        sizes, capacity, bins = self.sizes, self.capacity, self.bins
        room = sorted((capacity - sum(map(sizes.__getitem__, b)), i) for i, b in enumerate(bins))
        for item in items:
            size = sizes[item]
            at = bisect_left(room, (size, -1))
            if at == len(room):
                bins.append([item])
                left = capacity - size
                to = len(bins) - 1
            else:
                left, to = room.pop(at)
                bins[to].append(item)
                left -= size
            if left:
                insort(room, (left, to))

    def fills(self) -> np.ndarray:
        return np.array([sum(map(self.sizes.__getitem__, b)) for b in self.bins], float) / self.capacity

    def worth(self) -> tuple[int, float]:
        """Fewer bins first, then fuller ones (the sum of squared fills tells crowded from even bins)."""
        return len(self.bins), -float((self.fills() ** 2).sum())

    def assignment(self) -> np.ndarray:
        out = np.empty(len(self.sizes), np.int32)
        for k, b in enumerate(self.bins):
            out[b] = k
        return out


def grouped(sizes: list[int], capacity: int, assignment: np.ndarray) -> Bins:
    order = np.argsort(assignment, kind="stable")
    cuts = np.flatnonzero(np.diff(assignment[order])) + 1
    return Bins(sizes, capacity, [b.tolist() for b in np.split(order, cuts)] if len(order) else [])


def crossover(a: Bins, b: Bins, rng: np.random.Generator) -> Bins:
    """A child of ``a`` that receives well-filled bins of ``b`` whole."""
    fills = b.fills()
    full = np.flatnonzero(fills >= max(0.98, float(np.quantile(fills, 0.6))))
    if not len(full):
        full = np.arange(len(fills))
    take = rng.choice(full, max(1, len(full) // 2), replace=False)
    injected = [list(b.bins[i]) for i in take]
    held = {i for x in injected for i in x}
    kept, displaced = [], []
    for x in a.bins:
        if held.isdisjoint(x):
            kept.append(list(x))
        else:
            displaced += [i for i in x if i not in held]
    child = Bins(a.sizes, a.capacity, injected + kept)
    child.best_fit(sorted(displaced))               # items are numbered by decreasing size
    return child


def mutate(a: Bins, rng: np.random.Generator) -> Bins:
    """Empty the worst bin and a few random ill-filled ones, and best-fit their items anew."""
    fills = a.fills()
    order = np.argsort(fills, kind="stable")
    some = {int(order[0]), *map(int, rng.choice(order[:max(1, len(order) // 4)], min(8, max(1, len(order) // 4)),
                                                replace=False))}
    child = Bins(a.sizes, a.capacity, [list(x) for i, x in enumerate(a.bins) if i not in some])
    moved = [i for k in some for i in a.bins[k]]
    child.best_fit(rng.permutation(moved).tolist() if rng.random() < 0.5 else sorted(moved))
    return child


def least_bins(sizes: list[int], capacity: int) -> int:
    """A proven lower bound: by volume, and by the items that cannot share a bin (Martello and Toth's L2)."""
    if not sizes:
        return 0
    s = np.sort(np.array(sizes, np.int64))
    total = np.concatenate([[0], np.cumsum(s)])
    best = -(-int(total[-1]) // capacity)
    half = np.searchsorted(s, capacity // 2, side="right")
    for k in np.unique(s[:half])[-200:]:
        big = len(s) - np.searchsorted(s, capacity - k, side="right")
        mid_from, mid_to = half, len(s) - big
        small_from = np.searchsorted(s, k, side="left")
        mid = mid_to - mid_from
        free = mid * capacity - int(total[mid_to] - total[mid_from])
        small = int(total[half] - total[small_from])
        best = max(best, int(big + mid + max(0, -(-(small - free) // capacity))))
    return best


def evolve(sizes: list[int], capacity: int, seed: int, population: int = POPULATION, generations: int = GENERATIONS,
           arrived: list[np.ndarray] = ()) -> list[np.ndarray]:
    """Assignments of the population, best first. ``sizes`` is in decreasing order."""
    rng = np.random.default_rng(seed)
    goal = least_bins(sizes, capacity)
    people = [grouped(sizes, capacity, a) for a in arrived]
    if not people:
        first = Bins(sizes, capacity)
        first.best_fit(range(len(sizes)))
        people = [first]
    while len(people) < population and min(len(p.bins) for p in people) > goal:
        # decreasing order with noise: near best-fit decreasing, yet different
        noise = np.argsort(-np.array(sizes) * rng.uniform(0.9, 1.1, len(sizes)), kind="stable")
        new = Bins(sizes, capacity)
        new.best_fit(noise.tolist())
        people.append(new)
    for _ in range(generations):
        people.sort(key=Bins.worth)
        if len(people[0].bins) <= goal:
            break
        children = []
        for _ in range(population // 2):
            a, b = people[int(rng.integers(0, max(1, len(people) // 2)))], people[int(rng.integers(0, len(people)))]
            children.append(crossover(a, b, rng) if a is not b else mutate(a, rng))
        children.append(mutate(people[0], rng))
        people = sorted(people + children, key=Bins.worth)[:population]
    people.sort(key=Bins.worth)
    return [p.assignment() for p in people]


def _ordered(items: pd.DataFrame) -> pd.DataFrame:
    return items.sort_values(["length", "doc_id", "piece", "ids_crc32", "start"], ascending=[False, True, True, True, True],
                             kind="stable", na_position="first", ignore_index=True)


def _open(items: pd.DataFrame, capacity: int) -> list[int]:
    """Sizes of the items that can share a bin; full pieces come first in the order and have bins of their own."""
    sizes = items["length"].tolist()
    return [s for s in sizes if s < capacity]


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocab_path: str | None = None,
         shard_items: int = SHARD_ITEMS, islands: int = ISLANDS, epochs: int = EPOCHS, seed: int = 11,
         population: int = POPULATION, generations: int = GENERATIONS) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``."""
    cut_up = table(pieces(docs, capacity, end_id, vocab_path), "pieces")
    shards = max(1, -(-cut_up.count() // shard_items))
    salt = F.xxhash64("doc_id", "piece", "ids_crc32", "start", F.lit(seed))
    # repeated rows share that hash: the random part keeps copies of one row apart, in whatever number
    items = table(cut_up.withColumn("shard", F.pmod(salt + F.floor(F.rand(seed) * 2**31), F.lit(shards))), "packing-items")
    state = "shard long, island int, rank int, assignment binary"
    best = max(1, population // 3)

    def first(key, frame):
        return told(key[0], key[1], frame, [], 0)

    def told(shard, island, frame, arrived, epoch) -> pd.DataFrame:
        sizes = _open(_ordered(frame), capacity)
        found = evolve(sizes, capacity, hash((seed, int(shard), int(island), epoch)) % 2**32, population, generations, arrived)
        solved = found and int(found[0].max(initial=-1)) + 1 <= least_bins(sizes, capacity)
        rows = []
        for k, a in enumerate(found[:1] if solved else found):
            data = a.astype("<i4").tobytes()
            rows.append((shard, island, k, data))
            if k < best and not solved:             # the elite migrates to the next island
                rows.append((shard, (island + 1) % islands, k + population, data))
        return pd.DataFrame(rows, columns=["shard", "island", "rank", "assignment"])

    small = items.select("shard", "doc_id", "piece", "start", "length", "ids_crc32")
    dealt = small.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(islands)])))
    states = dealt.groupBy("shard", "island").applyInPandas(first, state)

    def again(epoch):
        def run(key, frame, held):
            arrived = [np.frombuffer(x, "<i4") for x in held.sort_values("rank")["assignment"]]
            return told(key[0], key[1], frame, arrived, epoch)
        return run

    for epoch in range(1, epochs):
        states = dealt.groupBy("shard", "island").cogroup(states.groupBy("shard", "island")) \
            .applyInPandas(again(epoch), state)

    out = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def place(key, frame, held):
        frame = _ordered(frame)
        sizes = _open(frame, capacity)
        found = [np.frombuffer(x, "<i4") for x in held.sort_values(["rank", "island"])["assignment"]]
        bins = min((grouped(sizes, capacity, a) for a in found), key=Bins.worth).assignment() if sizes else np.array([], np.int64)
        own = len(frame) - len(sizes)
        frame["bin"] = np.concatenate([np.arange(own), bins.astype(np.int64) + own])
        frame = frame.sort_values("bin", kind="stable")
        frame["offset"] = frame.groupby("bin")["length"].cumsum() - frame["length"]
        frame["sequence_id"] = int(key[0]) * 2**32 + frame["bin"]
        return frame[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    return small.groupBy("shard").cogroup(states.groupBy("shard")).applyInPandas(place, out)
