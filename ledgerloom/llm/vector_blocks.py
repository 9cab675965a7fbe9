"""Vectors in blocks, and blocks of queries that meet blocks of an index.

An index block is one row: the ids of up to ``size`` vectors and what an operator keeps of them,
as binary columns. A set of queries is cut into blocks in the same way. ``meet`` deals the index
over groups and the queries over slabs, and gives every (group, slab) to one task, which streams the
index blocks of the group past one query block after the other. So a task holds one query block and
one index block, whatever the sizes of both sides; each query's best rows are kept over all
blocks of a group, so that at most (queries x groups x k) rows leave the tasks. The number of groups
follows the session's shuffle partitions, not the data.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import prepare, table

#: Groups of index blocks at least, where there are as many blocks.
GROUPS = 16


def valid(column: str = "embedding") -> Column:
    """Not null, and without null or non-finite components."""
    return F.col(column).isNotNull() & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def vectors(frame: DataFrame, *extra: str) -> DataFrame:
    """``vec_id``, ``embedding`` (doubles) and ``extra`` columns of the rows that can take part."""
    return frame.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), *extra) \
        .where(F.col("vec_id").isNotNull() & valid())


def matrix(lists: pa.Array, dims: int | None = None) -> np.ndarray:
    """Rows of a list array as one matrix, padded with zeros to the longest row (or to ``dims``)."""
    offsets = lists.offsets.to_numpy()
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), int(sizes.max(initial=0)) if dims is None else dims))
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
    return out


def padded(values: np.ndarray, dims: int) -> np.ndarray:
    return np.pad(values, ((0, 0), (0, dims - values.shape[1]))) if values.shape[1] < dims else values


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale x value) as doubles; products beyond the doubles are held at the ends of their range."""
    most = np.finfo(float).max
    with np.errstate(over="ignore"):
        return np.floor(np.clip(scale * values, -most, most))


def safe(dims: int) -> float:
    """Sums of ``dims`` products of whole numbers up to this are exact in doubles."""
    return math.floor(math.sqrt(2 ** 53 / max(dims, 1)))


def exact_scores(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, held at the ends of the range of a long."""
    limit = safe(len(query))
    if np.abs(query).max(initial=0) <= limit and np.abs(rows).max(initial=0) <= limit:
        return (rows @ query).astype(np.int64)
    q = [int(x) for x in query]
    ends = np.iinfo(np.int64)
    return np.array([min(max(sum(a * int(b) for a, b in zip(q, row) if a and b), ends.min), ends.max) for row in rows],
                    np.int64)


def blocks(rows: DataFrame, size: int, make: Callable[[pa.RecordBatch], list[bytes | int]], columns: str) -> DataFrame:
    """One row (``n`` and ``columns``, a list of binary columns) per up to ``size`` rows; written. Rows are dealt evenly, whatever they hold."""
    spark = rows.sparkSession
    prepare(spark)
    names = [c.split()[0] for c in columns.split(", ")]
    kinds = [{"binary": pa.binary(), "int": pa.int32(), "long": pa.int64()}[c.split()[1]] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def made() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(make(whole), kinds)], names)

        for batch in batches:
            while batch.num_rows:
                take = batch.slice(0, size - n)
                held.append(take)
                n += take.num_rows
                batch = batch.slice(take.num_rows)
                if n == size:
                    yield made()
                    held, n = [], 0
        if n:
            yield made()

    width = min(-(-rows.count() // size), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return table(rows.repartition(max(1, width)).mapInArrow(run, columns).withColumn("n", F.monotonically_increasing_id()),
                 "vector-blocks")


def meet(index: DataFrame, queries: DataFrame, state: Callable, schema: str) -> DataFrame:
    """Every block of ``queries`` with every block of ``index``.

    ``state(row)`` is made for a query block; ``add(row)`` is called with each index block, and ``result()`` then
    gives a record batch. Rows are dicts. A query block may come back in the same task: what its results
    say is then said in parts, and is to be merged like that of other groups."""
    spark = index.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    many, asked = index.count(), queries.count()
    groups = max(1, min(many, max(GROUPS, math.isqrt(width))))
    slabs = max(1, min(asked, width // groups))
    # place of a block: its partition plus its place therein, so that groups are even
    place = lambda c: F.shiftright(F.col(c), 33) + F.col(c).bitwiseAND((1 << 33) - 1)
    cells = 2 * groups * slabs
    left = queries.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.pmod(place("n"), F.lit(slabs)).cast("int").alias("s"),
                          F.struct(*queries.columns).alias("q"))
    right = index.select(F.pmod(place("n"), F.lit(groups)).cast("int").alias("g"),
                         F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))).alias("s"), F.struct(*index.columns).alias("x"))
    # a fixed number of tasks: their work is not told by the bytes they read
    met = left.repartition(cells, "g", "s").join(right.repartition(cells, "g", "s").hint("merge"), ["g", "s"]).select("q", "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, None
        for batch in batches:
            for r in range(batch.num_rows):
                q = batch.column("q")[r]
                if q["n"].as_py() != name:
                    if held is not None:
                        yield held.result()
                    name, held = q["n"].as_py(), state(q.as_py())
                held.add(batch.column("x")[r].as_py())
        if held is not None:
            yield held.result()

    return met.mapInArrow(run, schema)


def first(order: tuple, group: np.ndarray, k: int) -> np.ndarray:
    """Row numbers sorted by ``group`` and then by the keys of ``order`` (first key first): the first ``k`` of each group."""
    by = np.lexsort((*reversed(order), group))
    found = group[by]
    return by[np.arange(len(by)) - np.searchsorted(found, found, side="left") < k]
