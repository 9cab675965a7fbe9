"""Sharding along a Hilbert curve over several metadata dimensions.

Source, language and size are quantised to ``BITS`` bits each: a string by its rank
among cut points, whole strings at equal distances in the sorted distinct values, so up to
2^BITS values all differ; a size by its rank among cut points of the sizes
(``approx_percentile`` over all rows). The cell's
index on the 3-dimensional Hilbert curve orders the rows, and the order is cut into
``shards`` runs whose counts differ by one at most (law ``rows``). Neighbours on the
curve are near in every dimension, so each run covers a small box of the metadata and
readers skip runs by their minima and maxima.

Only DataFrame functions: the curve is a walk through a small literal state table. Rows
move without their text; the order comes from a range partitioning on (cell, key), whose
partitions are counted and offset, so a hot cell spreads over many tasks.

Defined results: a null or empty text has size 1 and CRC 0; null sources and languages
are the lowest value of their dimension; a null ``doc_id`` sorts first and is kept;
repeated rows each get a slot of their own; an empty table gives an empty result; extra
columns are ignored. Ties in a cell go by ``doc_id``, CRC and size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.common import table

SHARDS = 8
BITS = 5
DIMENSIONS = ("source", "lang", "size")


def _rotate(x: int, by: int, n: int) -> int:
    by %= n
    return ((x << by) | (x >> (n - by))) & ((1 << n) - 1)


def curve_table(n: int) -> tuple[list[int], list[int]]:
    """Tables of an n-dimensional Hilbert curve: for state and cell corner, the rank of the corner and the next state.

    A state is the pair (entry corner, direction) of the subcube, by the rule of Hamilton and
    Rau-Chaplin: corners are ranked by Gray code in the rotated, reflected frame of the state.
    """
    def gray(i):
        return i ^ (i >> 1)

    def rank_of(g):
        out = 0
        while g:
            out ^= g
            g >>= 1
        return out

    def entry(i):
        return 0 if i == 0 else gray(2 * ((i - 1) // 2))

    def direction(i):
        if i == 0:
            return 0
        ones = lambda x: (~x & (x + 1)).bit_length() - 1  # noqa: E731  trailing ones
        return (ones(i - 1) if i % 2 == 0 else ones(i)) % n

    ranks, following = [], []
    for state in range((1 << n) * n):
        e, d = divmod(state, n)
        for corner in range(1 << n):
            w = rank_of(_rotate(corner ^ e, n - (d + 1) % n, n))
            e2 = e ^ _rotate(entry(w), d + 1, n)
            ranks.append(w)
            following.append(e2 * n + (d + direction(w) + 1) % n)
    return ranks, following


def hilbert_index(dimensions: list[Column], bits: int = BITS) -> Column:
    """Index on the curve of a cell given by one ``bits``-bit coordinate per dimension."""
    n = len(dimensions)
    ranks, following = (F.array(*map(F.lit, x)) for x in curve_table(n))
    corners = F.array(*[
        sum((F.shiftright(c, b).bitwiseAND(1) * (1 << (n - 1 - k)) for k, c in enumerate(dimensions)), F.lit(0))
        for b in reversed(range(bits))])

    def step(held, corner):
        at = held["state"] * (1 << n) + corner + 1
        return F.struct(F.element_at(following, at).alias("state"),
                        (held["index"] * (1 << n) + F.element_at(ranks, at)).alias("index"))

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("index"))
    return F.aggregate(corners, start, step)["index"]


def measured(docs: DataFrame) -> DataFrame:
    data = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    return docs.select(F.col("doc_id").cast("long"), (F.octet_length(data) + 1).cast("long").alias("size"),
                       F.crc32(data).alias("text_crc32"), F.col("source").cast("string"), F.col("lang").cast("string"))


def ranked(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    """The rows, written as table ``name``, with their ``rank`` (from 0) in the order of ``key`` and their number ``total``."""
    ordered = rows.repartitionByRange(*key).sortWithinPartitions(*key)
    # the id holds the partition in its upper bits and the place in the partition in its lower 33
    placed = table(ordered.withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    # a row per partition of the sort, so one task can add them up and every task can hold the sums
    in_order = Window.orderBy("part")
    starts = counts.select("part", (F.sum("n").over(in_order) - F.col("n")).alias("start"),
                           F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
                           .alias("total"))
    return placed.withColumn("part", part).join(F.broadcast(starts), "part") \
        .withColumn("rank", F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("at", "part", "start")


def string_cuts(rows: DataFrame, names: list[str], levels: int) -> dict[str, list[str]]:
    """For each string column, the values that begin a new level: at most ``levels`` - 1, in order.

    The distinct values (null is one) are sorted over the cluster and divided evenly: distinct ones, else
    one frequent value takes all cut points."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("d"), F.col(c).alias("v")) for c in names])).alias("p")
    values = ranked(rows.select(pairs).select("p.*").distinct(), ["d", "v"], "cut-values")
    spans = values.groupBy("d").agg(F.min("rank").alias("first"), F.count("*").alias("n"))      # a row per column
    place = F.col("rank") - F.col("first")
    level = lambda r: F.floor(r * levels / F.col("n"))
    cuts = values.join(F.broadcast(spans), "d").where((place > 0) & (level(place) > level(place - 1))).select("d", "v")
    return {c: sorted((r["v"] for r in cuts.where(F.col("d") == c).collect()), key=str.encode) for c in names}


def with_cells(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """Adds ``cell``, the Hilbert index. The cut points are 2^bits - 1 values at most in each dimension."""
    levels = 1 << bits
    cuts = string_cuts(rows, ["source", "lang"], levels)
    share = [k / levels for k in range(1, levels)]
    sizes = rows.agg(F.array_distinct(F.percentile_approx("size", share, 1000)).alias("cuts")).first()["cuts"] or []

    def literal(values, kind):
        return F.array(*map(F.lit, values)).cast(f"array<{kind}>")

    axes = [F.size(F.filter(literal(cuts["source"], "string"), lambda x: x <= F.col("source"))),
            F.size(F.filter(literal(cuts["lang"], "string"), lambda x: x <= F.col("lang"))),
            F.size(F.filter(literal(sizes, "bigint"), lambda x: x < F.col("size")))]
    return rows.withColumn("cell", hilbert_index(axes, bits))


def assign(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``cell``, ``shard`` (a run of the curve) and ``slot`` (place in the run)."""
    rows = with_cells(table(measured(docs), "shard-sizes"), bits)
    order = ranked(rows.select("doc_id", "size", "text_crc32", "cell"), ["cell", "doc_id", "text_crc32", "size"], "curve")
    # run k starts at the smallest rank r with r * shards DIV total = k
    return order.withColumn("shard", F.expr(f"CAST((rank * {shards}) DIV total AS INT)")) \
        .withColumn("slot", F.expr(f"rank - (shard * total + {shards - 1}) DIV {shards}")) \
        .select("doc_id", "size", "text_crc32", "cell", "shard", "slot")


def write_runs(docs: DataFrame, path: str, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Write the documents in curve order, a folder per run, and return the assignment.

    Rows are matched to their slot by ``doc_id``; files carry all columns of ``docs``, so Parquet's
    minima and maxima of source, language and size prune runs."""
    placed = table(assign(docs, shards, bits), "runs")
    slots = placed.groupBy(F.col("doc_id").alias("_id")).agg(F.min("shard").alias("shard"), F.min("slot").alias("_slot"))
    joined = docs.join(slots, docs["doc_id"].eqNullSafe(slots["_id"])).drop("_id")
    joined.repartitionByRange("shard", "_slot").sortWithinPartitions("shard", "_slot").drop("_slot") \
        .write.partitionBy("shard").parquet(path)
    return placed
