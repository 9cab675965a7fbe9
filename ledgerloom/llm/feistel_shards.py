"""Training-order materialisation: token sequences in a keyed random order, as fixed-stride binary shards.

A document's ids and an end id are cut into sequences of ``SEQUENCE`` tokens, the last one
padded. Every sequence has an index: documents reserve ``ceil((bytes + 1) / SEQUENCE)``
indices, which byte-level tokens can never exceed, from running sums over the input partitions
(one cheap pass over text lengths; the partitions' sums are checked when the texts are
tokenised). A keyed Feistel network with cycle-walking permutes the M reserved indices; the
permuted value orders the sequences and names the shard (an equal range of values each).
Shards are written in that order, and a sequence's global slot is its place in them: slots are
gapless and in a uniformly random order that only the key decides.

A shard is one file of records of ``stride()`` bytes: ``doc_id`` (int64), sequence number in
the document (int32), tokens (uint16), flags (uint16, 1: null id), the ids as little-endian uint16, padding,
and a line feed. Slot s of a shard starts at byte ``s * stride()``, so readers run
sequentially and resume at any slot. Spark's text sink writes the raw records, hence its
commit protocol covers lost executors and any file system.

Defined results: a null text is empty (one sequence, the end id alone); repeated rows are
materialised one by one; a null ``doc_id`` comes back null; an empty table gives no shards;
extra columns are ignored; texts of any length are cut whole.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerloom.llm.common import prepare, slices
from ledgerloom.llm.vocab import byte_vocab
from ledgerloom.session import scratch_path

SEQUENCE = 512
END_ID = 50256
KEY = 0x5EED
ROUNDS = 6
SHARD_INDICES = 32_768
LEAST_SHARDS = 16
HEADER = "<qiHH"
HEADER_BYTES = struct.calcsize(HEADER)


def stride(sequence: int = SEQUENCE) -> int:
    return HEADER_BYTES + 2 * sequence + 1


class Feistel:
    """A keyed permutation of 0 .. size - 1: a balanced Feistel network on the next even power
    of two, walked along its cycle until it falls into the range."""

    def __init__(self, size: int, key: int = KEY, rounds: int = ROUNDS):
        self.size, self.rounds = size, rounds
        self.half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
        self.keys = np.random.default_rng(key).integers(0, 1 << 63, rounds, np.uint64)

    def _mixed(self, x: np.ndarray, key) -> np.ndarray:
        x = (x + key) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(32))) & np.uint64((1 << self.half) - 1)

    def _once(self, x: np.ndarray, inverse: bool) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> half, x & mask
        for key in self.keys[::-1] if inverse else self.keys:
            if inverse:
                left, right = right ^ self._mixed(left, key), left
            else:
                left, right = right, left ^ self._mixed(right, key)
        return (left << half) | right

    def apply(self, index, inverse: bool = False) -> np.ndarray:
        x = np.atleast_1d(np.asarray(index, np.uint64))
        out = self._once(x, inverse)
        while (far := out >= self.size).any():
            out[far] = self._once(out[far], inverse)
        return out.astype(np.int64)


def reserved(sequence: int):
    """Indices that a document reserves."""
    return F.floor((F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))) + sequence) / sequence)


def write(docs: DataFrame, path: str, sequence: int = SEQUENCE, end_id: int = END_ID, key: int = KEY,
          vocab_path: str | None = None, shard_indices: int = SHARD_INDICES, least_shards: int = LEAST_SHARDS) -> None:
    """Materialise ``docs`` under ``path``, a folder ``shard=k`` with one file per shard."""
    spark = docs.sparkSession
    prepare(spark)
    given = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sums = given.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(reserved(sequence)).cast("long").alias("n")) \
        .orderBy("p").collect()                     # a row per input partition
    total = sum(r["n"] for r in sums)
    starts, at = {}, 0
    for r in sums:
        starts[r["p"]] = (at, at + r["n"])
        at += r["n"]
    shards = max(least_shards, -(-total // shard_indices))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, order = byte_vocab(vocab_path), Feistel(total, key)
        at, last = starts.get(TaskContext.get().partitionId(), (0, 0))
        for batch in slices(batches, "text", 1 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            index, records = [], []
            for doc_id, text, ids in zip(batch.column("doc_id").to_pylist(), texts, vocab.encode(texts)):
                ids = np.append(np.frombuffer(ids, "<u4"), end_id).astype("<u2").tobytes()
                for k in range(-(-len(ids) // (2 * sequence))):
                    part = ids[2 * sequence * k:2 * sequence * (k + 1)]
                    index.append(at + k)
                    records.append(struct.pack(HEADER, doc_id or 0, k, len(part) // 2, doc_id is None) + part)
                at += (len(text.encode()) + sequence) // sequence
            place = order.apply(np.array(index))
            yield pa.RecordBatch.from_arrays(
                [pa.array(place * shards // total, pa.int32()), pa.array(place), pa.array(records, pa.binary())],
                ["shard", "place", "record"])
        vocab.forget()
        if at != last:
            raise RuntimeError("the input's partitions changed between two reads: write it to a table first")

    rows = given.mapInArrow(run, "shard int, place long, record binary")
    full = HEADER_BYTES + 2 * sequence
    padded = F.rpad(F.col("record"), full, F.lit(b"\0")).cast("string")     # bytes as they are
    rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("place") \
        .select("shard", padded.alias("value")).write.partitionBy("shard").text(path)


def manifest(spark: SparkSession, path: str, sequence: int = SEQUENCE) -> DataFrame:
    """Every record of the written shards: global ``slot``, ``shard``, ``byte_offset``, ``doc_id``, ``sequence``,
    ``n_tokens`` and the CRC of the ids (as little-endian uint32)."""
    prepare(spark)
    step = stride(sequence)
    shard = F.regexp_extract("path", r"/shard=(\d+)/[^/]*$", 1).cast("int")     # also without any file
    files = spark.read.format("binaryFile").load(path).select("length", "content", shard.alias("shard"))
    in_order = Window.orderBy("shard")              # a row per shard
    starts = files.select("shard", F.expr(f"length DIV {step}").alias("n")) \
        .select("shard", (F.sum("n").over(in_order) - F.col("n")).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, data in zip(batch.column("shard").to_pylist(), batch.column("content")):
                view = memoryview(data.as_buffer())
                rows = []
                for at in range(0, len(view), step):
                    doc_id, k, n, flags = struct.unpack_from(HEADER, view, at)
                    ids = np.frombuffer(view, "<u2", n, at + HEADER_BYTES).astype("<u4")
                    rows.append((shard, at, None if flags & 1 else doc_id, k, n, zlib.crc32(ids.tobytes())))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(zip(*rows), [pa.int32(), *[pa.int64()] * 2, pa.int32(), *[pa.int64()] * 2])],
                        ["shard", "byte_offset", "doc_id", "sequence", "n_tokens", "ids_crc32"])

    records = files.select("shard", "content").mapInArrow(
        run, "shard int, byte_offset long, doc_id long, sequence int, n_tokens long, ids_crc32 long")
    return records.join(F.broadcast(starts), "shard") \
        .select((F.col("start") + F.expr(f"byte_offset DIV {step}")).alias("slot"), "shard", "byte_offset", "doc_id",
                "sequence", "n_tokens", "ids_crc32")


def materialise(docs: DataFrame, sequence: int = SEQUENCE, key: int = KEY, vocab_path: str | None = None) -> DataFrame:
    """Write the shards to the shared folder and read their manifest back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-shards")
    write(docs, path, sequence, key=key, vocab_path=vocab_path)
    return manifest(spark, path, sequence)
