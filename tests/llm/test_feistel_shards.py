"""Permutation, shard files and their manifest."""

import os
import zlib

import numpy as np
import pytest

from ledgerloom.llm import feistel_shards as f
from ledgerloom.llm.vocab import byte_vocab


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 100, 4097])
def test_permutation_is_one_to_one_and_invertible(size):
    p = f.Feistel(size)
    out = p.apply(np.arange(size))
    assert sorted(out.tolist()) == list(range(size))
    assert p.apply(out, inverse=True).tolist() == list(range(size))
    if size > 60:
        assert (out != f.Feistel(size, key=1).apply(np.arange(size))).mean() > 0.9
        assert abs(np.corrcoef(np.arange(size), out)[0, 1]) < 0.35


def expected(rows, sequence):
    out = []
    for doc_id, text in rows:
        ids = [*np.frombuffer(byte_vocab().encode([text or ""])[0], "<u4"), f.END_ID]
        for k in range(0, len(ids), sequence):
            part = np.array(ids[k:k + sequence], "<u4")
            out.append((doc_id, k // sequence, len(part), zlib.crc32(part.tobytes())))
    return sorted(out, key=repr)


def test_round_trip(spark, tmp_dir):
    rows = [(i, f"text number {i} " * (i % 37)) for i in range(300)] + [(5, "again"), (5, "again"), (None, "no id"), (400, None),
                                                                       (401, "long " * 30_000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, shard string").repartition(5)
    docs.write.parquet(f"{tmp_dir}/docs")
    docs = spark.read.parquet(f"{tmp_dir}/docs")
    f.write(docs, f"{tmp_dir}/out", sequence=16, shard_indices=2000, least_shards=3)
    got = f.manifest(spark, f"{tmp_dir}/out", sequence=16).collect()
    assert sorted(((r.doc_id, r.sequence, r.n_tokens, r.ids_crc32) for r in got), key=repr) == expected(rows, 16)
    assert sorted(r.slot for r in got) == list(range(len(got)))
    # one file per shard, records at their stride, slots in shard order
    for shard in {r.shard for r in got}:
        folder = f"{tmp_dir}/out/shard={shard}"
        files = [x for x in os.listdir(folder) if not x.startswith((".", "_"))]
        mine = sorted((r for r in got if r.shard == shard), key=lambda r: r.slot)
        assert len(files) == 1
        assert os.path.getsize(f"{folder}/{files[0]}") == len(mine) * f.stride(16)
        assert [r.byte_offset for r in mine] == [i * f.stride(16) for i in range(len(mine))]
        assert mine[-1].slot - mine[0].slot == len(mine) - 1
        with open(f"{folder}/{files[0]}", "rb") as data:                        # resume in the middle
            r = mine[len(mine) // 2]
            data.seek(r.byte_offset + f.HEADER_BYTES)
            ids = np.frombuffer(data.read(2 * r.n_tokens), "<u2").astype("<u4")
            assert zlib.crc32(ids.tobytes()) == r.ids_crc32


def test_order_depends_on_the_key_only_and_is_mixed(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    def slots(key):
        return {(r.doc_id, r.sequence): r.slot for r in f.materialise(docs, sequence=64, key=key).collect()}
    a, b, c = slots(1), slots(1), slots(2)
    assert a == b and a != c and a.keys() == c.keys()
    order = [k[0] for k, _ in sorted(a.items(), key=lambda x: x[1])]
    assert abs(np.corrcoef(np.arange(len(order)), order)[0, 1]) < 0.2
    assert f.materialise(docs.limit(0)).count() == 0
