"""Curve, runs and pruning."""

import zlib

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import hilbert_shards as h


@pytest.mark.parametrize("n, bits", [(2, 3), (3, 2), (3, 3), (4, 2)])
def test_curve_visits_every_cell_in_unit_steps(spark, n, bits):
    side = 1 << bits
    cells = spark.range(side ** n).select(*[((F.col("id") / side ** k).cast("int") % side).alias(f"x{k}") for k in range(n)])
    rows = cells.withColumn("at", h.hilbert_index([F.col(f"x{k}") for k in range(n)], bits)).orderBy("at").collect()
    assert [r["at"] for r in rows] == list(range(side ** n))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[f"x{k}"] - b[f"x{k}"]) for k in range(n)) == 1


def test_cut_points_are_whole_strings(spark):
    values = [None, ""] + [f"common_crawl_{k}" for k in range(16)] + ["é", "src1", "z" * 5000]
    rows = spark.createDataFrame([(v, f"l{i % 100:03}") for i, v in enumerate(values * 40)], "source string, lang string")
    cuts = h.string_cuts(rows, ["source", "lang"], 32)
    assert cuts["source"] == sorted((v for v in values if v is not None), key=str.encode)      # every value a level of its own
    # 100 values over 32 levels, against the same division by hand
    assert cuts["lang"] == [f"l{i:03}" for i in range(1, 100) if i * 32 // 100 > (i - 1) * 32 // 100]
    docs = rows.select(F.monotonically_increasing_id().alias("doc_id"), F.lit("t").alias("text"), "source", F.lit("en").alias("lang"))
    placed = h.with_cells(h.measured(docs))
    assert placed.select("cell").distinct().count() == len(values)
    assert h.string_cuts(rows.limit(0), ["source", "lang"], 32) == {"source": [], "lang": []}


def check(rows, got, shards=8):
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id is not None) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows if i is not None)
    assert len(got) == len(rows)
    counts = [0] * shards
    for k in range(shards):
        slots = sorted(r.slot for r in got if r.shard == k)
        assert slots == list(range(len(slots)))
        counts[k] = len(slots)
    assert max(counts) - min(counts) <= 1
    cells = [r.cell for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert cells == sorted(cells)


def test_runs_of_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    check(rows, h.assign(docs).collect())


def test_hot_cell_nulls_and_repeats(spark):
    rows = [(i, "same text", "en", "hot") for i in range(400)] + [(i, "é" * (i % 50), None if i % 3 else "fr", f"s{i % 7}") for i in range(400, 600)]
    rows += [(1, "same text", "en", "hot")] * 3 + [(None, None, None, None), (700, None, "de", ""), (701, "x" * 300_000, "de", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("cell", F.lit("clash"))
    check(rows, h.assign(docs).collect())
    for n in (0, 1, 5):
        got = h.assign(docs.where("doc_id >= 400").limit(n)).collect()
        assert len(got) == n and len({(r.shard, r.slot) for r in got}) == n


def test_files_are_pruned_by_their_minima_and_maxima(spark, tmp_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    h.write_runs(docs, f"{tmp_dir}/runs")
    back = spark.read.parquet(f"{tmp_dir}/runs")
    assert back.count() == docs.count() and set(back.columns) == {*docs.columns, "shard"}
    spans = back.groupBy("shard").agg(F.min("source").alias("a"), F.max("source").alias("b"), F.min("n_chars").alias("c"),
                                      F.max("n_chars").alias("d")).collect()
    # a reader of one source and size range may skip runs
    met = sum(1 for r in spans if r.a <= "src3" <= r.b and r.c <= 200)
    assert met < len(spans)
