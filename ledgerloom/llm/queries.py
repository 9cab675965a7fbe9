"""One query per operator, each over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import (bond_negatives, dom_gbt, feistel_shards, group_whitening, grouping_packer, hilbert_shards, impact_topk,
                            one_bit_ann, piece_codec, prob_minhash, quality_rules, subword_langid, url_gbt)
from ledgerloom.llm.common import prepare, read


def op1_url_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_gbt.judge(read(spark, sf_dir, "pages"))


def op2_token_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "script", "n_tokens", "chars_per_token", "byte_share", "entropy_share", "reason")


def op3_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prob_minhash.classes(read(spark, sf_dir, "documents"))


def op4_dom_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dom_gbt.extract(read(spark, sf_dir, "pages"))


def op5_impact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return impact_topk.top_k(rows, rows.where("vec_id % 20 = 0"), k=20)


def op6_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feistel_shards.materialise(read(spark, sf_dir, "documents"))


def op7_piece_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digests(read(spark, sf_dir, "documents"))


def op8_subword_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return subword_langid.predict(docs, subword_langid.fit(docs))


def op9_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards.assign(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "cell")


def op10_grouping_packer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping_packer.pack(read(spark, sf_dir, "documents"))


def op11_bond_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return bond_negatives.mine(rows, rows.where("vec_id % 100 = 0"))


def op12_group_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_whitening.whiten(read(spark, sf_dir, "embeddings"))


def op13_one_bit_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return one_bit_ann.neighbours(rows, rows.where("vec_id % 20 = 0"))


_ALL = (op1_url_gbt, op2_token_fertility, op3_probminhash, op4_dom_gbt, op5_impact_topk, op6_feistel_shards,
        op7_piece_chunks, op8_subword_langid, op9_hilbert_shards, op10_grouping_packer, op11_bond_negatives,
        op12_group_whitening, op13_one_bit_ann)


def _prepared(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    return run


QUERIES = {fn.__name__: _prepared(fn) for fn in _ALL}
SQL: dict[str, str] = {
    "op5_impact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 20""",
    "op11_bond_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
near AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth FROM pairs WHERE same)
  WHERE nth <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM (
  SELECT n.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY n.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM near n JOIN pairs p ON n.anchor_id = p.anchor_id AND NOT p.same
   AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
WHERE rank <= 10""",
}
