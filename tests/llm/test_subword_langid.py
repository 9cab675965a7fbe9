"""Language ID: held-out accuracy, rejection and table cases."""

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import subword_langid as s


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = s.predict(docs, s.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    row = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.avg(F.col("accepted").cast("int")).alias("kept"),
                  F.min("score"), F.max("score"), F.count("*").alias("n")).first()
    assert row.n > 200 and row.right > 0.98 and row.kept > 0.98 and 0 <= row[2] and row[3] <= 1


def test_only_the_named_rows_teach(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    wrong = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    a, b = s.fit(docs), s.fit(wrong)
    assert "xx" not in b.languages and (a.table == b.table).all()
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert s.fit(unlabelled) is None
    assert s.predict(unlabelled, None).where("lang_pred <> 'und' OR score <> 0 OR accepted").count() == 0


def test_a_rare_language_is_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text IS NOT NULL")
    german = docs.where((F.col("lang") == "de") & ~s.held_out())
    few = docs.where("lang = 'en'").unionByName(german.orderBy("doc_id").limit(4))
    model = s.fit(few, rows=120)        # a uniform sample of that size would hold no German row or one
    assert model.languages == ("de", "en")
    got = s.predict(docs.where("lang IN ('de', 'en')"), model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right = {r.lang: r.right for r in got.groupBy("lang").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right")).collect()}
    assert right["de"] > 0.9 and right["en"] > 0.95, right


def test_quota_fills_the_sample():
    for counts, rows in (([3, 48_000], 4000), ([10, 20], 4000), ([5000] * 7, 4000), ([1, 10, 500, 90_000], 400)):
        most = s.quota(counts, rows)
        assert abs(sum(min(n, most) for n in counts) - min(rows, sum(counts))) < 1


def test_means_in_blocks_are_exact():
    rng = np.random.default_rng(0)
    table = rng.normal(size=(s.BUCKETS, s.DIM)).astype(np.float32)
    texts = ["", "abc", "Éa 12 b", "word " * 400_000, "x"]
    got, n = s.means(texts, table)
    for text, mean, count in zip(texts, got, n):
        rows = table[s.grams(text)]
        assert count == len(rows) and np.allclose(mean, rows.mean(axis=0, dtype=float) if len(rows) else 0, atol=1e-3), text[:20]


def test_table_cases(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = s.fit(docs)
    rows = [(1, None, None), (2, "", "en"), (3, "12 *** 34", "en"), (None, "Das ist der Fluss und die Stadt", None),
            (4, "The thing and the other " * 30_000, "fr"), (4, "The thing and the other " * 30_000, "fr")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = s.predict(odd, model).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == 6 and all(by_id[i].lang_pred == "und" and by_id[i].score == 0 and not by_id[i].accepted for i in (1, 2, 3))
    assert by_id[4].lang_pred == "en" and by_id[None].lang_pred in model.languages and by_id[None].held_out is False
    assert s.predict(odd.limit(0), model).count() == 0
    kept = s.accepted(docs.unionByName(odd.drop("score"), allowMissingColumns=True))
    assert kept.columns == docs.columns and kept.where("doc_id IN (1, 2, 3) AND n_chars IS NULL").count() == 0


def test_uncertain_texts_are_rejected():
    rng = np.random.default_rng(3)
    langs = {"aa": "abcdefgh", "bb": "stuvwxyz"}
    names, lists = [], []
    for i in range(200):
        name = ("aa", "bb")[i % 2]
        names.append(name)
        lists.append(s.grams("".join(rng.choice(list(langs[name] + " "), 80))))
    model = s.train(names, lists, reject_share=0.02)
    mean, n = s.means(["abc fgh bcd cab deh", "xyz stu vwx zyx", "abc xyz"], model.table)
    best, score = model.predict(mean, n)
    assert [model.languages[b] for b in best[:2]] == ["aa", "bb"] and score[:2].min() > score[2]
