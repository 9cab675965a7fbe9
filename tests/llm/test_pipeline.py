"""The pipeline's stages against their operators, one by one, and its removal."""

import os
import subprocess
import sys

import corpus_pipeline as c
from ledgerloom.llm import prob_minhash, quality_rules
from ledgerloom.llm.common import table

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in c.STAGES] == ["quality rules", "language ID", "near-duplicates", "packing"]
    kept = table(c.quality(spark, docs, SF), "t")
    good = {r.doc_id for r in quality_rules.judge(docs).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == good and kept.columns == docs.columns and kept.exceptAll(docs).count() == 0
    told = table(c.language(spark, kept, SF), "t")
    assert told.columns == docs.columns and 0.95 * kept.count() <= told.count() <= kept.count()
    one = table(c.near_duplicates(spark, told, SF), "t")
    rows = sorted((r.doc_id, r.text) for r in told.collect())
    sets = [prob_minhash.shingles(prob_minhash.word_hashes(t)) for _, t in rows]
    name = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if name[i] != name[j] and prob_minhash.similarity(sets[i], sets[j]) >= 0.8:
                a, b = name[i], name[j]
                name = [min(a, b) if x in (a, b) else x for x in name]
    assert sorted(r.doc_id for r in one.collect()) == [rows[i][0] for i in sorted(set(name))]
    assert one.columns == docs.columns
    packed = c.packing(spark, one, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in one.collect()}
    assert sorted(map(tuple, c.run(spark, SF).drop("sequence_id", "offset").collect())) == \
        sorted(map(tuple, packed.drop("sequence_id", "offset").collect()))


def test_entry_works_without_the_subpackage():
    code = ("import sys; sys.modules['ledgerloom.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as e\n"
            "assert not any(k.startswith('op') or k == 'pipeline' for k in e.queries()), e.queries()\nassert len(e.queries()) > 40")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_all_are_registered():
    import __spark_entry__ as e
    names = [k for k in e.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14)) and "pipeline" in e.queries()
