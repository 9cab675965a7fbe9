"""ProbMinHash: estimates, exact similarity, and classes against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import prob_minhash as m


def brute_similarity(a, b):
    total = 0.0
    for x in set(a) & set(b):
        total += 1 / sum(max(a.get(y, 0) / a[x], b.get(y, 0) / b[x]) for y in set(a) | set(b))
    return total


def weighted(counts):
    items = np.array(sorted(counts), np.uint64)
    return items, np.array([counts[int(i)] for i in items], float)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(0, 12), st.integers(1, 4)), st.dictionaries(st.integers(0, 12), st.integers(1, 4)))
def test_similarity_is_probability_jaccard(a, b):
    assert m.similarity(weighted(a), weighted(b)) == pytest.approx(brute_similarity(a, b))


@pytest.mark.parametrize("n, shared, heavy", [(400, 300, 1), (60, 50, 3), (8, 7, 1), (1, 1, 5)])
def test_registers_agree_as_often_as_the_sets_are_similar(n, shared, heavy):
    rng = random.Random(n)
    hits, registers = 0, 3000
    pool = [rng.getrandbits(64) for _ in range(2 * n)]
    a = {x: rng.randrange(1, heavy + 1) for x in pool[:n]}
    b = {x: a.get(x, 1) for x in pool[n - shared:2 * n - shared]}
    sa, sb = (m.signature(*weighted(x), registers) for x in (a, b))
    hits = (sa == sb).mean()
    assert abs(hits - brute_similarity(a, b)) < 0.04
    assert (m.signature(*weighted(a), registers) == sa).all()


def test_shingles_ignore_case_and_punctuation():
    a = m.word_hashes("The river, RIVER ran Éast; 2 miles")
    assert (a == m.word_hashes("the river river  ran\néast 2  miles!")).all() and len(a) == 7
    assert len(m.word_hashes("*** ###")) == 0 and len(m.word_hashes("")) == 0
    long = m.word_hashes(("x" * 70_000 + " y ") * 2)
    assert len(long) == 4 and long[0] == long[2] and long[1] == long[3]
    items, counts = m.shingles(m.word_hashes("a b c d e " * 3))
    assert len(items) == 5 and sorted(counts) == [2, 2, 2, 2, 3]
    assert len(m.shingles(m.word_hashes("two words"))[0]) == 1


def words(rng, n):
    return [f"{rng.choice('bcdfgklmnprst')}{rng.choice('aeiou')}{rng.randrange(300)}" for _ in range(n)]


def corpus(seed=5):
    """Unrelated texts, families of near copies, exact copies, and a passage that unrelated texts share."""
    rng = random.Random(seed)
    texts, passage = [], " ".join(words(rng, 40))
    for _ in range(60):
        texts.append(" ".join(words(rng, rng.randrange(1, 120))))
    for size in (2, 3, 30):
        base = words(rng, 150)
        for _ in range(size):
            copy = list(base)
            for at in rng.sample(range(150), 2):
                copy[at] = words(rng, 1)[0]
            texts.append(" ".join(copy))
    texts += [texts[0]] * 3 + [texts[61].upper() + "!"]
    texts += [passage + " " + " ".join(words(rng, 60)) for _ in range(25)]
    texts += ["", "", "*** ###", "*** ###", "***"]
    return texts


def brute_classes(texts):
    sets = [dict(zip(*[x.tolist() for x in m.shingles(m.word_hashes(t))])) if t is not None else {} for t in texts]
    name = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if texts[i] is not None and (texts[i] == texts[j] or brute_similarity(sets[i], sets[j]) >= 0.8):
                a, b = name[i], name[j]
                name = [min(a, b) if x in (a, b) else x for x in name]
    return name


def test_classes_match_brute_force(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("class_id", F.lit("clash"))
    got = {r.doc_id: r.class_id for r in m.classes(docs).collect()}
    assert got == dict(enumerate(brute_classes(texts)))
    kept = m.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))


def test_table_cases(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "A b c, d e f g"), (None, "a b c d e f g"), (3, None), (4, None),
            (5, long), (6, long + " end"), (7, "x y z u v w"), (7, "quite another text under one id here"),
            (8, "quite another text under one id here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.class_id) for r in m.classes(docs).collect()), key=repr)
    assert got == sorted([(1, 1), (1, 1), (2, 1), (None, None), (3, 3), (4, 4), (5, 5), (6, 5), (7, 7), (7, 7), (8, 7)], key=repr)
    kept = sorted((r.doc_id for r in m.deduplicated(docs).collect()), key=repr)
    assert kept == sorted([1, None, 3, 4, 5, 7], key=repr)
    assert m.classes(docs.limit(0)).count() == 0 and m.deduplicated(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    got = {r.id: r.class_id for r in m.components(spark.createDataFrame(links, "a long, b long")).collect()}
    name = {x: x for p in links for x in p}
    for _ in range(60):
        for a, b in links:
            name[a] = name[b] = min(name[a], name[b])
    assert got == {k: v for k, v in name.items() if k != v}


def test_pairs_per_bucket_are_linear(spark):
    members = spark.range(2000).selectExpr("id", "array(-7L, -8L, id) AS bands")
    ends, rows = m.shared_buckets(members)
    assert ends.count() == 2 and rows.count() == 4000 and m.star_pairs(rows).count() <= 2 * 2000


def test_copies_of_a_base_that_are_no_copies_of_each_other(spark):
    """Each copy is near its base alone, and the base has neither the smallest nor the largest id."""
    rng = random.Random(9)
    base = words(rng, 150)
    texts = []
    for i in range(9):
        copy = list(base)
        for at in ((14 * i + 6, 14 * i + 13) if i != 4 else ()):
            copy[at] = words(rng, 1)[0]
        texts.append(" ".join(copy))
    assert len(set(brute_classes(texts))) == 1 and len(set(brute_classes(texts[:4] + texts[5:]))) > 1
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.class_id for r in m.classes(docs).collect()} == {0}


@pytest.mark.parametrize("block", [128, 8])
def test_a_large_family_around_one_base(spark, monkeypatch, block):
    """Sixty copies, each near the base alone, are one class, in one block or in several."""
    monkeypatch.setattr(m, "BLOCK", block)
    rng = random.Random(11)
    base = words(rng, 1000)
    texts = []
    for i in range(61):
        copy = list(base)
        for at in rng.sample(range(1000), 17) if i != 30 else ():
            copy[at] = words(rng, 1)[0]
        texts.append(" ".join(copy))
    sets = [m.shingles(m.word_hashes(t)) for t in texts]
    assert all(m.similarity(sets[30], s) >= 0.8 for s in sets)
    assert all(m.similarity(sets[i], sets[j]) < 0.8 for i in range(61) for j in range(i) if 30 not in (i, j))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.class_id for r in m.classes(docs).collect()} == {0}


def sets_around(rng, n, base, swaps, repeat=False):
    """Sets of shingle hashes with ``swaps`` of a base's replaced; some with weights."""
    made = []
    for i in range(n):
        items = base.copy()
        items[rng.choice(len(base), swaps, replace=False)] = rng.integers(0, 1 << 63, swaps).astype(np.uint64)
        items = np.unique(items)
        made.append((items, np.where(np.arange(len(items)) % 7 == i % 7, 2.0, 1.0) if repeat and i % 3 == 0 else np.ones(len(items))))
    return made


def texts_of(sets, classes, bands):
    registers = np.stack([m._mix(m.signature(*s)).astype(np.uint8) for s in sets])
    return {"id": np.arange(len(sets)), "c": np.array(classes), "registers": registers, "bands": bands, "sets": sets}


@pytest.mark.parametrize("swaps, repeat", [(4, False), (6, True), (9, False)])
def test_joining_links_join_what_all_pairs_would(swaps, repeat):
    rng = np.random.default_rng(swaps)
    sets = sets_around(rng, 60, rng.integers(0, 1 << 63, 90).astype(np.uint64), swaps, repeat)
    classes = [i // 2 if i < 20 else i for i in range(60)]
    bands = np.column_stack([np.full(60, 5), np.where(np.arange(60) < 10, 3, np.arange(60) + 100), np.full(60, 9)])
    whole = texts_of(sets, classes, bands)
    found = m.joining(whole, whole, 5)

    def joined(links):
        name = {i: c for i, c in enumerate(classes)}
        for a, b in links:
            old, new = name[a], name[b]
            name = {i: new if c == old else c for i, c in name.items()}
        return sorted(sorted(i for i in name if name[i] == c) for c in set(name.values()))

    near = [(i, j) for i in range(60) for j in range(i) if (whole["registers"][i] == whole["registers"][j]).mean() >= m.FLOOR
            and m.similarity(sets[i], sets[j]) >= m.THRESHOLD]
    assert joined(found) == joined(near) and len(found) < 60                   # a spanning forest, not the pairs
    assert all(m.similarity(sets[a], sets[b]) >= m.THRESHOLD for a, b in found)
    assert m.joining(whole, whole, 9) == [] and m.joining(whole, whole, 3) == []    # 5 is the first bucket they share


def test_texts_of_one_base_become_no_pair_rows(spark):
    """Hundreds of texts that share buckets and are no copies give no row but their few links."""
    rng = random.Random(17)
    base = words(rng, 120)
    texts = []
    for _ in range(400):
        copy = list(base)
        for at in rng.sample(range(120), 3):
            copy[at] = words(rng, 1)[0]
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    members = m.sketches(docs).withColumnRenamed("doc_id", "id")
    _, rows = m.shared_buckets(members)
    items = m.shingled(docs, members.selectExpr("id", "content", "id AS exact_id"))
    none = spark.createDataFrame([], "id long, class_id long")
    sets = [m.shingles(m.word_hashes(t)) for t in texts]
    links = m.remaining_links(rows, members, none, items).collect()
    assert len(links) < 400 and all(m.similarity(sets[r.a], sets[r.b]) >= m.THRESHOLD for r in links)
    got = {r.doc_id: r.class_id for r in m.classes(docs).collect()}
    plain = [dict(zip(*[x.tolist() for x in s])) for s in sets]
    name = list(range(400))
    for i in range(400):
        for j in range(i):
            common = len(plain[i].keys() & plain[j].keys())
            if common >= 0.7 * len(plain[i]) and name[i] != name[j] and m.similarity(sets[i], sets[j]) >= 0.8:
                name = [min(name[i], name[j]) if x in (name[i], name[j]) else x for x in name]
    assert got == dict(enumerate(name))


def test_one_document_with_many_texts(spark):
    """Rows that share a doc_id are one class, without pairing them with each other."""
    rng = random.Random(3)
    texts = [" ".join(words(rng, 30)) for _ in range(300)]
    rows = [(1, t) for t in texts] + [(2, texts[17]), (3, texts[250] + " end"), (4, " ".join(words(rng, 30)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.class_id) for r in m.classes(docs).collect()) == [(1, 1)] * 300 + [(2, 1), (3, 1), (4, 4)]
