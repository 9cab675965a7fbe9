"""Extraction: known layouts, hierarchical decoding, broken markup."""

import html as html_lib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import boosting, dom_gbt as d

SENTENCES = [f"The {a} {b} of the {c} went {e}, and nobody minded it much." for a in ("old", "quiet", "northern")
             for b in ("keeper", "letter", "garden", "river") for c in ("mill", "school", "harbour") for e in ("east", "home", "away")]


@pytest.fixture(scope="module")
def model():
    return d.train(SENTENCES)


def test_unseen_layouts(model):
    pages = d.layouts(SENTENCES, 200, seed=77)
    right = 0
    for source, text in zip(pages, model.extract(pages)):
        page = d.parse(source)
        want = d.text_of(page, [True] + d.truth(page)[1:])
        right += text == want
    assert right >= 190


def test_decoding_never_contradicts_itself(model):
    rng = np.random.default_rng(1)
    for source in d.layouts(SENTENCES, 20, seed=5):
        page = d.parse(source)
        p = rng.uniform(0, 1, len(page.tags))
        kept = d.decode(page, p)
        assert all(kept[page.parents[i]] or not k for i, k in enumerate(kept))
        if len(page.tags) > 14:
            continue
        best = max((float(np.where(x, np.log(p), np.log1p(-p))[1:].sum()), x) for x in labellings(page))
        assert np.isclose(float(np.where(kept, np.log(p), np.log1p(-p))[1:].sum()), best[0])


def labellings(page):
    n = len(page.tags)
    for bits in range(1 << (n - 1)):
        x = [True] + [bool(bits >> i & 1) for i in range(n - 1)]
        if all(x[page.parents[i]] or not k for i, k in enumerate(x)):
            yield x


def test_pages_of_the_table(spark, model):
    """The articles of the given pages, read by their one template."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in d.extract(pages).collect()}
    for r in pages.collect():
        article = r.html.split("<article>", 1)[1].split("</article>")[0]
        blocks = [re.sub(r"\s+", " ", html_lib.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x)))).strip()
                  for x in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id].text == "\n".join(x for x in blocks if x)
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def test_markup_cases(model):
    body = " ".join(SENTENCES[:3])
    cases = {
        f"<article><h1>Title &amp; more</h1><p>{body}<br>next&nbsp;line\n\t here<p>unclosed {body}</article><footer>&copy; x</footer>":
            f"Title & more\n{body} next line here\nunclosed {body}",
        f"<script>if (a<b) x='</p>'</script><style>p{{}}</style><div class='post-content'><p>{body}</p></div><!-- <p>no</p> -->": body,
        f"<div id=comments><div class=comment><span>Ann</span><p>{SENTENCES[5]}</p></div></div><main class=story><p>{body}</p><p>{body}</p></main>":
            f"{body}\n{body}",
        f"<nav><a href=/a>Home</a></nav><article><p>{body}</p><p class=x>a < b and 1 > 0</p></article><form><label>Mail</label><input></form>":
            f"{body}\na < b and 1 > 0",
        "": "", "   ": "", "<html><head><title>t</title></head><body></body></html>": "", "<!-- only": "", "<": "<",
    }
    for source, want in cases.items():
        assert model.extract([source]) == [want], source
    deep = "<div>" * 3000 + body
    assert model.extract([deep, "<" * 500 + "p", '<a href="unclosed <p>' + body])


def test_hostile_nesting_is_read_in_linear_time(model):
    n = 100_000
    for source in ("<div>" * n + "</x>" * n, "<p><button>" + "<div>" * n, "<body>" * n, "<p><table>" + "<span>" * n + "<div>" * n):
        before = time.process_time()
        page = d.parse(source)
        assert len(page.tags) > n and time.process_time() - before < 5
    text = model.extract(["<div>" * 3000 + "</x>" * 3000 + "tail"])[0]
    assert isinstance(text, str)


def test_table_cases(spark, model):
    page = f"<article><p>{SENTENCES[0]}</p><p>{SENTENCES[1]}</p></article>"
    big = "<article>" + f"<p>{SENTENCES[2]}</p>" * 20_000 + "</article>"
    rows = [(1, "u", page, "x"), (1, "u", page, "x"), (2, None, None, "x"), (None, "v", "", "x"), (3, "w", big, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in d.extract(pages, model=model).collect()), key=repr)
    text = f"{SENTENCES[0]}\n{SENTENCES[1]}"
    whole = "\n".join([SENTENCES[2]] * 20_000)
    assert got == sorted([(1, "u", text, len(text))] * 2 + [(2, None, "", 0), (None, "v", "", 0), (3, "w", whole, len(whole))], key=repr)
    assert d.extract(pages.limit(0)).count() == 0
    assert d.extract(pages.where("html IS NULL")).first().text == ""


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (4000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = boosting.fit(x[:3000], y[:3000])
    assert ((model.predict(x[3000:]) > 0.5) == y[3000:]).mean() > 0.97
    assert np.allclose(boosting.fit(x, np.zeros(4000)).predict(x), 0, atol=2e-3)
