"""Main-text extraction: gradient-boosted trees over DOM nodes and hierarchical decoding.

Every element gets features of its subtree (text, density, links, blocks), its attribute
tokens, depth, position and siblings. Boosted trees score how likely it is part of the
article. Decoding picks the most likely labelling of the whole tree under the rule that
nothing below a dropped element is kept, so ancestors and descendants never contradict
each other.

There are no labelled pages, so the trees learn from pages that ``layouts`` composes: text of a
bounded sample of the given pages (``sample_pages`` rows by a hash of ``page_id``, cut into
sentences) set as article, menus, headers, footers, sidebars, notices, adverts, forms and
reader comments in many layouts, whose labels are known. The model is the same for every page
and goes out in a broadcast variable of some kilobytes.

Output: character references decoded, white space inside a block one space, blocks joined in
page order by one line feed; scripts, styles, the head and form controls never count as text.

Defined results: a null or empty page, or one without article text, has the empty text; broken
or unclosed markup is read as far as it goes; repeated rows are extracted one by one, each the
same; null ids and URLs are carried through; extra columns are ignored; a page of any
length is read whole. Without any text to compose training pages from, fixed words serve.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm import boosting
from ledgerloom.llm.common import prepare, slices

SAMPLE_PAGES = 200
LAYOUTS = 900

# Fixed values of HTML: elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript template".split())
HIDDEN = RAW | frozenset("head svg math canvas object audio video select datalist button option".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rb rp rt "
                   "s samp small span strike strong sub sup time tt u var wbr br img".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                     "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
         "option": {"select"}, "thead": {"table"}, "tbody": {"table"}, "p": {"button", "table", "td", "th", "caption", "object"}}
TAGS = ("html body div section article main p h1 h2 h3 h4 ul ol li dl table tr td th blockquote pre figure figcaption nav header "
        "footer aside form a span b i em strong code").split()

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*+>?|<\?[^>]*+>?|</?[a-zA-Z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?:>|[\"'][^>]*+>?)?", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|aria-label|data-y)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"\s+")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Page:
    """Elements in page order (0 is the document) and text runs as (element, text) in page order."""
    tags: list[str] = field(default_factory=lambda: ["#"])
    parents: list[int] = field(default_factory=lambda: [0])
    tokens: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    marks: list[str] = field(default_factory=lambda: [""])
    runs: list[tuple[int, str]] = field(default_factory=list)


def parse(source: str) -> Page:
    page = Page()
    tags, parents, runs = page.tags, page.parents, page.runs
    stack, hidden, at, n = [0], 0, 0, len(source)
    open_at: dict[str, list[int]] = {}      # the places in the stack at which a tag is open, so that no search walks the stack

    def nearest(names) -> int:
        return max((open_at[t][-1] for t in names if open_at.get(t)), default=0)

    def close_from(depth: int) -> int:
        """Close the elements from ``depth`` up; how many of them hid their text."""
        hid = 0
        while len(stack) > depth:
            tag = tags[stack.pop()]
            open_at[tag].pop()
            hid += tag in HIDDEN
        return hid

    search = _TAG.search
    while at < n:
        found = search(source, at)
        to = found.start() if found else n
        if to > at and not hidden:
            runs.append((stack[-1], source[at:to]))
        if not found:
            break
        at = found.end()
        text = found.group()
        if text[1] in "!?":
            continue
        name = _NAME.match(text).group(1).lower()
        if text[1] == "/":
            if open_at.get(name):
                hidden -= close_from(open_at[name][-1])
            continue
        closing, scope = (SAME.get(name) or ({"p"} if name in CLOSES_P else ())), SCOPE.get(name, SCOPE["p"])
        while closing and (depth := nearest(closing)) > nearest(scope):
            hidden -= close_from(depth)
            if name not in ("tr", "tbody", "thead"):
                break
        if name == "body" and open_at.get("head"):      # a head that was never closed
            hidden -= close_from(open_at["head"][-1])
        k = len(tags)
        tags.append(name)
        parents.append(stack[-1])
        tokens, mark = (), ""
        if "=" in text:
            words = []
            for a, *values in _ATTRIBUTE.findall(text):
                value = values[0] or values[1] or values[2]
                if a == "data-y":
                    mark = value
                else:
                    words += [w.lower() for w in _TOKEN.findall(value)]
            tokens = tuple(words)
        page.tokens.append(tokens)
        page.marks.append(mark)
        if name == "br" and not hidden:
            runs.append((stack[-1], " "))
        if name in VOID or text.endswith("/>") and name in HIDDEN:
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(source, at)
            if end is None:
                break
            close = source.find(">", end.end())
            at = n if close < 0 else close + 1
            continue
        open_at.setdefault(name, []).append(len(stack))
        stack.append(k)
        hidden += name in HIDDEN
    return page


def columns(page: Page) -> dict[str, list]:
    """Per element: sums over the subtree, and place in the page."""
    n = len(page.tags)
    tags, parents = page.tags, page.parents
    chars, words, stops, links, items, blocks = ([0] * n for _ in range(6))
    own = [0] * n
    depth, in_link, in_item = [0] * n, [False] * n, [False] * n
    for i in range(1, n):
        p = parents[i]
        depth[i] = depth[p] + 1
        in_link[i] = in_link[p] or tags[i] == "a"
        in_item[i] = in_item[p] or tags[i] in ("li", "option", "td")
    start, at = [-1] * n, 0
    for i, text in page.runs:
        size = len(text) - text.count("\n")
        if text.isspace():
            continue
        own[i] += size
        words[i] += text.count(" ") + 1
        stops[i] += text.count(". ") + text.count(",") + text.endswith(".")
        links[i] += size if in_link[i] else 0
        items[i] += size if in_item[i] else 0
        blocks[i] += 1
        if start[i] < 0:
            start[i] = at
        at += size
    chars = own[:]
    nodes, anchors, paras, fields = [1] * n, [0] * n, [0] * n, [0] * n
    for i in range(1, n):
        t = tags[i]
        anchors[i] = int(t == "a")
        paras[i] = int(t == "p")
        fields[i] = int(t in ("input", "textarea", "select", "button", "label"))
    kids, rank = [0] * n, [0] * n
    for i in range(1, n):
        rank[i] = kids[parents[i]]
        kids[parents[i]] += 1
    for i in range(n - 1, 0, -1):
        p = parents[i]
        for x in (chars, words, stops, links, items, blocks, nodes, anchors, paras, fields):
            x[p] += x[i]
        if start[i] >= 0 and (start[p] < 0 or start[i] < start[p]):
            start[p] = start[i]
    return {"chars": chars, "own": own, "words": words, "stops": stops, "links": links, "items": items, "blocks": blocks,
            "nodes": nodes, "anchors": anchors, "paras": paras, "fields": fields, "depth": depth, "kids": kids, "rank": rank,
            "start": start, "total": [max(at, 1)] * n}


def features(pages: list[Page], odds: dict[str, float]) -> np.ndarray:
    """A row per element of all pages, in order."""
    parts = [columns(p) for p in pages]
    c = {k: np.concatenate([np.array(p[k], float) for p in parts]) for k in parts[0]}
    base = np.cumsum([0] + [len(p.tags) for p in pages[:-1]])
    parent = np.concatenate([np.array(p.parents) + b for p, b in zip(pages, base)])
    code = {t: i for i, t in enumerate(TAGS)}
    tag = np.array([code.get(t, -1) for p in pages for t in p.tags], float)
    tag_odds = np.array([odds.get(f"<{t}>", 0.0) for p in pages for t in p.tags])
    get = odds.get
    low = np.array([min([get(w, 0.0) for w in t], default=0.0) for p in pages for t in p.tokens])
    high = np.array([max([get(w, 0.0) for w in t], default=0.0) for p in pages for t in p.tokens])
    low, high = np.minimum(low, 0), np.maximum(high, 0)
    worst, best = low.copy(), high.copy()
    worst_tag = tag_odds.copy()
    at = 0
    for p in pages:                                 # evidence of the ancestors, in page order
        for i in range(1, len(p.tags)):
            k, up = at + i, at + p.parents[i]
            worst[k], best[k] = min(worst[k], worst[up]), max(best[k], best[up])
            worst_tag[k] = min(worst_tag[k], worst_tag[up])
        at += len(p.tags)
    size = np.maximum(c["chars"], 1)
    up_size = np.maximum(c["chars"][parent], 1)
    rows = [np.log1p(c["chars"]), np.log1p(c["own"]), c["links"] / size, c["items"] / size, c["chars"] / c["nodes"],
            c["words"] / np.maximum(c["blocks"], 1), 100 * c["stops"] / size, c["chars"] / c["total"], c["depth"],
            c["kids"], c["rank"], (c["rank"] + 1) / np.maximum(c["kids"][parent], 1), c["start"] / c["total"],
            (c["start"] + c["chars"]) / c["total"], c["chars"] / up_size, c["links"][parent] / up_size,
            np.log1p(c["chars"][parent]), np.log1p(c["paras"]), np.log1p(c["anchors"]), c["fields"], c["fields"][parent],
            tag, tag_odds, low, high, worst, best, worst_tag, tag_odds[parent]]
    return np.stack(rows, axis=1)


def decode(page: Page, p: np.ndarray) -> list[bool]:
    """The most likely labels under the rule that all below a dropped element is dropped."""
    n = len(page.tags)
    p = np.clip(p, 1e-6, 1 - 1e-6)
    yes, no = np.log(p).tolist(), np.log1p(-p).tolist()
    open_, shut = yes[:], no[:]                     # best with the element kept; all dropped
    for i in range(n - 1, 0, -1):
        up = page.parents[i]
        shut[up] += shut[i]
        open_[up] += max(open_[i], shut[i])
    kept = [True] * n                               # the document itself is never dropped
    for i in range(1, n):
        kept[i] = kept[page.parents[i]] and open_[i] > shut[i]
    return kept


def text_of(page: Page, kept: list[bool]) -> str:
    """Blocks of the kept elements, in page order."""
    tags, parents = page.tags, page.parents
    out, held, last = [], [], None
    block = list(range(len(tags)))
    for i in range(1, len(tags)):
        if tags[i] in INLINE:
            block[i] = block[parents[i]]
    for i, text in page.runs:
        b = block[i]
        # a block that closed and goes on after another one starts a new block
        if b != last and held:
            out.append("".join(held))
            held = []
        last = b
        if kept[i]:
            held.append(text)
    out.append("".join(held))
    clean = (_SPACE.sub(" ", html_lib.unescape(x)).strip() for x in out)
    return "\n".join(x for x in clean if x)


# --- composed pages -------------------------------------------------------------------------

# Fixed class names by part of a page.
NAMES = {
    "main": "article post entry content story article-body post-content entry-content main-content page-content text body-copy",
    "wrap": "container wrapper page row column inner layout site grid block box panel region",
    "nav": "nav menu navbar navigation topnav breadcrumbs main-menu tabs toc pagination pager skip-links",
    "header": "header masthead site-header topbar banner logo brand site-title",
    "footer": "footer site-footer bottom copyright legal imprint colophon",
    "side": "sidebar aside widget related recommended rail popular trending teaser more-stories latest tag-cloud",
    "notice": "cookie-notice consent notice gdpr alert modal popup overlay cookie-banner message paywall subscribe newsletter",
    "ad": "ad ads advert advertisement sponsor sponsored promo ad-slot adsbygoogle promotion",
    "form": "form search login signup contact-form search-form subscribe-form",
    "comments": "comments comment-list reader-comments responses discussion disqus replies user-comments",
    "social": "share social follow sharing share-buttons social-links",
}
_ITEM = {"comments": "comment reply comment-body response post-comment", "side": "item teaser card", "nav": "item menu-item link"}
_SHORT = ("Home", "About", "Contact", "Privacy", "Terms", "Search", "Login", "Share", "Next", "Previous", "More", "Archive")


def layouts(sentences: list[str], n: int, seed: int = 3) -> list[str]:
    """``n`` composed pages; elements carry ``data-y`` ``main`` or ``noise`` where their part begins."""
    rng = np.random.default_rng(seed)
    if not sentences:
        sentences = ["The words of a page stand here.", "Another sentence follows it.", "Short one."]

    def pick(xs):
        return xs[int(rng.integers(len(xs)))]

    def chance(p):
        return rng.random() < p

    def say(low, high):
        return html_lib.escape(" ".join(pick(sentences) for _ in range(int(rng.integers(low, high + 1)))), quote=False)

    def words(most):
        return html_lib.escape(" ".join(pick(sentences).split()[:int(rng.integers(1, most + 1))]), quote=False)

    def name(kind, p=0.8):
        if not chance(p):
            return ""
        found = pick((NAMES[kind] if kind in NAMES else _ITEM[kind[1:]]).split())
        return f' {pick(["class", "class", "class", "id"])}="{found}"'

    def inline(text):
        parts = text.split(" ")
        if len(parts) > 6 and chance(0.4):
            at = int(rng.integers(len(parts) - 3))
            tag = pick(["b", "i", "em", "strong", "span", 'a href="/x"', "code"])
            parts[at] = f"<{tag}>{parts[at]}"
            parts[at + 2] += f"</{tag.split()[0]}>" if chance(0.9) else ""
        if chance(0.15):
            parts.insert(len(parts) // 2, "<br>")
        return " ".join(parts)

    def paragraph():
        closed = "</p>" if chance(0.85) else ""
        return pick([f"<p>{inline(say(1, 6))}{closed}"] * 8 + [f"<p>{words(4)}{closed}", f"<p><b>{say(1, 3)}<br>{closed}"])

    def article():
        return "".join(article_parts())

    def article_parts():
        parts = []
        if chance(0.75):
            parts.append(f"<h1>{words(9)}</h1>")
        for _ in range(int(rng.integers(1, 9))):
            parts.append(paragraph())
            r = rng.random()
            if r < 0.08:
                parts.append(f"<h{pick('234')}>{words(7)}</h2>")
            elif r < 0.13:
                parts.append(f"<ul>{''.join(f'<li>{say(1, 2)}</li>' for _ in range(int(rng.integers(2, 5))))}</ul>")
            elif r < 0.17:
                parts.append(f"<blockquote><p>{say(1, 2)}</p></blockquote>")
            elif r < 0.20:
                parts.append(f"<table><tr><td>{words(3)}</td><td>{words(3)}</td></tr></table>")
            elif r < 0.23:
                parts.append(f"<figure><img src=x><figcaption>{say(1, 1)}</figcaption></figure>")
            elif r < 0.25:
                parts.append(f"<pre>{words(8)}</pre>")
            elif r < 0.33:
                parts.append(noise(pick(["ad", "social", "side", "notice"])))
        return parts

    def link_list(most=7):
        # menus of plain words as well as long headlines
        long = chance(0.3)
        return "".join(f'<li{name("_nav", 0.2)}><a href="/{k}">{words(9) if long else pick([pick(_SHORT), words(2)])}</a></li>'
                       for k in range(int(rng.integers(2, most + 1))))

    def noise(kind):
        tag = {"nav": ["nav", "nav", "div", "ul"], "header": ["header", "header", "div"], "footer": ["footer", "footer", "div"],
               "side": ["aside", "aside", "div", "section"], "form": ["form", "form", "div"],
               "comments": ["section", "div", "div", "ol"]}.get(kind, ["div", "div", "section", "aside"])
        tag = pick(tag)
        plain = tag in ("nav", "header", "footer", "aside", "form")
        open_ = f'<{tag}{name(kind, 0.5 if plain else 1.0)} data-y="noise">'
        if kind == "nav":
            body = link_list() if tag == "ul" else pick([f"<ul>{link_list()}</ul>", "".join(f'<a href="#">{pick(_SHORT)}</a> ' for _ in range(4))])
        elif kind == "header":
            body = pick([f"<h1>{words(4)}</h1>", f'<a href="/">{words(3)}</a>', f"<p>{say(1, 1)}</p>", f"<span>{words(5)}</span>"])
        elif kind == "footer":
            body = pick([f"&copy; {words(3)} &middot; {say(1, 2)}", f"<p>&copy; 2020 {words(4)}</p>", f"<ul>{link_list()}</ul>", say(1, 3)])
        elif kind == "side":
            body = f"<h3>{words(3)}</h3>" * chance(0.6) + pick([f"<ul>{link_list()}</ul>", f"<p>{say(1, 2)}</p>",
                                                                "".join(f'<div{name("_side")}><a href="#">{words(8)}</a><p>{say(1, 1)}</p></div>' for _ in range(3))])
        elif kind == "notice":
            body = pick([say(1, 2), f"<p>{say(1, 3)}</p><button>OK</button>", f'{say(1, 2)} <a href="#">{words(2)}</a>'])
        elif kind == "ad":
            body = pick([say(1, 2), f'<a href="#">{words(6)}</a>', f"<p>{say(1, 1)}</p>", f"<span>{words(2)}</span><p>{say(1, 2)}</p>"])
        elif kind == "form":
            body = f'<label>{words(3)}</label><input name=q>{pick(["", f"<p>{say(1, 1)}</p>"])}<textarea>{words(3)}</textarea><button>{words(1)}</button>'
        elif kind == "social":
            body = "".join(f'<a href="#">{pick(_SHORT)}</a>' for _ in range(4))
        else:
            item = "li" if tag == "ol" else "div"
            body = f"<h3>{words(2)}</h3>" * (chance(0.6) and tag != "ol") + "".join(
                f'<{item}{name("_comments", 0.9)}><span class="author">{words(2)}</span>{pick(["<p>{}</p>", "{}"]).format(say(1, 4))}</{item}>'
                for _ in range(int(rng.integers(1, 7))))
        return f"{open_}{body}</{tag}>"

    out = []
    for _ in range(n):
        r = rng.random()
        if r < 0.15:
            core = f'<article data-y="main">{article()}</article>'
        elif r < 0.3:                               # no element of its own around the article
            core = "".join(x if 'data-y="noise"' in x[:80] else re.sub(r"^<(\w+)", r'<\1 data-y="main"', x)
                           for x in article_parts())
        else:
            tag = pick(["article", "article", "main", "div", "div", "div", "section", "td"])
            core = f'<{tag}{name("main", 0.5 if tag in ("article", "main") else 0.85)} data-y="main">{article()}</{tag}>'
            if tag == "td":
                core = f"<table><tr>{core}</tr></table>"
        if chance(0.5):
            tag = pick(["div", "main", "section"])
            core = f"<{tag}{name('wrap')}>{core}{''.join(noise(pick(['side', 'social', 'comments', 'ad', 'nav', 'form'])) for _ in range(int(rng.integers(0, 3))))}</{tag}>"
        above = [noise(k) for k in ("nav", "header", "notice", "ad", "form", "side") if chance(0.45)]
        below = [noise(k) for k in ("side", "comments", "ad", "form", "nav", "notice", "social") if chance(0.3)]
        if chance(0.8):
            below.append(noise("footer"))
        rng.shuffle(above)
        body = "".join(above) + core + "".join(below)
        if chance(0.4):
            body = f"<div{name('wrap')}>{body}</div>"
        if chance(0.5):
            body = body.replace("><", ">\n  <")
        out.append(f"<html><head><title>{words(5)}</title><script>x</script></head><body{name('wrap', 0.2)}>{body}"
                   + pick(["</body></html>", ""]))
    return out


def truth(page: Page) -> list[bool]:
    """Labels of a composed page: inside the article, or around some of it."""
    n = len(page.tags)
    state = [""] * n
    for i in range(1, n):
        state[i] = page.marks[i] or state[page.parents[i]]
    label = [s == "main" for s in state]
    for i in range(n - 1, 0, -1):
        if label[i]:
            label[page.parents[i]] = True
    return label


@dataclass(frozen=True)
class Model:
    trees: boosting.Trees
    odds: dict[str, float]

    def extract(self, sources: list[str]) -> list[str]:
        pages = [parse(s) for s in sources]
        if not pages:
            return []
        p = self.trees.predict(features(pages, self.odds))
        out, at = [], 0
        for page in pages:
            out.append(text_of(page, decode(page, p[at:at + len(page.tags)])))
            at += len(page.tags)
        return out


def train(sentences: list[str], n: int = LAYOUTS, seed: int = 3) -> Model:
    pages = [parse(s) for s in layouts(sentences, n, seed)]
    labels = [truth(p) for p in pages]
    seen: dict[str, list[int]] = {}
    for page, label in zip(pages, labels):
        for tag, tokens, mark, y in zip(page.tags, page.tokens, page.marks, label):
            for w in {*tokens, f"<{tag}>"}:
                seen.setdefault(w, [0, 0])[y] += 1
    odds = {w: float(np.log((b + 1) / (a + 1))) for w, (a, b) in seen.items() if a + b >= 3}
    x = features(pages, odds)
    return Model(boosting.fit(x, np.concatenate(labels).astype(float)), odds)


def sentences_of(pages: DataFrame, rows: int = SAMPLE_PAGES, most: int = 8000) -> list[str]:
    """Sentences of about ``rows`` pages, chosen by a hash of ``page_id`` from all of them: raw material, unlabelled."""
    known = pages.where("html IS NOT NULL")
    share = min(1.0, rows / max(known.count(), 1))
    plain = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style|title)\b.*?</\1\s*>|<!--.*?-->", " "), r"<[^>]*>", "\n")
    order = F.xxhash64(F.col("page_id").cast("long"), F.lit(9))
    got = known.where(F.pmod(order, F.lit(1 << 30)) < int(share * (1 << 30))) \
        .select(order.alias("o"), F.posexplode(F.split(plain, r"\n|(?<=[.!?])\s"))).where("length(trim(col)) BETWEEN 2 AND 400") \
        .orderBy(F.xxhash64("o", "pos"), "col").limit(most).collect()
    return sorted(html_lib.unescape(r["col"].strip()) for r in got)


def extract(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, model: Model | None = None) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""
    spark = pages.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(model or train(sentences_of(pages, sample_pages)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", 1 << 20):
            texts = sent.value.extract([h or "" for h in batch.column("html").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")) \
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")
