"""Quality rules from tokeniser fertility.

A public vocabulary measures how a text falls into tokens: characters per token,
share of byte-fallback tokens and token entropy. Natural prose of one language keeps
these in narrow bands; symbol noise, shouting, lists and loops do not. The bands are
learned from all documents that pass the base rules, by mergeable aggregates only:

* a trend over the length (log2 of the tokens), fitted over all of them, since long texts repeat tokens;
* per language (without one: per script) the median of what the trend leaves, shrunk towards
  the median of all by the number of documents: a language with few documents has a centre of
  its own that is uncertain, and a band that is wider by that uncertainty;
* one scatter of each measure, which falls with the root of the length for means over tokens.

A measure's score is its distance from the centre in units of that scatter. A document is rejected where
one score lies beyond ``ALONE``, or where few characters per token and low entropy come
together (``TOGETHER``). Nothing switches at a number of documents: with few of them the prior
slopes and spreads, stated below, carry more of the weight.

Defined results: a null or empty text has zero counts and fails the base rules;
repeated rows are judged one by one, each the same; a null ``doc_id`` or ``lang``
is carried through (null language: the script's bands); extra columns are ignored. A language that is known
from one document only is judged around that document, so the document passes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import prepare, row_batches, table, with_rows
from ledgerloom.llm.vocab import piece_vocab

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 8
MEASURES = ("chars_per_token", "byte_share", "entropy_share")
#: Scores beyond which a document is rejected: any measure alone, or characters per token and entropy share together.
ALONE = 6.0
TOGETHER = 4.25
#: What is held before any document is seen: slope per doubling of the tokens (with the weight of so many documents),
#: spread between languages, and the least scatter within one.
SLOPE = {"chars_per_token": 0.0, "byte_share": 0.0, "entropy_share": -0.05}
SLOPE_WEIGHT = 100
SPREAD = {"chars_per_token": 0.5, "byte_share": 0.05, "entropy_share": 0.03}
FLOOR = {"chars_per_token": 0.03, "byte_share": 0.005, "entropy_share": 0.01}
QUARTILES = 1.349       # distance of the quartiles of a normal distribution, in standard deviations

_SCRIPTS = (("latin", r"[A-Za-zÀ-ɏ]"), ("cyrillic", r"[Ѐ-ӿ]"), ("greek", r"[Ͱ-Ͽ]"), ("arabic", r"[؀-ۿ]"),
            ("hebrew", r"[֐-׿]"), ("devanagari", r"[ऀ-ॿ]"), ("kana", r"[぀-ヿ]"), ("han", r"[一-鿿]"),
            ("hangul", r"[가-힯]"))
_SCRIPTS = tuple((name, re.compile(rx)) for name, rx in _SCRIPTS)

SCHEMA = ("doc_id long, lang string, script string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, n_tokens long, chars_per_token double, byte_share double, entropy_share double")


def repeat_words(words: list[str], window: int = WINDOW) -> int:
    """Words covered by a window of ``window`` words that occurs twice or more in the text.

    Windows are compared by a 64-bit hash: two different windows of one text of n words
    agree with probability below n * n / 2 ** 64.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[str, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, len(words))
    code = mixed(code + np.uint64(1))
    key = np.zeros(n, np.uint64)
    for k in range(window):
        key = key * np.uint64(0x9E3779B97F4A7C15) + code[k:k + n]
    key = mixed(key)
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(twice), 1)
    np.add.at(edge, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads near keys over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def script_of(text: str) -> str:
    """The script with the most letters; ``none`` without letters of a known one."""
    if text.isascii():
        return "latin" if _SCRIPTS[0][1].search(text) else "none"
    counts = [(len(rx.findall(text)), -i) for i, (_, rx) in enumerate(_SCRIPTS)]
    most, at = max(counts)
    return _SCRIPTS[-at][0] if most else "none"


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    words = WORD.findall(text)
    seen: set[str] = set()
    dup = 0
    if "\n" in text:
        for line in text.split("\n"):
            if line in seen:
                dup += bool(WORD.search(line))
            else:
                seen.add(line)
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dup,
            repeat_words(words))


def fertility(ids: np.ndarray, n_chars: int, byte_ids: np.ndarray) -> tuple[int, float, float, float]:
    """Tokens, characters per token, byte-fallback share, and token entropy as a share of the most
    that so many tokens can have (log2 of their number)."""
    n = len(ids)
    if not n:
        return 0, 0.0, 0.0, 0.0
    _, counts = np.unique(ids, return_counts=True)
    p = counts / n
    entropy = float(-(p * np.log2(p)).sum()) / np.log2(n) if n > 1 else 1.0
    return n, n_chars / n, float(byte_ids[ids].mean()), entropy


def measure(docs: DataFrame, vocab_path: str | None = None, keep_rows: bool = False) -> DataFrame:
    """Base counts and fertility measures of every document; one narrow pass over whole texts.

    ``keep_rows`` adds the document's columns as the struct ``_row``."""
    prepare(docs.sparkSession)
    given = docs if keep_rows else docs.select("doc_id", "lang", "text")
    given = with_rows(given.withColumns({"doc_id": F.col("doc_id").cast("long"), "lang": F.col("lang").cast("string"),
                                         "text": F.col("text").cast("string")}))
    schema = SCHEMA + (f", _row {given.schema[0].dataType.simpleString()}" if keep_rows else "")
    names = [c.split()[0] for c in SCHEMA.split(", ")] + ["_row"] * keep_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = piece_vocab(vocab_path)
        for held, fields in row_batches(batches):
            texts = [t or "" for t in fields["text"].to_pylist()]
            rows = []
            for text, ids in zip(texts, vocab.encode(texts)):
                ids = np.frombuffer(ids, "<u4")
                n, cpt, share, entropy = fertility(ids, len(text), vocab.byte_ids)
                # the newline has no piece of its own: it is no sign of a foreign script
                share -= text.count("\n") / n if n else 0.0
                rows.append((script_of(text), *base_counts(text), n, cpt, max(share, 0.0), entropy))
            columns = [pa.array(x) for x in zip(*rows)]
            yield pa.RecordBatch.from_arrays([fields["doc_id"], fields["lang"], *columns, *[held] * keep_rows], names)
        vocab.forget()

    return given.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _doublings() -> Column:
    return F.log2(F.greatest("n_tokens", F.lit(1)))


def _noise(measure: str) -> Column:
    """The scatter of a document against one of 256 tokens."""
    return F.lit(1.0) if measure == "entropy_share" else 16 / F.sqrt(F.greatest("n_tokens", F.lit(1)))


def _key() -> Column:
    return F.coalesce(F.concat(F.lit("lang:"), "lang"), F.concat(F.lit("script:"), "script"))


def _over_trend(measured: DataFrame, slopes: dict[str, float], mean: float) -> DataFrame:
    """Adds the key and, per measure, ``rest_*``: what the trend over the length leaves."""
    return measured.withColumns({"key": _key()} | {
        f"rest_{m}": F.col(m) - F.lit(slopes[m]) * (_doublings() - F.lit(mean)) for m in MEASURES})


def centres(measured: DataFrame) -> tuple[DataFrame, dict]:
    """A row per key with its median of each measure beside the trend and its number of documents, and the
    numbers that hold for all: ``mean``, ``slopes``, ``middle``, ``scatter``, ``length_noise``."""
    good = measured.where(~base_failed())
    x = _doublings()
    fit = good.agg(F.count("*").alias("n"), F.avg(x).alias("mean"), F.var_pop(x).alias("var"),
                   *[F.covar_pop(x, F.col(m).cast("double")).alias(m) for m in MEASURES],
                   *[F.avg(_noise(m)).alias(f"noise_{m}") for m in MEASURES]).first()
    n, mean = fit["n"], fit["mean"] or 0.0
    slopes = {m: (n * (fit[m] or 0.0) + SLOPE_WEIGHT * SLOPE[m]) / (n * (fit["var"] or 0.0) + SLOPE_WEIGHT) for m in MEASURES}
    rest = _over_trend(good, slopes, mean)
    found = table(rest.groupBy("key").agg(F.count("*").alias("n"), *[
        F.percentile_approx(f"rest_{m}", 0.5).alias(f"median_{m}") for m in MEASURES]), "fertility-centres")
    middle = rest.agg(*[F.percentile_approx(f"rest_{m}", 0.5).alias(m) for m in MEASURES]).first()
    beside = rest.join(found, "key").agg(*[
        F.percentile_approx((F.col(f"rest_{m}") - F.col(f"median_{m}")) / _noise(m), [0.25, 0.75]).alias(m) for m in MEASURES]).first()
    return found, {"mean": mean, "slopes": slopes, "middle": {m: middle[m] or 0.0 for m in MEASURES},
                   "scatter": {m: (beside[m][1] - beside[m][0]) / QUARTILES if beside[m] else 0.0 for m in MEASURES},
                   "length_noise": {m: fit[f"noise_{m}"] or 1.0 for m in MEASURES}}


def scored(measured: DataFrame) -> DataFrame:
    """``measured`` with ``score_*``: each measure's distance from its centre, in units of its scatter."""
    found, known = centres(measured)
    rows = _over_trend(measured, known["slopes"], known["mean"]).join(found.withColumnRenamed("n", "n_key"), "key", "left")
    scores = {}
    for m in MEASURES:
        middle, scatter = F.lit(known["middle"][m]), F.lit(known["scatter"][m])
        between = F.lit(SPREAD[m] ** 2)
        within = F.greatest(scatter * known["length_noise"][m], F.lit(FLOOR[m])) ** 2
        # the weight of the key's own median against that of all, and how uncertain the centre remains
        own = F.when(F.col("n_key").isNull(), 0.0).otherwise(between / (between + within / F.col("n_key")))
        centre = middle + own * (F.coalesce(f"median_{m}", middle) - middle)
        scale = F.sqrt((scatter * _noise(m)) ** 2 + FLOOR[m] ** 2 + between * (1 - own))
        scores[f"score_{m}"] = (F.col(f"rest_{m}") - centre) / scale
    return rows.withColumns(scores).drop("key", "n_key", *[f"{k}_{m}" for k in ("rest", "median") for m in MEASURES])


def judge(docs: DataFrame, vocab_path: str | None = None, keep_rows: bool = False) -> DataFrame:
    """Measures, scores, ``base_failed``, ``kept`` and ``reason`` (``base``, the first measure out of its band, or
    ``together``) of every document."""
    out = scored(table(measure(docs, vocab_path, keep_rows), "fertility"))
    failed = base_failed()
    alone = [F.when(F.abs(f"score_{m}") > ALONE, F.lit(m)) for m in MEASURES]
    both = (F.col("score_chars_per_token") + F.col("score_entropy_share")) / 2 ** 0.5
    return out.withColumn("base_failed", failed) \
        .withColumn("reason", F.when(failed, F.lit("base")).otherwise(
            F.coalesce(*alone, F.when(both < -TOGETHER, F.lit("together"))))) \
        .withColumn("kept", F.col("reason").isNull())


def accepted(docs: DataFrame, vocab_path: str | None = None) -> DataFrame:
    """The documents that the rules keep, with their columns. Texts are written once and never shuffled."""
    return judge(docs, vocab_path, keep_rows=True).where("kept").select("_row.*")
