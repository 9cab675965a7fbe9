"""Language ID: averaged hashed subword embeddings with a linear softmax and calibrated rejection.

A text is lower-cased, all but letters become spaces, and its byte 3- and 4-grams are
hashed into ``BUCKETS`` rows of an embedding table. The mean row goes through a linear
softmax. Table and softmax are trained by stochastic gradient descent in numpy on a
bounded sample of labelled rows (``sample_rows`` rows, at most ``sample_grams`` n-grams
of each, evenly spread over the whole text). Every language gets the same number of sampled rows,
or all it has, so a rare one is learned too; one that still has few is shown more often
(with ``sample_rows`` languages or more, that many of the most frequent are learned). A part of the sample sets a temperature,
which falls with the number of n-grams, and the rejection threshold: the score below
which at most ``reject_share`` of its rightly predicted rows lie. Predictions read whole texts.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is
every text when no row is labelled. Null languages are not learned from. Repeated rows
are predicted one by one, each the same; a null ``doc_id`` stays null and counts as the
empty string in ``held_out``; extra columns are ignored. Equal scores go to the
language that sorts first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import prepare, row_batches, slices, with_rows

BUCKETS = 1 << 15
DIM = 8
GRAMS = (3, 4)
SAMPLE_ROWS = 4000
SAMPLE_GRAMS = 2000
LEAST_STEPS = 700
REJECT_SHARE = 0.002
UND = "und"
_LETTER = re.compile(r"[^\W\d_]")
_KEEP = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))
_BLOCK = 1 << 15


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray           # BUCKETS x DIM
    weights: np.ndarray         # DIM x languages
    bias: np.ndarray
    heat: tuple[float, float]   # temperature = heat[0] + heat[1] / sqrt(n-grams)
    threshold: float

    def predict(self, mean: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language and the calibrated score of each row."""
        logits = mean @ self.weights + self.bias
        p = softmax(logits / (self.heat[0] + self.heat[1] / np.sqrt(np.maximum(n, 1)))[:, None])
        best = p.argmax(axis=1)
        return best, p[np.arange(len(p)), best]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def normal(text: str) -> bytes:
    return text.lower().encode().translate(_KEEP)


def hashes(raw: np.ndarray, n: int) -> np.ndarray:
    """Bucket of the n-gram at each place that has n bytes after it."""
    h = np.full(max(0, len(raw) - n + 1), n, np.uint32)
    for k in range(n):
        h = h * np.uint32(0x01000193) + raw[k:k + len(h)]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return h >> np.uint32(32 - BUCKETS.bit_length() + 1)


def grams(text: str) -> np.ndarray:
    raw = np.frombuffer(b" " + normal(text) + b" ", np.uint8)
    return np.concatenate([hashes(raw, n) for n in GRAMS])


def means(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean embedding and number of n-grams of each text, in blocks of bounded size over whole texts."""
    parts = [b" " + normal(t) + b" " for t in texts]
    sizes = np.array([len(p) for p in parts])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    raw = np.frombuffer(b"".join(parts), np.uint8)
    total = np.zeros((len(texts), table.shape[1]))
    for at in range(0, len(raw), _BLOCK):
        to = min(at + _BLOCK, len(raw))
        first = int(np.searchsorted(ends, at, side="right"))
        last = int(np.searchsorted(starts, to, side="left"))
        cuts = np.maximum(starts[first:last], at) - at
        for n in GRAMS:
            rows = table[hashes(raw[at:to + n - 1], n)]
            over = np.maximum(ends[first:last, None] - np.arange(1, n), starts[first:last, None]).ravel() - at
            rows[over[(over >= 0) & (over < len(rows))]] = 0        # would reach into the next text
            keep = cuts[cuts < len(rows)]
            if len(keep):
                total[first:first + len(keep)] += np.add.reduceat(rows, keep, axis=0)
    count = sum(np.maximum(sizes - n + 1, 0) for n in GRAMS)
    return (total / np.maximum(count, 1)[:, None]).astype(np.float32), count


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def quota(counts: list[int], rows: int) -> float:
    """The number of rows per language with which all together give ``rows``, when smaller ones give all they have."""
    left = rows
    for k, n in enumerate(sorted(counts)):
        if n * (len(counts) - k) >= left:
            return left / (len(counts) - k)
        left -= n
    return max(counts)


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS, per_row: int = SAMPLE_GRAMS) -> tuple[list[str], list[np.ndarray]]:
    """Languages and n-grams of about ``rows`` labelled rows, chosen by a hash of id and text, an equal number per language."""
    spark = docs.sparkSession
    prepare(spark)
    labelled = docs.select("doc_id", F.col("lang").cast("string"), F.col("text").cast("string")) \
        .where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # at most ``rows`` rows reach the driver
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n"))
              .orderBy(F.desc("n"), "lang").limit(rows).collect()}
    if not counts:
        return [], []
    most = quota(list(counts.values()), rows)
    shares = spark.createDataFrame([(k, min(1.0, most / n)) for k, n in counts.items()], "lang string, share double")
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit(5)), F.lit(1 << 30)) / F.lit(1 << 30)
    chosen = labelled.join(F.broadcast(shares), "lang").withColumn("place", place / F.col("share")).where("place < 1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = []
            for text in batch.column("text").to_pylist():
                g = grams(text) if _LETTER.search(text) else np.array([], np.uint32)
                if len(g) > per_row:        # contiguous stretches, spread evenly over the whole text
                    at = np.linspace(0, len(g) - 20, per_row // 20).astype(int)
                    g = g[(at[:, None] + np.arange(20)).ravel()]
                found.append(g.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(found, pa.binary())], ["lang", "grams"])

    got = chosen.orderBy("place", "doc_id", "lang").limit(2 * rows).select("lang", "text").mapInArrow(run, "lang string, grams binary").collect()
    got = [(r["lang"], np.frombuffer(r["grams"], "<u4")) for r in got if r["grams"]]
    return [x[0] for x in got], [x[1] for x in got]


def train(languages: list[str], gram_lists: list[np.ndarray], epochs: int = 6, rate: float = 0.5, batch: int = 32,
          seed: int = 7, reject_share: float = REJECT_SHARE) -> Model | None:
    """Fit on four fifths of the rows, calibrate on the rest. Windows of random length teach short texts."""
    if not languages:
        return None
    names = tuple(sorted(set(languages)))
    y = np.array([names.index(x) for x in languages])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held = fit = order
    if len(y) >= 50:            # one row of each language is always fitted
        first = np.unique(y[order], return_index=True)[1]
        rest = np.delete(order, first)
        held = rest[:len(y) // 5] if len(rest) else order
        fit = np.concatenate([order[first], rest[len(y) // 5:]])
    # a language with less than a quarter of an even share of the rows is shown so often that it has that
    shown = np.bincount(y[fit], minlength=len(names))
    times = np.ceil(len(fit) / (4 * len(names)) / np.maximum(shown, 1)).astype(int)
    fit = np.repeat(fit, times[y[fit]])
    epochs = max(epochs, -(-LEAST_STEPS * batch // len(fit)))       # a small sample is gone through more often
    table = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    weights, bias = rng.normal(0, 0.3, (DIM, len(names))).astype(np.float32), np.zeros(len(names), np.float32)

    def window(g: np.ndarray) -> np.ndarray:
        n = min(len(g), int(2 ** rng.uniform(3, 9)))
        at = int(rng.integers(0, len(g) - n + 1))
        return g[at:at + n]

    steps, step = epochs * max(1, -(-len(fit) // batch)), 0
    for _ in range(epochs):
        rng.shuffle(fit)
        for k in range(0, len(fit), batch):
            lr, step = rate * (1 - step / steps), step + 1
            rows = [window(gram_lists[i]) for i in fit[k:k + batch]]
            sizes = np.array([len(r) for r in rows])
            flat = np.concatenate(rows)
            owner = np.repeat(np.arange(len(rows)), sizes)
            mean = np.add.reduceat(table[flat], np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
            grad = softmax(mean @ weights + bias)
            grad[np.arange(len(rows)), y[fit[k:k + batch]]] -= 1
            back = (grad @ weights.T) / sizes[:, None]
            weights -= lr * (mean.T @ grad) / len(rows)
            bias -= lr * grad.mean(axis=0)
            np.add.at(table, flat, (-lr * 4 * back)[owner])
    rows = [window(gram_lists[i]) if j % 2 else gram_lists[i] for j, i in enumerate(held)]
    n = np.array([len(r) for r in rows])
    mean = np.stack([table[r].mean(axis=0) for r in rows])
    truth = y[held]
    logits = mean @ weights + bias

    def loss(heat):
        p = softmax(logits / (heat[0] + heat[1] / np.sqrt(n))[:, None])
        return -np.log(np.maximum(p[np.arange(len(p)), truth], 1e-12)).mean()

    heat = min(((a, b) for a in (0.25, 0.35, 0.5, 0.7, 1.0, 1.4) for b in (0.0, 1.0, 2.0, 4.0, 8.0)), key=loss)
    model = Model(names, table, weights, bias, heat, 0.0)
    best, score = model.predict(mean, n)
    right = np.sort(score[best == truth])
    threshold = float(right[int(len(right) * reject_share)]) if len(right) else 0.0
    return Model(names, table, weights, bias, heat, min(threshold, 0.5))


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS, per_row: int = SAMPLE_GRAMS) -> Model | None:
    return train(*sample(docs, rows, per_row))


def predict(docs: DataFrame, model: Model | None, keep_rows: bool = False) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` and ``accepted``; one narrow pass over whole texts.

    ``keep_rows`` adds the document's columns as the struct ``_row``. The model (about a megabyte,
    whatever the data) travels in a broadcast variable.
    """
    spark = docs.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(model)
    given = (docs if keep_rows else docs.select("doc_id", "text")) \
        .withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    given = with_rows(given).withColumn("held_out", held_out("_row.doc_id"))
    schema = "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean" \
        + (f", _row {given.schema[0].dataType.simpleString()}" if keep_rows else "")
    names = ["doc_id", "held_out", "lang_pred", "score", "accepted"] + ["_row"] * keep_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            at = 0
            for held, fields in row_batches([batch], 2 << 20):
                texts = fields["text"].to_pylist()
                langs, scores = [UND] * len(texts), np.zeros(len(texts))
                told = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if model else []
                if told:
                    best, score = model.predict(*means([texts[i] for i in told], model.table))
                    for i, b, s in zip(told, best, score):
                        langs[i], scores[i] = model.languages[b], s
                good = [x != UND and bool(s >= model.threshold) for x, s in zip(langs, scores)]
                yield pa.RecordBatch.from_arrays(
                    [fields["doc_id"], batch.column("held_out").slice(at, len(texts)), pa.array(langs, pa.string()),
                     pa.array(scores), pa.array(good, pa.bool_()), *[held] * keep_rows], names)
                at += len(texts)

    return given.mapInArrow(run, schema)


def accepted(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents whose language is told with enough certainty, with their columns."""
    return predict(docs, fit(docs, rows), keep_rows=True).where("accepted").select("_row.*")
