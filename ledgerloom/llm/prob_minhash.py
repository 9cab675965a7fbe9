"""Near-duplicates by ProbMinHash on weighted word shingles, banding and exact verification.

A document is the weighted set of its five-word shingles (weight: how often it occurs);
two documents are near-duplicates when their probability Jaccard similarity

    J_P(A, B) = sum over common x of 1 / sum over y of max(a_y / a_x, b_y / b_x)

is 0.8 or more. With weights of one this is the plain Jaccard similarity.

1. Words are maximal runs of letters and digits (and any non-ASCII characters) of the
   lower-cased text; a text with one to four words has one shingle, its whole sequence. Equal
   word sequences are one text (``content``, 128 bits); texts without words are equal when
   the raw texts are.
2. ProbMinHash: every shingle starts a Poisson process whose rate is its weight. Each
   arrival goes to a register drawn from the shingle's hash, a register keeps the shingle
   of its earliest arrival, and a shingle stops as soon as its next arrival is later than
   every register of its text. P(two registers agree) = J_P.
3. Banding: ``BANDS`` x ``ROWS`` registers. In each bucket every text is paired with the
   smallest and the largest id of the bucket, which connects most families at once.
4. Verification: pairs whose registers agree too seldom are dropped (``FLOOR``, more than four
   standard deviations below the threshold); J_P of the others is computed exactly from all their
   shingles. Each text's shingles are made once.
5. Classes are the connected components of the verified links.
6. All other pairs: buckets that still hold several classes are dealt over blocks of texts with their classes,
   registers and shingles, and each two blocks of a bucket meet in one task. There the registers
   of all texts of different classes are compared; a pair that passes ``FLOOR`` is verified at once, exactly, in the first
   bucket that it shares. A link joins two classes in that task, so that pairs within the joined class are no longer tested, and only
   links that join classes leave the task: fewer than there are texts in the two blocks. Pairs never become rows.
   After this no pair that shares a bucket and not a class is left untested, and the components are taken again. The comparisons
   of a bucket grow with the square of its texts that are in no common class; rows do not.

At J_P = 0.8 a pair shares no bucket with probability (1 - 0.8^4)^24 < 4e-6, and is expected to
share ten of them.

Equal texts are one node of all this, named by a number; a document with several texts links its nodes.
The smallest ``doc_id`` of a class names it.

Defined results: rows that share a ``doc_id`` are one document with several texts and share
a class; a null text, or a null ``doc_id``, joins no class (class null for a null id); empty
texts are copies of each other; repeated rows give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.llm.common import prepare, slices, table

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
FLOOR = 0.62
#: Texts a block, and blocks a bucket up to which blocks stay as small; larger buckets have blocks of up to LARGEST texts.
BLOCK, BLOCKS, LARGEST = 128, 16, 2048
#: Shingles a block holds about at most (one text at least).
BLOCK_SHINGLES = 1 << 20

_WORD = bytes((b | 0x20 if 0x41 <= b <= 0x5A else b) if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word, in order."""
    raw = np.frombuffer(b" " + text.lower().encode().translate(_WORD) + b" ", np.uint8)
    space = raw == 32
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1          # word starts and ends, in turn
    if not len(edge):
        return np.zeros(0, np.uint64)
    out, step = [], 1 << 16
    starts, ends = edge[::2], edge[1::2]
    powers, inverse = _powers(step)
    for at in range(0, len(starts), 4096):                       # blocks of words bound the power tables
        a, b = starts[at:at + 4096], ends[at:at + 4096]
        if b[-1] - a[0] <= step:
            part = raw[a[0]:b[-1]].astype(np.uint64) + _U(1)
            total = np.concatenate([[_U(0)], np.cumsum(part * powers[:len(part)], dtype=np.uint64)])
            out.append((total[b - a[0]] - total[a - a[0]]) * inverse[a - a[0]] + (b - a).astype(np.uint64))
        else:
            out.append(np.array([int.from_bytes(hashlib.blake2b(raw[i:j].tobytes(), digest_size=8).digest(), "little")
                                 if j - i > step else _one(raw[i:j]) for i, j in zip(a, b)], np.uint64))
    return _mix(np.concatenate(out))


def _one(raw: np.ndarray) -> int:
    powers, _ = _powers(1 << 16)
    return (int(((raw.astype(np.uint64) + _U(1)) * powers[:len(raw)]).sum(dtype=np.uint64)) + len(raw)) % (1 << 64)


_POWERS: dict = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n not in _POWERS:
        made = []
        for p in (_P, _P_INVERSE):
            x = np.full(n, _U(p))
            x[0] = 1
            made.append(np.cumprod(x, dtype=np.uint64))
        _POWERS[n] = tuple(made)
    return _POWERS[n]


def shingles(words: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (sorted) and their counts."""
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0)
    n = max(1, len(words) - size + 1)
    h = np.full(n, _U(min(size, len(words))))
    for k in range(min(size, len(words))):
        h = (h ^ words[k:k + n]) * _U(_P) + (h >> _U(29))
    found, counts = np.unique(_mix(h), return_counts=True)
    return found, counts.astype(float)


def signature(items: np.ndarray, weights: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """The shingle hash that arrives first at each register."""
    first = np.full(registers, np.inf)
    holder = np.zeros(registers, np.uint64)
    time = np.zeros(len(items))
    k = 0
    while len(items):
        # few shingles need many arrivals each: draw several at once
        many = int(min(64, max(1, 2 * registers // len(items))))
        steps = np.arange(k + 1, k + many + 1, dtype=np.uint64) * _U(0xD1B54A32D192ED03)
        draw = _mix(items[:, None] + steps)
        gaps = -np.log1p(-(draw >> _U(11)).astype(float) * 2.0 ** -53) / weights[:, None]
        times = time[:, None] + np.cumsum(gaps, axis=1)
        to = (_mix(draw) % _U(registers)).astype(np.int64)
        row, column = np.nonzero(times < first[to])
        at, register, item = times[row, column], to[row, column], items[row]
        order = np.lexsort((item, -at))                         # the earliest arrival is written last; ties by hash
        first[register[order]] = at[order]
        holder[register[order]] = item[order]
        time, k = times[:, -1], k + many
        going = time < first.max()
        items, weights, time = items[going], weights[going], time[going]
    return holder


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard of two weighted sets."""
    items = np.union1d(a[0], b[0])
    if not len(items):
        return 0.0
    wa, wb = np.zeros(len(items)), np.zeros(len(items))
    wa[np.searchsorted(items, a[0])] = a[1]
    wb[np.searchsorted(items, b[0])] = b[1]
    pairs, n = np.unique(np.stack([wa, wb], axis=1), axis=0, return_counts=True)
    total = 0.0
    for (x, y), m in zip(pairs, n):
        if x and y:
            total += m / (n * np.maximum(pairs[:, 0] / x, pairs[:, 1] / y)).sum()
    return float(total)


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id``, ``content`` (128-bit hash of the word sequence), the keys of the bands, a byte of each register
    (both null without words) and the number of words."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed = _mix(np.arange(1, bands + 1, dtype=np.uint64))
        for batch in slices(batches, "text"):
            contents, keys, bytes_, sizes = [], [], [], []
            for text in batch.column("text").to_pylist():
                words = word_hashes(text)
                contents.append(_content(text, words))
                sizes.append(len(words))
                if not len(words):
                    keys.append(None)
                    bytes_.append(None)
                    continue
                held = signature(*shingles(words), bands * rows)
                bytes_.append(_mix(held).astype(np.uint8).tobytes())
                held = held.reshape(bands, rows)
                key = seed.copy()
                for k in range(rows):
                    key = _mix(key ^ held[:, k]) * _U(_P)
                keys.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(contents), pa.array(keys, pa.list_(pa.int64())), pa.array(bytes_, pa.binary()),
                 pa.array(sizes, pa.int64())], ["doc_id", "content", "bands", "registers", "words"])

    return docs.where("doc_id IS NOT NULL AND text IS NOT NULL") \
        .select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .mapInArrow(run, "doc_id long, content string, bands array<long>, registers binary, words long")


def _content(text: str, words: np.ndarray) -> str:
    return hashlib.blake2b(words.tobytes() if len(words) else b"\0" + text.encode(), digest_size=16).hexdigest()


def shingled(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id``, ``items`` and ``weights`` (shingle hashes and counts as binary; weights null where all are one) of the texts
    ``wanted`` (``id``, ``content``, ``exact_id``), one row each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            contents, items, weights = [], [], []
            for text in batch.column("text").to_pylist():
                words = word_hashes(text)
                found, counts = shingles(words)
                contents.append(_content(text, words))
                items.append(found.tobytes())
                weights.append(None if (counts == 1).all() else counts.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(contents), pa.array(items, pa.binary()), pa.array(weights, pa.binary())],
                                             ["exact_id", "content", "items", "weights"])

    made = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .join(wanted.select(F.col("exact_id").alias("doc_id")).distinct(), "doc_id", "left_semi") \
        .mapInArrow(run, "exact_id long, content string, items binary, weights binary")
    # repeated rows give the same shingles again
    return made.join(wanted, ["exact_id", "content"]).groupBy("id").agg(F.first("items").alias("items"), F.first("weights").alias("weights"))


def _sets(items, weights) -> list[tuple[np.ndarray, np.ndarray]]:
    made = []
    for i, w in zip(items, weights):
        held = np.frombuffer(i, np.uint64)
        made.append((held, np.ones(len(held)) if w is None else np.frombuffer(w, float)))
    return made


def shared_buckets(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Buckets of two texts and more (``bucket``, ``low``, ``high``, ``n``), and their rows (``bucket``, ``id``).

    ``members``: one row per distinct text (``id``, ``bands``)."""
    keyed = members.select("id", F.explode("bands").alias("bucket"))
    # written, so that the join can split a bucket that many texts share
    ends = table(keyed.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n"))
                 .where("low < high"), "buckets")
    return ends, table(keyed.join(ends, "bucket").select("bucket", "id", "low", "high", "n"), "bucket-rows")


def star_pairs(rows: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), a < b: every text with the smallest and the largest id of each of its buckets."""
    pairs = rows.select(F.explode(F.array(F.struct(F.col("low").alias("a"), F.col("id").alias("b")),
                                          F.struct(F.col("id").alias("a"), F.col("high").alias("b")))).alias("p"))
    return pairs.select("p.a", "p.b").where("a < b").distinct()


def alike(x: tuple, y: tuple, floor: float = FLOOR) -> tuple[np.ndarray, np.ndarray]:
    """Places (in x, in y) of texts of different classes whose registers agree in a share of ``floor`` or more.

    ``x``, ``y``: classes (n) and registers (n, m). Texts of the most frequent class are not compared with each other."""
    names, counts = np.unique(np.concatenate([x[0], y[0]]), return_counts=True)
    at_x, at_y = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    main_x, main_y = x[0] == names[counts.argmax()], y[0] == names[counts.argmax()]
    for i, j in ((np.flatnonzero(~main_x), np.arange(len(main_y))), (np.flatnonzero(main_x), np.flatnonzero(~main_y))):
        for k in range(0, len(i), 512):             # bounds the table of counts
            part = i[k:k + 512]
            agree = np.zeros((len(part), len(j)), np.uint16)
            for a, b in zip(x[1][part].T, y[1][j].T):
                agree += a[:, None] == b
            p, q = np.nonzero((agree >= floor * x[1].shape[1]) & (x[0][part][:, None] != y[0][j]))
            at_x.append(part[p])
            at_y.append(j[q])
    return np.concatenate(at_x), np.concatenate(at_y)


def joining(x: dict, y: dict, bucket: int, floor: float = FLOOR, threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """Links between two blocks of a bucket that join their texts' classes.

    ``x``, ``y``: ``id``, ``c`` (classes), ``registers`` (n, m), ``bands`` (n, b) and ``sets`` of a block's texts."""
    at_x, at_y = alike((x["c"], x["registers"]), (y["c"], y["registers"]), floor)
    # a pair is tested in the first bucket that it shares
    here = np.zeros(len(at_x), bool)
    for k in range(0, len(at_x), 65536):
        part = slice(k, k + 65536)
        a, b = x["bands"][at_x[part]], y["bands"][at_y[part]]
        here[part] = a[np.arange(len(a)), (a == b).argmax(axis=1)] == bucket
    at_x, at_y = at_x[here], at_y[here]
    order = np.lexsort((at_y, at_x))
    at_x, at_y = at_x[order], at_y[order]
    class_x, class_y, links = x["c"].copy(), y["c"].copy(), []
    plain = np.array([(w == 1).all() for _, w in y["sets"]], bool)
    starts = np.flatnonzero(np.append(True, at_x[1:] != at_x[:-1])) if len(at_x) else []
    for start, end in zip(starts, [*starts[1:], len(at_x)]):
        i, others = at_x[start], at_y[start:end]
        mine = x["sets"][i]
        easy = others[plain[others]] if (mine[1] == 1).all() else others[:0]
        linked = set()
        if len(easy):
            easy = easy[class_y[easy] != class_x[i]]
            sizes = np.array([len(y["sets"][j][0]) for j in easy])
            fits = np.minimum(sizes, len(mine[0])) >= threshold * np.maximum(sizes, len(mine[0]))
            easy, sizes = easy[fits], sizes[fits]
        if len(easy):
            held = np.concatenate([y["sets"][j][0] for j in easy])
            place = np.minimum(np.searchsorted(mine[0], held), len(mine[0]) - 1)
            common = np.add.reduceat((mine[0][place] == held).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            linked = set(easy[common >= threshold * (len(mine[0]) + sizes - common)].tolist())
        for j in others.tolist():
            if class_y[j] != class_x[i] and (j in linked or (not (plain[j] and (mine[1] == 1).all())
                                                            and similarity(mine, y["sets"][j]) >= threshold)):
                links.append((int(x["id"][i]), int(y["id"][j])))
                old, new = class_y[j], class_x[i]
                class_x[class_x == old], class_y[class_y == old] = new, new
    return links


def remaining_links(rows: DataFrame, members: DataFrame, names: DataFrame, items: DataFrame, floor: float = FLOOR,
                    threshold: float = THRESHOLD) -> DataFrame:
    """Links (a, b) that join all classes (``names``: ``id``, ``class_id`` of linked ids) whose texts share a bucket and are near-duplicates.

    ``members``: ``id``, ``bands``, ``registers``, ``words``; ``items``: of :func:`shingled`."""
    many = rows.where("n > 2")                  # the pair of a bucket of two is its smallest and largest id
    named = table(many.join(names, "id", "left").select("bucket", "id", F.coalesce("class_id", "id").alias("c")), "named-rest")
    mixed = named.groupBy("bucket").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 < c1").select("bucket")
    left = table(named.join(mixed, "bucket"), "mixed-rows")
    sizes = left.join(members.select("id", "words"), "id").groupBy("bucket").agg(F.count("*").alias("n"), F.sum("words").alias("words")) \
        .select("bucket", F.expr(f"greatest(least(ceil(n / {BLOCK}), greatest({BLOCKS}, ceil(n / {LARGEST}))), "
                                 f"least(n, ceil(words / {BLOCK_SHINGLES})))").cast("int").alias("blocks"))
    dealt = left.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    fields = ("id", "c", "bands", "registers", "items", "weights")
    held = table(left.select("id").distinct().join(members.select("id", "bands", "registers"), "id").join(items, "id"), "mixed-texts")
    blocks = table(dealt.join(held, "id").groupBy("bucket", "blocks", "block").agg(F.collect_list(F.struct(*fields)).alias("t")), "blocks")
    both = blocks.select("bucket", F.explode(F.sequence("block", F.col("blocks") - 1)).alias("block"), F.col("t").alias("x")) \
        .join(blocks.select("bucket", "block", F.col("t").alias("y")), ["bucket", "block"])

    def side(texts: pa.Array) -> dict:
        f = dict(zip([c.name for c in texts.type], texts.flatten()))
        n = len(texts)
        return {"id": f["id"].to_numpy(), "c": f["c"].to_numpy(), "bands": f["bands"].flatten().to_numpy().reshape(n, -1),
                "registers": np.frombuffer(b"".join(f["registers"].to_pylist()), np.uint8).reshape(n, -1),
                "sets": _sets(f["items"].to_pylist(), f["weights"].to_pylist())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                links = joining(*(side(batch.column(c)[k].values) for c in "xy"), batch.column("bucket")[k].as_py(), floor, threshold)
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array([f(p) for p in links], pa.int64()) for f in (min, max)], ["a", "b"])

    return both.mapInArrow(run, "a long, b long").distinct()


def promising(pairs: DataFrame, members: DataFrame, floor: float = FLOOR) -> DataFrame:
    """Pairs whose registers agree in a share of ``floor`` or more."""
    held = members.select("id", "registers")
    both = pairs.join(held.toDF("a", "ra"), "a").join(held.toDF("b", "rb"), "b").select("a", "b", "ra", "rb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("ra", "rb"))
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]) \
                    .filter(pa.array((x == y).mean(axis=1) >= floor))

    return both.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of texts that reach ``threshold``, by all their shingles."""
    both = pairs.join(items.toDF("a", "xi", "xw"), "a").join(items.toDF("b", "yi", "yw"), "b").select("a", "b", "xi", "xw", "yi", "yw")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (_sets(batch.column(f"{c}i").to_pylist(), batch.column(f"{c}w").to_pylist()) for c in "xy")
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]) \
                .filter(pa.array([similarity(p, q) >= threshold for p, q in zip(x, y)], pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``class_id`` (the smallest id of its connected component) of every linked id.

    Rounds of large-star and small-star; each round's links are written to the shared folder, and
    the rounds end when every component is a star around its smallest id."""
    edges = table(links.selectExpr("greatest(a, b) AS u", "least(a, b) AS v").where("u <> v").distinct(), "links")
    while not _all_stars(edges):
        most = 2 * edges.count()                    # of any table of this round
        both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
        least = table(both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m"), "least", most)
        large = both.join(least, "u").where("v > u AND v <> m").selectExpr("v AS u", "m AS v") \
            .unionByName(least.where("u > m").selectExpr("u", "m AS v")).distinct()
        down = table(large.where("u > v"), "large", most)
        low = table(down.groupBy("u").agg(F.min("v").alias("m")), "low", most)
        small = down.join(low, "u").where("v <> m").selectExpr("v AS u", "m AS v") \
            .unionByName(low.selectExpr("u", "m AS v")).where("u <> v").distinct()
        edges = table(small, "links", most)
    return edges.selectExpr("u AS id", "v AS class_id")


def _all_stars(edges: DataFrame) -> bool:
    """No id is linked down (u > v) twice, or both down and up."""
    ends = edges.selectExpr("stack(2, u, 1, 0, v, 0, 1) AS (x, down, up)").groupBy("x") \
        .agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return ends.where("down > 1 OR (down = 1 AND up = 1)").isEmpty()


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``class_id`` and ``exact_id`` (smallest id with the same word sequence) of every row of ``docs``."""
    found = table(sketches(docs), "sketches")
    # one node per distinct text: equal word sequences have equal sketches
    texts = table(found.groupBy("content").agg(F.min("doc_id").alias("exact_id"), *[F.first(c).alias(c) for c in ("bands", "registers", "words")])
                  .withColumn("id", F.monotonically_increasing_id()), "texts")
    held = table(found.select("doc_id", "content").join(texts.select("content", "id", "exact_id"), "content").select("doc_id", "id", "exact_id"), "text-ids")
    members = texts.where("bands IS NOT NULL")
    _, rows = shared_buckets(members)
    shared = table(rows.select("id").distinct(), "bucket-ids")
    items = table(shingled(docs, texts.join(shared, "id", "left_semi").select("id", "content", "exact_id")), "shingles")
    pairs = table(star_pairs(rows), "pairs")
    links = verified(promising(pairs, members), items, threshold)
    # a document with several texts links them
    several = held.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").select("doc_id", "a")
    own = held.join(several, "doc_id").select("a", F.col("id").alias("b")).where("a < b").distinct()
    links = table(links.unionByName(own), "links")
    linked = components(links)
    rest = table(remaining_links(rows, members, linked, items, threshold=threshold), "links")
    if not rest.isEmpty():
        linked = components(linked.selectExpr("id AS a", "class_id AS b").unionByName(rest))
    # classes of texts by number, then by the smallest document
    node = held.join(linked, "id", "left").select("doc_id", "exact_id", F.coalesce("class_id", "id").alias("node"))
    node = table(node.groupBy("doc_id").agg(F.min("exact_id").alias("exact_id"), F.min("node").alias("node")), "document-classes")
    named = node.join(node.groupBy("node").agg(F.min("doc_id").alias("class_id")), "node").drop("node")
    return docs.select(F.col("doc_id").cast("long")).join(named, "doc_id", "left") \
        .select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("exact_id", "doc_id").alias("exact_id"))


def deduplicated(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, the one that names it, with its columns. Of rows that share this ``doc_id``
    one stays; rows without a ``doc_id`` are in no class and all stay."""
    keep = table(classes(docs, threshold).where("doc_id = class_id").select("doc_id").distinct(), "class-names")
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64(*docs.columns))
    one = docs.join(keep, "doc_id", "left_semi").withColumn("_nth", F.row_number().over(first)).where("_nth = 1")
    return one.select(docs.columns).unionByName(docs.where("doc_id IS NULL"))
