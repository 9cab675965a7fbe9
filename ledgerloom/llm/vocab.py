"""Distinct-chunk tables over public vocabularies.

Both vocabularies used here never let a token span the place before a space that
follows a non-space character. A text is therefore cut there, every distinct chunk
is segmented once, and the chunks' ids are joined back by position. The tables live
in the Python worker for a task, are filled per slice of texts and are bounded: beyond
``limit`` entries they start afresh, and chunks longer than ``LONG`` characters are
segmented without being kept.
"""

from __future__ import annotations

import base64
import json
import os
import re

import numpy as np

#: Entries of a chunk table (about 250 bytes each).
LIMIT = 400_000
#: Runs of white space of this length and more are not left to the library's pattern matching, which overflows its stack on a million characters.
LONG_SPACE = 50_000
LONG = 64


def default_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class ChunkTable:
    """chunk -> ids as little-endian bytes; ``encode_many`` segments a list of chunks."""

    def __init__(self, encode_many, limit: int = LIMIT):
        self.encode_many, self.limit, self.known = encode_many, limit, {}

    def values(self, chunked: list[list[str]]) -> list[list]:
        """For each list of chunks, the list of their table values."""
        missing = set().union(*chunked).difference(self.known)
        if missing and len(self.known) + len(missing) > self.limit:
            self.known = {}
            missing = set().union(*chunked)
        known = self.known
        if missing:
            new = list(missing)
            found = dict(zip(new, self.encode_many(new)))
            if len(found) > self.limit or max(map(len, new)) > LONG:    # not all of it is kept
                known = {**known, **found}
                if len(found) <= self.limit:
                    self.known.update((k, v) for k, v in found.items() if len(k) <= LONG)
            else:
                known.update(found)
        at = known.__getitem__
        return [list(map(at, x)) for x in chunked]


class PieceVocab:
    """A sentencepiece model whose pieces do not cross whitespace markers.

    Requires an identity normalizer with a dummy prefix and kept spaces; this and
    the marker rule are checked when the model is loaded.
    """

    def __init__(self, path: str | None = None, limit: int = LIMIT):
        import sentencepiece

        sp = self.sp = sentencepiece.SentencePieceProcessor(model_file=path or default_path("piece_bpe_32k.model"))
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("pieces of this model cross whitespace markers")
        if sp.encode("  A  b ", out_type=str) != sp.encode("  A", out_type=str) + sp.encode(" b", out_type=str) + ["▁"]:
            raise ValueError("this model normalizes text")
        self.byte_ids = np.array([sp.is_byte(i) for i in range(len(pieces))])
        self.bytes_of = [i.to_bytes(4, "little") for i in range(len(pieces))].__getitem__
        self.marker = sp.piece_to_id("▁")
        self.bos, self.eos = self.bytes_of(sp.bos_id()), self.bytes_of(sp.eos_id())
        self._ids = ChunkTable(self._encode, limit)
        self._both = ChunkTable(self._encode_decode, limit)

    def _segment(self, chunks: list[str]) -> list[list[int]]:
        return [ids if chunk else [self.marker] for chunk, ids in zip(chunks, self.sp.encode(chunks, num_threads=1))]

    def _encode(self, chunks):
        join = b"".join
        return [join(map(self.bytes_of, ids)) for ids in self._segment(chunks)]

    def _encode_decode(self, chunks):
        ids = self._segment(chunks)
        join = b"".join
        return [(join(map(self.bytes_of, i)), t) for i, t in zip(ids, self.sp.decode(ids, num_threads=1))]

    def forget(self) -> None:
        """Free the tables, at the end of a task: other stages run in the same worker."""
        self._ids.known, self._both.known = {}, {}

    @staticmethod
    def chunks(text: str) -> list[str]:
        """One chunk per marked word. The marker itself is implied; an empty chunk before another
        one is a marker of a longer run and is folded into it."""
        words = text.replace("▁", " ").split(" ") if text else []
        if "" not in words:
            return words
        out, run = [], 0
        for w in words[:-1]:
            if w:
                out.append(" " * run + w)
                run = 0
            else:
                run += 1
        return [*out, " " * run + words[-1]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text (no begin or end ids) as little-endian uint32."""
        return list(map(b"".join, self._ids.values([self.chunks(t) for t in texts])))

    def encode_decode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Ids with begin and end, and the text decoded from them."""
        out = []
        for values in self._both.values([self.chunks(t) for t in texts]):
            out.append((b"".join([self.bos, *(v[0] for v in values), self.eos]), " ".join([v[1] for v in values])))
        return out


# The characters of Unicode's White_Space, as the pattern's \\s means them.
_LONG_SPACE = re.compile("[\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_SPACE)


def _unsafe(chunk: str) -> bool:
    return not chunk or chunk[-1].isspace() or (len(chunk) >= LONG_SPACE and _LONG_SPACE.search(chunk) is not None)


class ByteVocab:
    """A byte-level BPE vocabulary given as ranks; the ids equal those of the same vocabulary's JSON file.

    The strings of added tokens in a text are ordinary text to ``encode``; ``encode_added`` gives them their
    ids, as the JSON file beside the ranks has them.
    """

    def __init__(self, path: str | None = None, pattern: str | None = None, limit: int = LIMIT):
        import tiktoken

        if pattern is None:
            from public_tokenizers import PATTERN as pattern
        path = path or default_path("byte_bpe_50k.tiktoken")
        self.added = added_tokens(os.path.splitext(path)[0] + ".json")
        # the leftmost and then the longest one counts
        self._added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self._first = ChunkTable(self._encode_first, limit // 4)
        self._later = ChunkTable(self._encode, limit)

    def forget(self) -> None:
        """Free the tables, at the end of a task."""
        self._first.known, self._later.known = {}, {}

    def whole(self, text: str) -> bytes:
        """Ids of a text. The pattern takes a run of white space up to its last character as one word (or all of it at the
        end of the text); runs too long for the library's pattern matching are cut out and encoded as such words."""
        ids, at = [], 0
        for run in _LONG_SPACE.finditer(text):
            end = run.end() - (run.end() < len(text))
            ids += self.encoding.encode_ordinary(text[at:run.start()])
            ids += self.encoding._encode_single_piece(text[run.start():end])
            at = end
        return np.array(ids + self.encoding.encode_ordinary(text[at:]), "<u4").tobytes()

    def _encode(self, chunks: list[str]) -> list[bytes | None]:
        """All chunks, each after its space, in one call, cut apart again where the spaces are. None: the
        chunk has no safe end (it is empty or ends in white space) or holds a long run of white space, so its text is
        encoded whole."""
        unsafe = [i for i, c in enumerate(chunks) if _unsafe(c)]
        if unsafe:
            bad = set(unsafe)
            good = iter(self._encode([c for i, c in enumerate(chunks) if i not in bad]))
            return [None if i in bad else next(good) for i in range(len(chunks))]
        if not chunks:
            return []
        joined = " " + " ".join(chunks)
        ids = np.array(self.encoding.encode_ordinary(joined), "<u4")
        ends = np.cumsum(self.lengths[ids])
        raw = np.frombuffer(joined.encode(), np.uint8)
        sizes = np.append(np.flatnonzero(raw == 32)[1:], len(raw))
        cut = np.searchsorted(ends, sizes) + 1
        if not (ends[cut - 1] == sizes).all():
            raise AssertionError("a token crosses a chunk border")
        data, to = ids.tobytes(), (cut * 4).tolist()
        return [data[a:b] for a, b in zip([0, *to[:-1]], to)]

    def _encode_first(self, chunks: list[str]) -> list[bytes | None]:
        return [None if _unsafe(c) else self.whole(c) for c in chunks]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian uint32."""
        words = [t.split(" ") for t in texts]
        first = self._first.values([w[:1] for w in words])
        later = self._later.values([w[1:] for w in words])
        out = []
        for t, a, b in zip(texts, first, later):
            try:
                out.append(b"".join(a + b) if t else b"")
            except TypeError:                       # a chunk without a safe end
                out.append(self.whole(t))
        return out


    def encode_added(self, texts: list[str]) -> list[bytes]:
        """As ``encode``, with the ids of added tokens; the stretches between them are encoded each by itself."""
        if not self._added:
            return self.encode(texts)
        parts = [self._added.split(t) for t in texts]           # stretch, token, stretch, ..., stretch
        ids = iter(self.encode([x for p in parts for x in p[::2]]))
        return [b"".join([self.added[x] if k % 2 else next(ids) for k, x in enumerate(p)]) for p in parts]


def added_tokens(path: str) -> dict[str, bytes]:
    """Added tokens of a tokenizer's JSON file and their ids as little-endian uint32; none without the file."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        found = json.load(f)["added_tokens"]
    odd = [t["content"] for t in found if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
    if odd:
        raise ValueError(f"added tokens with rules of their own: {odd}")
    return {t["content"]: t["id"].to_bytes(4, "little") for t in found}


_LOADED: dict = {}


def piece_vocab(path: str | None = None) -> PieceVocab:
    """The worker's vocabulary; kept between tasks."""
    if ("piece", path) not in _LOADED:
        _LOADED["piece", path] = PieceVocab(path)
    return _LOADED["piece", path]


def byte_vocab(path: str | None = None) -> ByteVocab:
    if ("byte", path) not in _LOADED:
        _LOADED["byte", path] = ByteVocab(path)
    return _LOADED["byte", path]
