"""Sentencepiece encoding and decoding through a distinct-chunk table.

Pieces of the vocabulary cannot cross whitespace markers (checked when the model is
loaded), so a text is the sequence of its marked words. A worker segments and decodes
each distinct marked word of its texts once, keeps the result in a bounded table, and
joins ids and decoded words back by position. The pass is narrow: no text is shuffled.

Defined results: a null text counts as empty (begin and end id alone, empty decoded
text); repeated rows give repeated rows; a null ``doc_id`` stays null; extra columns
are ignored. Texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import prepare, slices
from ledgerloom.llm.vocab import piece_vocab


def _encoded(docs: DataFrame, vocab_path: str | None, schema: str, columns) -> DataFrame:
    prepare(docs.sparkSession)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = piece_vocab(vocab_path)
        for batch in slices(batches, "text", 1 << 20):
            found = vocab.encode_decode([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, zip(*map(columns, found)))], names)
        vocab.forget()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def encode(docs: DataFrame, vocab_path: str | None = None) -> DataFrame:
    """``doc_id``, ``ids`` (little-endian uint32 with begin and end ids) and ``decoded`` of every document."""
    return _encoded(docs, vocab_path, "doc_id long, ids binary, decoded string", lambda x: x)


def digests(docs: DataFrame, vocab_path: str | None = None) -> DataFrame:
    """``n_tokens`` and SHA-256 of ids and decoded text, taken where the ids are made: the ids need not leave the worker."""
    def columns(x):
        ids, decoded = x
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    return _encoded(docs, vocab_path, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", columns)
