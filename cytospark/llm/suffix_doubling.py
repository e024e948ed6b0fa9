"""Suffix-array dedup: repeated byte strings from sparse suffixes, in place of prefix doubling over all of them.

`ranks` has prefix doubling as such; its rows for all suffixes take many times the disk of the input. Here only suffixes at anchors are compared, about
one in 33, as each 100-byte string has exactly one anchor (see `repeats`): by hashes of 36 bytes, then of all bytes around the anchor that windows with it
cover, and last of windows of 100 bytes. There are no ranks and no pairs of ranks. Suffixes that are unique at a length leave. The result is that of all suffixes.

Contract of the query: a byte goes if a 100-byte string covers it that also starts earlier (in a document with a smaller doc_id, or
earlier in the same document). Strings don't cross documents.

Nulls and edge cases: a null text is empty; a null doc_id is larger than all others; rows with the same doc_id leave each other alone;
texts of fewer than 100 bytes are kept; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table, text_blocks
from .repeats import Spec, covered_units, finish, keyed_documents, replies_of, run_rows

#: 100 bytes, anchored by 36; earlier places in the same document count.
SPEC = Spec(n=100, k=36, words=False, within=True)


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[tuple[int, int, list[tuple[int, int]], bytes]]]]:
    """For each document: bytes, removed bytes, the removed spans and the rest."""
    for batch, texts in text_blocks(batches):
        r, gone = covered_units(SPEC, batch, texts)
        out = []
        for text, first, last in zip(texts, r.first.tolist(), r.last.tolist(), strict=True):
            cut = gone[first:last].view(np.int8)
            step = np.diff(cut, prepend=np.int8(0), append=np.int8(0))
            spans = list(zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True))
            rest = np.frombuffer(text, np.uint8)[cut == 0].tobytes() if spans else text
            out.append((len(text), len(text) - len(rest), spans, rest))
        yield batch, out


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, rows in _spans(batches):
        yield pa.RecordBatch.from_arrays([batch.column("late"), batch.column("key"), pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.int64()), pa.array([len(x[2]) for x in rows], pa.int64()), pa.array([hashlib.sha256(x[3]).hexdigest() for x in rows], pa.string())], ["late", "key", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, rows in _spans(batches):
        spans = [[{"start": a, "end": b} for a, b in x[2]] for x in rows]
        yield pa.RecordBatch.from_arrays([batch.column("late"), batch.column("key"), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array([x[3] for x in rows], pa.binary())], ["late", "key", "spans", "kept"])


def remove_repeats(documents: DataFrame) -> DataFrame:
    """(doc_id, spans, kept): the removed byte spans, and the bytes that stay."""
    return finish(SPEC, documents, replies_of(run_rows(SPEC, keyed_documents(documents)), "replies"), _cut, "spans array<struct<start:bigint,end:bigint>>, kept binary")


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, removed bytes and spans, and digest of the rest for every document."""
    documents = table(spark, sf_dir, "documents")
    replies = replies_of(run_rows(SPEC, keyed_documents(documents)), "replies")
    return finish(SPEC, documents, replies, _digest, "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
