"""Exact search for repeated windows of fixed length over all documents; `fingerprint_index` and `suffix_doubling` build on it.

A window of n units (words or bytes) repeats if its sequence also starts earlier. Rows for every window would be many
times the input, so windows are named in steps:

1. Each window has an anchor, the leftmost of its k-grams with the least hash. It depends on nothing but the window, so equal
   windows have equal anchors at the same place. Windows that follow each other with one anchor are a run; about one
   row for each (n - k + 2) / 2 units is shuffled: the anchor's hash g and the hash s of all text that the run's windows cover.
2. By g, all rows of a k-gram meet in order of s and document, in Spark's windows. A run whose (g, s) occurs earlier is covered as a whole.
   Where g has one s only, nothing else can repeat. Where it has several, the first run of each s is open.
3. Windows of open runs are named one by one, by (g, w), and meet again; later ones are covered.

Before each shuffle a task keeps one row for each name in its block of text and settles the others itself: a passage in a third of all documents
gives a row for each block and not for each document. At the ends of such a passage, where every document goes on in its own way, a block sends few of
the names to the anchor's group and opens the rest at once. Names are pairs of 64-bit hashes, which have to agree both.

Documents are compared by doc_id; one without id is later than all that have one, and as late as its like. Answers go to documents by
(late, key): the doc_id, or, where it is null, a hash of the text. Rows of the same doc_id aren't earlier than each other, and share their answers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import NON_SPACE, Rolling, byte_symbols, join_texts, materialize, mix, text_blocks, words_of

_U = np.uint64
#: What is known of a row: nothing yet, that its windows repeat, or that they are to be looked at one by one; LATE is added for documents without id.
PLAIN, COVERED, OPEN, LATE = 0, 1, 2, 4
#: Names of one anchor in a block of text from which on they don't all go to its group.
MOST_NAMES = 4


class Spec(NamedTuple):
    """n units of a window, k of an anchor; words or bytes; whether earlier places in the same document count."""

    n: int
    k: int
    words: bool
    within: bool


class Runs(NamedTuple):
    """Units of a block of texts, and the runs of windows that share an anchor, from the window at `low` to that at `high`."""

    blob: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    last: np.ndarray
    roll: Rolling
    low: np.ndarray
    high: np.ndarray
    doc: np.ndarray
    g: np.ndarray
    s: np.ndarray


def runs_of(spec: Spec, texts: list[bytes]) -> Runs:
    """Runs of all texts; `first` and `last` are the units of each text."""
    blob, bounds = join_texts(texts)
    if spec.words:
        starts, ends, before = words_of(blob, bounds, NON_SPACE)
        symbols = Rolling(byte_symbols(blob))(starts, ends)
        first, last = before[:-1], before[1:]
    else:
        starts = ends = np.zeros(0, np.int64)
        symbols = byte_symbols(blob)
        first, last = bounds[:-1], bounds[1:] - 1
    size, none = len(symbols), np.zeros(0, np.int64)
    roll, long = Rolling(symbols), last - first >= spec.n
    if not long.any():  # all texts together may be long enough
        return Runs(blob, starts, ends, first, last, roll, none, none, none, none.view(np.uint64), none.view(np.uint64))
    at = np.arange(size - spec.k + 1)
    grams = roll(at, at + spec.k)
    least = (grams & _U(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    wide, width = spec.n - spec.k + 1, 1
    while width < wide:  # minima over windows of doubling width, the last step overlapping
        step = min(width, wide - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    change = np.zeros(size + 1, np.int64)
    change[first[long]] += 1
    change[last[long] - spec.n + 1] -= 1
    windows = np.flatnonzero(np.cumsum(change[: len(least)]) > 0)
    anchor = (least[windows] & _U(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(windows), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)
    begin = np.flatnonzero(new)
    low, high, anchor = windows[begin], windows[np.append(begin[1:], len(windows)) - 1], anchor[begin]
    shape = (anchor - low).astype(np.uint64) * _U(0x9E3779B97F4A7C15) + (high - low).astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F)
    return Runs(blob, starts, ends, first, last, roll, low, high, np.searchsorted(first, low, "right") - 1, grams[anchor], mix(roll(low, high + spec.n) ^ shape))


def _names(g: np.ndarray, name: np.ndarray, late: np.ndarray, key: np.ndarray, most: int | None = None) -> pa.RecordBatch:
    """One plain row for the first document of each (g, name), and for each without id if none has one; other documents are covered, and get any g.

    Where g has `most` names in the block, its group is known to be open: two names go to the group, so that all others there open as well, and
    the rest are open without it.
    """
    order = np.lexsort((key, late, name, g))
    g, name, late, key = g[order], name[order], late[order], key[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (name[1:] != name[:-1])
    at = np.flatnonzero(new)[np.cumsum(new) - 1] if len(g) else np.zeros(0, np.int64)
    covered = ~late[at] & (late | (key > key[at]))
    other = np.ones(len(g), bool)
    other[1:] = new[1:] | (key[1:] != key[:-1]) | (late[1:] != late[:-1])
    keep = new | (other & (covered | late[at]))
    g, name, late, key, plain = g[keep], name[keep], late[keep], key[keep], ~covered[keep]
    kind = np.where(plain, PLAIN, COVERED).astype(np.int8)
    if most and plain.any():
        own = np.flatnonzero(plain)
        if late.any():  # documents with and without id have two names each there, as an index keeps only the former
            own = own[np.lexsort((name[own], late[own], g[own]))]
        first = np.ones(len(own), bool)
        first[1:] = (g[own][1:] != g[own][:-1]) | (late[own][1:] != late[own][:-1])
        begin = np.flatnonzero(first)
        size = np.diff(np.append(begin, len(own)))
        rank = np.arange(len(own)) - np.repeat(begin, size)
        several = np.repeat(name[own][begin] != name[own][begin + size - 1], size)
        kind[own[several & (np.repeat(size, size) >= most) & (rank > 0) & (rank < np.repeat(size, size) - 1)]] = OPEN
        plain = kind == PLAIN
    g = np.where(plain, g, mix(name ^ key.view(np.uint64)))
    return pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(name.view(np.int64)), pa.array(key), pa.array(kind + late.astype(np.int8) * np.int8(LATE))], ["g", "s", "key", "kind"])


_ROWS = "g bigint, s bigint, key bigint, kind tinyint"


def _documents(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """`late` and `key` of a batch."""
    return batch.column("late").to_numpy(zero_copy_only=False), batch.column("key").to_numpy()


def run_rows(spec: Spec, keyed: DataFrame) -> DataFrame:
    """(g, s, key, kind) of the runs of (late, key, text)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches):
            r = runs_of(spec, texts)
            late, key = _documents(batch)
            yield _names(r.g, r.s, late[r.doc], key[r.doc], MOST_NAMES)

    return keyed.select("late", "key", "text").mapInArrow(emit, _ROWS)


def is_late() -> Column:
    return F.col("kind") >= LATE


def known() -> Column:
    """The kind of a row without LATE."""
    return F.col("kind").bitwiseAND(F.lit(3).cast("tinyint"))


def first_of_name() -> Column:
    """(late, key) of the first document of a row's name, by a window that goes through the rows of (g, s) in order."""
    here = W.partitionBy("g", "s").orderBy(is_late(), "key").rowsBetween(W.unboundedPreceding, 0)
    return F.first(F.struct(is_late().alias("late"), F.col("key").alias("key"))).over(here)


def is_covered(first: Column) -> Column:
    return ~first["late"] & (is_late() | (F.col("key") > first["key"]))


def settle(rows: DataFrame) -> DataFrame:
    """(late, key, s, kind): what is covered and what is open among rows of (g, s, key, kind)."""
    every = W.partitionBy("g")
    out = rows.withColumn("first", first_of_name()).withColumn("several", F.min("s").over(every) != F.max("s").over(every))
    kind = F.when(known() != PLAIN, known()).when(is_covered(F.col("first")), F.lit(COVERED)).when(F.col("several"), F.lit(OPEN))
    return out.select(is_late().alias("late"), "key", "s", kind.cast("tinyint").alias("kind")).where("kind IS NOT NULL")


def settle_windows(rows: DataFrame) -> DataFrame:
    """(late, key, s): the covered ones among rows of (g, s, key, kind); here an open row is one without an answer."""
    covered = (known() == COVERED) | ((known() == PLAIN) & is_covered(F.col("first")))
    return rows.withColumn("first", first_of_name()).where(covered).select(is_late().alias("late"), "key", "s")


def by_document(settled: DataFrame) -> DataFrame:
    """(late, key, covered, open): the names of each document, as long as its text at most."""
    pick = lambda kind, name: F.collect_set(F.when(F.col("kind") == kind, F.col("s"))).alias(name)
    return settled.groupBy("late", "key").agg(pick(COVERED, "covered"), pick(OPEN, "open"))


def _lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Rows and values of a column of lists."""
    column = batch.column(name)
    sizes = np.array([0 if x is None else x for x in column.value_lengths().to_pylist()], np.int64)
    return np.repeat(np.arange(len(sizes)), sizes), column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _among(doc: np.ndarray, name: np.ndarray, docs: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Whether each (doc, name) is one of (docs, names); names of 64 bits are paired with documents by mixing and checked."""
    if not len(docs) or not len(doc):
        return np.zeros(len(doc), bool)
    order = np.lexsort((names, docs))
    docs, names = docs[order], names[order]
    mixed = mix(names ^ mix(docs.astype(np.uint64)))
    by = np.argsort(mixed, kind="stable")
    at = np.minimum(np.searchsorted(mixed[by], mixed_of := mix(name ^ mix(doc.astype(np.uint64)))), len(by) - 1)
    at = by[at]
    return (mixed[at] == mixed_of) & (docs[at] == doc) & (names[at] == name)


def _spread(r: Runs, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows of the chosen runs, and the run of each."""
    sizes = r.high[chosen] - r.low[chosen] + 1
    run = np.repeat(chosen, sizes)
    offset = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return r.low[run] + offset, run


def window_rows(spec: Spec, joined: DataFrame) -> DataFrame:
    """(g, s, key, kind) of the windows of open runs, from (late, key, text, open)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches):
            r = runs_of(spec, texts)
            at, run = _spread(r, np.flatnonzero(_among(r.doc, r.s, *_lists(batch, "open"))))
            late, key = _documents(batch)
            yield _names(r.g[run], r.roll(at, at + spec.n), late[r.doc[run]], key[r.doc[run]])

    return joined.select("late", "key", "text", "open").mapInArrow(emit, _ROWS)


def covered_units(spec: Spec, batch: pa.RecordBatch, texts: list[bytes]) -> tuple[Runs, np.ndarray]:
    """Runs, and for each unit of the block whether a repeated window covers it; columns covered, open, windows."""
    r = runs_of(spec, texts)
    hit = _among(r.doc, r.s, *_lists(batch, "covered"))
    opened = _among(r.doc, r.s, *_lists(batch, "open"))
    if spec.within and len(r.s):
        order = np.lexsort((r.low, r.s, r.g, r.doc))
        again = (r.doc[order][1:] == r.doc[order][:-1]) & (r.g[order][1:] == r.g[order][:-1]) & (r.s[order][1:] == r.s[order][:-1])
        hit[order[1:][again]] = True
        # names that meet within one document only are open there, too
        order = np.lexsort((r.s, r.g, r.doc))
        same = (r.doc[order][1:] == r.doc[order][:-1]) & (r.g[order][1:] == r.g[order][:-1])
        opened[order[1:][same]] = opened[order[:-1][same]] = True
    change = np.zeros(int(max(r.last.max(initial=0), 0)) + spec.n + 2, np.int64)
    np.add.at(change, r.low[hit], 1)
    np.add.at(change, r.high[hit] + spec.n, -1)
    at, run = _spread(r, np.flatnonzero(opened))
    if len(at):
        names, doc, g = r.roll(at, at + spec.n), r.doc[run], r.g[run]
        again = _among(doc, names, *_lists(batch, "windows"))
        if spec.within:
            order = np.lexsort((at, names, g, doc))
            same = (doc[order][1:] == doc[order][:-1]) & (g[order][1:] == g[order][:-1]) & (names[order][1:] == names[order][:-1])
            again[order[1:][same]] = True
        np.add.at(change, at[again], 1)
        np.add.at(change, at[again] + spec.n, -1)
    return r, np.cumsum(change) > 0


def keyed_documents(documents: DataFrame) -> DataFrame:
    """(late, key, text) of the documents."""
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64("text"))
    return documents.select(F.col("doc_id").isNull().alias("late"), key.alias("key"), "text")


def finish(spec: Spec, documents: DataFrame, replies: DataFrame, digest: Callable, schema: str) -> DataFrame:
    """Settles the windows of open runs and gives each document to `digest`, with what is covered of it, after `late` and `key`: `schema`.

    `replies` is (late, key, covered, open). The texts are shuffled once, by document: both joins of this plan use the same exchange.
    """
    texts, on = keyed_documents(documents), ["late", "key"]
    opened = replies.where(F.size("open") > 0).select("late", "key", "open")
    windows = settle_windows(window_rows(spec, texts.join(opened, on).select("late", "key", "text", "open")))
    windows = windows.groupBy("late", "key").agg(F.collect_set("s").alias("windows"))
    joined = texts.join(replies, on, "left").join(windows, on, "left")
    out = joined.select("late", "key", "text", "covered", "open", "windows").mapInArrow(digest, f"late boolean, key bigint, {schema}")
    return out.select(F.when(~F.col("late"), F.col("key")).alias("doc_id"), *out.columns[2:])


def replies_of(rows: DataFrame, name: str) -> DataFrame:
    """(late, key, covered, open) of all documents that have any, written out."""
    return materialize(by_document(settle(rows)), name)
