"""Benchmark decontamination with suffix arrays of the training text.

Each task keeps a suffix array of its block of documents: word positions in the order of the words that follow
them. Every suffix of the benchmark is looked up in it by binary search, which finds each place where the
benchmark's words occur. The array is sparse: it leaves out the positions whose first words are no words
of the benchmark in this order, as no search can end there. Words are compared by number, and those that get a number
by their hash are compared by their bytes. What is kept of a block grows with its words and with the items found in a text, not with items times places.

The benchmark goes to the executors in parts of at most `PART_BYTES`, one pass of the same stage for each part,
so that what is broadcast has a bound whatever the benchmark's size. Documents are never shuffled.

Nulls and edge cases: a null text has no words; a document without words has no hits and is clean; an item without
words matches nothing; items with a null id count as the id ``""``; repeated rows of either table each count.
Other columns of the documents pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM_LOWER, Rolling, byte_symbols, join_texts, numbered, restored, table, text_blocks, words_of

#: Words of a window; an item of fewer is one window.
WINDOW = 13
#: A document is contaminated if at least one word in so many is hit.
ONE_IN = 20
#: Bytes of benchmark text that one pass broadcasts.
PART_BYTES = 16_000_000
#: First words by which positions enter the sparse suffix array.
HEAD = 3

HITS = T.ArrayType(
    T.StructType(
        [
            T.StructField("item", T.StringType()),
            T.StructField("item_word", T.IntegerType()),
            T.StructField("doc_word", T.IntegerType()),
            T.StructField("n_words", T.IntegerType()),
        ]
    )
)
SPANS = T.ArrayType(T.StructType([T.StructField("word", T.IntegerType()), T.StructField("n_words", T.IntegerType())]))
_ARROW_SPANS = pa.list_(pa.struct([("word", pa.int32()), ("n_words", pa.int32())]))
_ARROW_HITS = pa.list_(pa.struct([("item", pa.string()), ("item_word", pa.int32()), ("doc_word", pa.int32()), ("n_words", pa.int32())]))


class Queries(NamedTuple):
    """One part of the benchmark: its words by number, and the windows to search."""

    vocabulary: list[bytes]
    hashes: np.ndarray
    numbers: np.ndarray
    sequence: np.ndarray
    item_of: np.ndarray
    at: np.ndarray
    lengths: np.ndarray
    items: list[str]
    item_start: np.ndarray
    heads: np.ndarray
    head: int


def _head_keys(sequence: np.ndarray, n: int, base: int) -> np.ndarray:
    """For each position but the last n - 1, the n word numbers (below `base` - 1) from there as one; -1 with an unknown word."""
    size = len(sequence) - n + 1
    key, known = np.zeros(max(size, 0), np.int64), np.ones(max(size, 0), bool)
    for i in range(n if size > 0 else 0):
        part = sequence[i : i + size]
        known &= part >= 0
        key = key * base + (part + 1)
    return np.where(known, key, -1)


def prepare(items: list[tuple[object, str | None]], window: int = WINDOW) -> Queries | None:
    """Number the words of the items and list the windows; None if there are no words."""
    ids = ["" if i is None else str(i) for i, _ in items]
    blob, bounds = join_texts([(t or "").encode().lower() for _, t in items])
    starts, ends, before = words_of(blob, bounds, ALNUM_LOWER)
    if not len(starts):
        return None
    raw = blob.tobytes()
    words = [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
    vocabulary = sorted(set(words))
    number = {w: i for i, w in enumerate(vocabulary)}
    sequence = np.array([number[w] for w in words], np.int64)
    vocab_blob, vocab_bounds = join_texts(vocabulary)
    hashes = Rolling(byte_symbols(vocab_blob))(vocab_bounds[:-1], vocab_bounds[1:] - 1)
    order = np.argsort(hashes)
    at, item_of, lengths = [], [], []
    for i in range(len(items)):
        n = int(before[i + 1] - before[i])
        if n:
            size = min(window, n)
            here = np.arange(before[i], before[i + 1] - size + 1)
            at.append(here)
            item_of.append(np.full(len(here), i))
            lengths.append(np.full(len(here), size))
    at, item_of, lengths = map(np.concatenate, (at, item_of, lengths))
    # as many first words as one integer holds
    head = int(min(HEAD, lengths.min(), 62 // (len(vocabulary) + 1).bit_length()))
    heads = np.unique(_head_keys(np.concatenate((sequence, np.full(head, -1))), head, len(vocabulary) + 1)[at])
    return Queries(vocabulary, hashes[order], order, np.concatenate((sequence, np.full(window, -1))), item_of, at, lengths, ids, before[:-1], heads, head)


def _keys(sequence: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The n words from each position as one sortable string of bytes; unknown words sort first."""
    rows = (sequence[at[:, None] + np.arange(n)] + 1).astype(">u4")
    return np.ascontiguousarray(rows).view(f"S{4 * n}").ravel()


class Found(NamedTuple):
    """What a block of texts shares with the benchmark."""

    counts: np.ndarray
    spans: list[list[tuple[int, int]]]
    hits: list[list[tuple[str, int, int, int]]]


def _same_bytes(q: Queries, blob: np.ndarray, starts: np.ndarray, ends: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Whether each word has the bytes of the benchmark word of its number."""
    words, bounds = join_texts(q.vocabulary)
    size = bounds[number + 1] - 1 - bounds[number]
    out = size == ends - starts
    starts, number, size = starts[out], number[out], size[out]
    begin = np.cumsum(size) - size
    step = np.arange(size.sum()) - np.repeat(begin, size)
    equal = blob[np.repeat(starts, size) + step] == words[np.repeat(bounds[number], size) + step]
    if len(size):
        out[out] = np.logical_and.reduceat(equal, begin)
    return out


def search_block(q: Queries | None, texts: list[bytes], window: int = WINDOW) -> Found:
    """Words of each text, its words inside windows as spans (word, words), and its longest match with each item as (item, word in the item, word in the text, words)."""
    blob, bounds = join_texts([t.lower() for t in texts])
    starts, ends, before = words_of(blob, bounds, ALNUM_LOWER)
    counts = np.diff(before)
    none = Found(counts, [[] for _ in texts], [[] for _ in texts])
    if q is None or not len(starts):
        return none
    hashes = Rolling(byte_symbols(blob))(starts, ends)
    seen = np.zeros(1 << 16, bool)
    seen[q.hashes & np.uint64(0xFFFF)] = True
    maybe = np.flatnonzero(seen[hashes & np.uint64(0xFFFF)])
    place = np.minimum(np.searchsorted(q.hashes, hashes[maybe]), len(q.hashes) - 1)
    same = q.hashes[place] == hashes[maybe]
    maybe, number = maybe[same], q.numbers[place[same]]
    same = _same_bytes(q, blob, starts[maybe], ends[maybe], number)
    # words by number, with an unknown one after each text so that no match leaves it
    doc_of = np.repeat(np.arange(len(texts)), counts)
    size = len(starts) + len(texts)
    sequence = np.full(size + window, -1, np.int64)
    sequence[maybe[same] + doc_of[maybe[same]]] = number[same]
    keys = _head_keys(sequence, q.head, len(q.vocabulary) + 1)
    found = np.minimum(np.searchsorted(q.heads, keys), len(q.heads) - 1)
    suffixes = np.flatnonzero((keys >= 0) & (q.heads[found] == keys))
    suffixes = suffixes[suffixes < size]
    if not len(suffixes):
        return none
    suffix_keys = _keys(sequence, suffixes, window)
    order = np.argsort(suffix_keys, kind="stable")
    suffixes, suffix_keys = suffixes[order], suffix_keys[order]
    wanted = _keys(q.sequence, q.at, window)
    low = wanted.copy().view(">u4").reshape(-1, window)
    low[np.arange(window) >= q.lengths[:, None]] = 0
    high = low.copy()
    high[np.arange(window) >= q.lengths[:, None]] = 0xFFFFFFFF
    as_keys = lambda x: np.ascontiguousarray(x).view(f"S{4 * window}").ravel()
    first, last = np.searchsorted(suffix_keys, as_keys(low), "left"), np.searchsorted(suffix_keys, as_keys(high), "right")
    hit = np.flatnonzero(last > first)
    # each window's places are a slice of the suffix array; equal windows share it, and cover once
    change = np.zeros(size + window + 1, np.int64)
    for a, b, n in set(zip(first[hit].tolist(), last[hit].tolist(), q.lengths[hit].tolist(), strict=True)):
        change[suffixes[a:b]] += 1
        change[suffixes[a:b] + n] -= 1
    cover = np.cumsum(change) > 0
    step = np.diff(cover.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    text_start = before[:-1] + np.arange(len(texts))
    doc_at = np.repeat(np.arange(len(texts)), counts + 1)
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    for a, b in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True):
        spans[doc_at[a]].append((a - int(text_start[doc_at[a]]), b - a))
    return Found(counts, spans, _longest(q, hit, first, last, suffixes, doc_at, text_start))


def _longest(q: Queries, hit: np.ndarray, first: np.ndarray, last: np.ndarray, suffixes: np.ndarray, doc_at: np.ndarray, text_start: np.ndarray) -> list[list[tuple[str, int, int, int]]]:
    """The longest match of each text with each item; of equal ones that which comes first in the text, then in the item.

    Windows that follow each other in both texts are one match: an item is gone through window by window, with how far back the match at each place goes.
    """
    hits: list[list[tuple[str, int, int, int]]] = [[] for _ in text_start]
    cuts = np.flatnonzero(np.diff(q.item_of[hit])) + 1
    for windows in np.split(hit, cuts) if len(hit) else []:
        best, best_at, item = np.zeros(len(text_start), np.int64), np.zeros(len(text_start), np.int64), int(q.item_of[windows[0]])
        places, run, previous = np.zeros(0, np.int64), np.zeros(0, np.int64), -2
        for w in windows.tolist():
            now = np.sort(suffixes[first[w] : last[w]])
            if w == previous + 1:
                at = np.minimum(np.searchsorted(places, now - 1), len(places) - 1)
                run = np.where(places[at] == now - 1, run[at] + 1, 0)
            else:
                run = np.zeros(len(now), np.int64)
            places, previous = now, w
            doc = doc_at[now]
            # longer ones are larger, then those that begin earlier
            score = ((q.lengths[w] + run) << 32) | (0xFFFFFFFF - (now - run - text_start[doc]))
            top = np.zeros(len(best), np.int64)
            np.maximum.at(top, doc, score)
            better = top > best
            best_at[better] = int(q.at[w] - q.item_start[item]) - ((top[better] >> 32) - q.lengths[w])
            best[better] = top[better]
        for d in np.flatnonzero(best).tolist():
            hits[d].append((q.items[item], int(best_at[d]), 0xFFFFFFFF - int(best[d] & 0xFFFFFFFF), int(best[d] >> 32)))
    return hits


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same words in spans that don't overlap."""
    out: list[tuple[int, int]] = []
    for a, n in sorted(spans):
        if out and a <= out[-1][0] + out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], a + n - out[-1][0]))
        else:
            out.append((a, n))
    return out


_COLUMNS = ("__n_words", "__spans", "__hits")


def _searcher(part, schema: pa.Schema, first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = Queries(**part.value) if part.value else None
        for batch, texts in text_blocks(batches):
            columns = {n: batch.column(n) for n in batch.schema.names}
            counts, spans, hits = search_block(q, texts)
            if not first:
                hits = [[tuple(x.values()) for x in old] + new for old, new in zip(columns["__hits"].to_pylist(), hits, strict=True)]
                spans = [_merged([tuple(x.values()) for x in old] + new) for old, new in zip(columns["__spans"].to_pylist(), spans, strict=True)]
            columns["__n_words"] = pa.array(counts, pa.int64())
            columns["__spans"] = pa.array([[dict(zip(("word", "n_words"), x, strict=True)) for x in h] for h in spans], _ARROW_SPANS)
            columns["__hits"] = pa.array([[dict(zip(("item", "item_word", "doc_word", "n_words"), x, strict=True)) for x in h] for h in hits], _ARROW_HITS)
            yield pa.RecordBatch.from_arrays([columns[n].cast(schema.field(n).type) if columns[n].type != schema.field(n).type else columns[n] for n in schema.names], schema=schema)

    return run


def find_matches(documents: DataFrame, benchmark: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """`documents` with `__n_words`, `__spans`, the words inside windows, and `__hits`, the longest verbatim match (of a window or more) of each text with each item."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = documents.sparkSession
    items = benchmark.select("item_id", "text")
    total = items.select(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    parts = max(1, -(-2 * total // part_bytes)) if total > part_bytes else 1
    out = documents
    for p in range(parts):
        rows = items if parts == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p)
        q = prepare([tuple(r) for r in rows.collect()])
        schema = T.StructType([f for f in out.schema.fields if f.name not in _COLUMNS])
        schema = schema.add("__n_words", T.LongType()).add("__spans", SPANS).add("__hits", HITS)
        out = out.mapInArrow(_searcher(spark.sparkContext.broadcast(q and q._asdict()), to_arrow_schema(schema), p == 0), schema)
    return out


def _n_hit() -> Column:
    return F.aggregate("__spans", F.lit(0).cast("bigint"), lambda n, x: n + x["n_words"])


def contamination(documents: DataFrame, benchmark: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row for each document: its words, those inside benchmark windows, the items, and the verdict."""
    found = find_matches(documents.select("doc_id", "text"), benchmark, part_bytes)
    items = F.array_sort(F.array_distinct(F.col("__hits.item")))
    out = found.select("doc_id", F.col("__n_words").alias("n_words"), _n_hit().alias("n_hit"), F.size(items).cast("bigint").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.lit(ONE_IN) * F.col("n_hit") >= F.col("n_words")))


def longest_matches(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The longest verbatim match of each document with each item: (doc_id, item_id, doc_word, n_words).

    Of matches of equal length the first is given.
    """
    rows = find_matches(documents.select("doc_id", "text"), benchmark).select("doc_id", F.explode("__hits").alias("h"))
    best = rows.groupBy("doc_id", F.col("h.item").alias("item_id")).agg(F.max(F.struct("h.n_words", (-F.col("h.doc_word")).alias("at"))).alias("m"))
    return best.select("doc_id", "item_id", (-F.col("m.at")).alias("doc_word"), "m.n_words")


def remove_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, without those that are contaminated."""
    docs = numbered(documents, "doc_id", "text")
    found = find_matches(docs, benchmark)
    n_hit = _n_hit()
    return restored(found.where(~((n_hit > 0) & (F.lit(ONE_IN) * n_hit >= F.col("__n_words")))), docs, documents)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of every document by the benchmark."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, least(13, len(w)) AS n, unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2), lambda i: array_to_string(w[i:i + least(13, len(w)) - 1], ' '))) AS s FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS s FROM d, sizes WHERE len(w) >= n),
hit AS (SELECT DISTINCT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.s = bw.s AND dw.n = bw.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
