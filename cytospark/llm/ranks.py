"""Prefix doubling over all suffixes: classes of equal prefixes at lengths 8, 16, 32, 64 and up to the threshold.

Every byte of every text is a row. Its first name is its first eight bytes. In each round Spark sorts the rows by their pair of ranks, the one of the
suffix and the one of the suffix h bytes further on, and ranks them anew: the rank of a class is the first of its places. Suffixes that are alone in
their class leave, and so does each suffix whose partner has left, as its longer prefix is unique, too. The last step overlaps, so that the length
is exactly the threshold.

This is the plain form of what `suffix_doubling` finds from one suffix in about 33. It moves some rows for each byte of text in each round, so it serves
moderate corpora, and as the check of the other; see the README for figures.

Nulls and edge cases: as in `suffix_doubling`; texts shorter than the threshold have no repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, text_blocks
from .repeats import keyed_documents

#: Bytes of the first name.
FIRST = 8


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(late, key, row, at, a, b): each place with its first eight bytes as one number; b is for the second half of later pairs."""
    for batch, texts in text_blocks(batches):
        for late, key, row, text in zip(*(batch.column(n).to_pylist() for n in ("late", "key", "row")), texts, strict=True):
            n = len(text) - FIRST + 1
            if n > 0:
                names = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(np.frombuffer(text, np.uint8), FIRST)).view(">i8").ravel().astype("<i8")
                columns = [pa.repeat(pa.scalar(late, pa.bool_()), n), pa.repeat(pa.scalar(key, pa.int64()), n), pa.repeat(pa.scalar(row, pa.int64()), n), pa.array(np.arange(n)), pa.array(names), pa.repeat(pa.scalar(0, pa.int64()), n)]
                yield pa.RecordBatch.from_arrays(columns, ["late", "key", "row", "at", "a", "b"])


def _reranked(rows: DataFrame) -> DataFrame:
    """(late, key, row, at, rank): by a sort of the pairs (a, b); suffixes alone in their class leave."""
    same = W.partitionBy("a", "b")
    first = F.first(F.struct("late", "key", "row", "at")).over(same.orderBy("late", "key", "row", "at").rowsBetween(W.unboundedPreceding, 0))
    ranked = rows.withColumn("first", first).withColumn("n", F.count(F.lit(1)).over(same)).where("n > 1")
    # one number for the first place of the class: rows are numbered, and no text has 2 ** 32 bytes
    rank = F.shiftleft(F.col("first.row"), 32) + F.col("first.at")
    return ranked.select("late", "key", "row", "at", rank.alias("rank"), "first")


def repeated_places(documents: DataFrame, length: int = 100) -> DataFrame:
    """(row, doc_id, at): places of documents whose `length` bytes also start earlier; `length` is at least eight.

    `row` numbers the documents as they come; rows of one doc_id leave each other alone.
    """
    texts = materialize(keyed_documents(documents).withColumn("id", F.monotonically_increasing_id()), "texts")
    parts = texts.groupBy(F.shiftright("id", 33).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    offset = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    numbered = texts.withColumn("part", F.shiftright("id", 33)).join(parts.select("part", offset.alias("before")), "part")
    numbered = numbered.select("late", "key", "text", (F.col("before") + F.col("id").bitwiseAND(F.lit((1 << 33) - 1))).alias("row"))
    ranks = materialize(_reranked(numbered.mapInArrow(_suffixes, "late boolean, key bigint, row bigint, at bigint, a bigint, b bigint")), "ranks")
    h = FIRST
    while h < length:
        step = min(h, length - h)
        partner = ranks.select("row", (F.col("at") - step).alias("at"), F.col("rank").alias("b"))
        pairs = ranks.select("late", "key", "row", "at", F.col("rank").alias("a")).join(partner, ["row", "at"])
        ranks = materialize(_reranked(pairs), "ranks")
        h += step
    own = F.min("at").over(W.partitionBy("rank", "row"))
    smaller = ~F.col("first.late") & (F.col("late") | (F.col("key") > F.col("first.key")))
    out = ranks.withColumn("own", own).where(smaller | (F.col("own") < F.col("at")))
    return out.select("row", F.when(~F.col("late"), F.col("key")).alias("doc_id"), "at")
