"""SimHash fingerprints of documents, and near duplicates by Hamming distance with BK-trees.

Two fingerprints that differ in at most 4 of 64 bits agree in at least two of six blocks of bits. So each distinct
fingerprint goes to 15 shards, one for each pair of blocks, named by the bits of the two blocks; every link shows up
in one shard at least. Each shard has a BK-tree: the children of a node are keyed by their Hamming distance to it, and a search
follows only the edges whose key is within the radius of the query's own distance. Trees are built where their shard
is, so none is sent to all executors. The fingerprints of shards of more than `SHARD` are dealt again, to 70 shards by four of eight blocks;
what is still too large is dealt into chunks by hash, and each pair of chunks is a task's group of its own: the tree of one, searched with the other.

A group gives a spanning forest of its links and not all pairs; `components` joins the forests. Exact copies share one
fingerprint and enter once.

Nulls and edge cases: a null or empty text has no words and the fingerprint zero, which links like any other; a null doc_id
takes part, but is nobody's component_id unless the component has no other (then it is null); repeated rows give a row each. Rows
of one doc_id with different texts are documents of their own, linked only if their fingerprints are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, numbered, restored, table, text_blocks
from .components import components

SHINGLE, SEED, RADIUS = 4, 42, 4
#: Widths of the blocks of bits: RADIUS changed bits leave two of six blocks as they are, and four of eight.
LEVELS = ((11, 11, 11, 11, 10, 10), (8,) * 8)
#: Fingerprints of a shard, or of a chunk of a large shard.
SHARD = 512


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of the shingles' XXH64: a bit is set if it is in more than half of the hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(shingle, len(words))
    stops = ends[k - 1 :].tolist()
    starts = [0, *(ends[: len(stops) - 1] + 1).tolist()]
    total = np.zeros(64, np.int64)
    for at in range(0, len(starts), 65536):
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts[at : at + 65536], stops[at : at + 65536], strict=True)], "<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(starts), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_blocks(batches):
        values = [fingerprint(t) for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.array(values, "<u8").view("<i8"))], ["doc_id", "fp"])


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed integer."""
    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_fingerprints, "doc_id bigint, fp bigint")


def _with_print(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_blocks(batches):
        prints = pa.array(np.array([fingerprint(t) for t in texts], "<u8").view("<i8"))
        yield pa.RecordBatch.from_arrays([*batch.columns, prints], [*batch.schema.names, "__fp"])


class BKTree:
    """A metric tree over 64-bit integers; values are (fingerprint, node)."""

    def __init__(self) -> None:
        self.root: tuple[int, int, dict] | None = None

    def insert(self, value: int, node: int) -> None:
        if self.root is None:
            self.root = (value, node, {})
            return
        at = self.root
        while True:
            key = (at[0] ^ value).bit_count()
            child = at[2].get(key)
            if child is None:
                at[2][key] = (value, node, {})
                return
            at = child

    def within(self, value: int, radius: int) -> Iterator[int]:
        """Nodes whose fingerprint differs from `value` in at most `radius` bits."""
        todo = [self.root] if self.root else []
        while todo:
            at = todo.pop()
            distance = (at[0] ^ value).bit_count()
            if distance <= radius:
                yield at[1]
            if at[2]:
                for key in range(distance - radius, distance + radius + 1):
                    child = at[2].get(key)
                    if child is not None:
                        todo.append(child)


def shard_links(values: list[int], chunks: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest, as (fingerprint, least of its tree), of the links in a shard or between its two chunks."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    tree, first = BKTree(), min(chunks)
    one = first == max(chunks)
    for chunk, value in sorted(zip(chunks, values, strict=True)):
        mine = root(value)
        for other in tree.within(value & (2**64 - 1), radius):
            theirs = root(other)
            if theirs != mine:
                low, high = min(mine, theirs), max(mine, theirs)
                parent[high] = mine = low
        if one or chunk == first:
            tree.insert(value & (2**64 - 1), value)
    return [(n, r) for n in set(parent) if (r := root(n)) != n]


def _link_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; a group may go on in the next batch."""
    rest: list[tuple] = []
    names = ("k", "v", "a", "b", "fp", "chunk")

    def flush(group: list[tuple]) -> list[tuple[int, int]]:
        return shard_links([r[4] for r in group], [r[5] for r in group]) if len(group) > 1 else []

    def out(links: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["u", "v"])

    for batch in batches:
        links = []
        for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            if rest and rest[0][:4] != row[:4]:
                links += flush(rest)
                rest = []
            rest.append(row)
        yield out(links)
    yield out(flush(rest))


def _shards(prints: DataFrame, widths: tuple[int, ...]) -> DataFrame:
    """(k, v, fp): each fingerprint under the bits v of every choice k of blocks of which links agree in one at least."""
    starts = np.cumsum((0, *widths))
    masks = [sum(((1 << widths[i]) - 1) << int(starts[i]) for i in some) for some in combinations(range(len(widths)), len(widths) - RADIUS)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    shard = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for i, m in enumerate(signed)])).alias("s")
    return prints.select("fp", shard).select("s.k", "s.v", "fp")


def _search(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Links within the shards of `sizes` (k, v, count), large ones by pairs of chunks."""
    rows = rows.join(sizes, ["k", "v"]).withColumn("n", F.ceil(F.col("count") / SHARD).cast("int"))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("fp", "k"), F.col("n")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    rows = rows.select("k", "v", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"), "fp", "chunk")
    group = ["k", "v", "a", "b"]
    return rows.repartition(*group).sortWithinPartitions(*group).mapInArrow(_link_groups, "u bigint, v bigint")


def links(prints: DataFrame, levels: tuple[tuple[int, ...], ...] = LEVELS) -> DataFrame:
    """Links (u, v) that connect all fingerprints of `prints` (fp, distinct) within the radius."""
    found, rest = [], prints
    for level, widths in enumerate(levels):
        rows = _shards(rest, widths)
        sizes = materialize(rows.groupBy("k", "v").count().where("count > 1"), "shards")
        large = sizes.where(F.col("count") > SHARD)
        if level + 1 == len(levels) or large.isEmpty():
            found.append(_search(rows, sizes))
            break
        found.append(_search(rows, sizes.where(F.col("count") <= SHARD)))
        rest = materialize(rows.join(large, ["k", "v"], "left_semi").select("fp").distinct(), "crowded")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _linked(documents: DataFrame) -> DataFrame:
    """(doc_id, fp, component, component_id) of every document; `component` is its least fingerprint, `component_id` the smallest doc_id."""
    prints = materialize(fingerprints(documents), "fingerprints")
    firsts = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "firsts")
    roots = components(links(firsts.select("fp"))).withColumnRenamed("u", "fp")
    labels = materialize(firsts.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("component")), "labels")
    smallest = labels.groupBy("component").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n"))
    # most components are one fingerprint, whose smallest doc_id is known
    joined = materialize(smallest.where("n > 1").select("component", "component_id"), "smallest")
    labels = labels.join(joined, "component", "left").select("fp", "component", F.coalesce("component_id", "first").alias("component_id"))
    return prints.join(labels, "fp").select("doc_id", "fp", "component", "component_id")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    return _linked(documents).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(documents: DataFrame) -> DataFrame:
    """The documents, all columns, with the smallest doc_id of each component; documents without id stay.

    Where a component has its smallest doc_id more than once, the row of the smallest fingerprint (as a signed integer) stays; of rows that share
    this too, any one. Rows of the same doc_id in different components are kept or dropped each for itself.
    """
    docs = numbered(documents, "doc_id", "text")
    found = materialize(_linked(docs), "components")
    drop = found.where("doc_id IS NOT NULL AND doc_id <> component_id").select("doc_id")
    repeated = materialize(found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    # the same plan at every size: texts are dealt by doc_id, and the small side is hashed; rows without id stay where they are
    gone = drop.union(repeated).distinct().hint("shuffle_hash")
    once = docs.where("doc_id IS NOT NULL").join(gone, "doc_id", "left_anti").select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))
    if not repeated.limit(1).count():
        return restored(once, docs, documents)
    again = docs.join(repeated.hint("shuffle_hash"), "doc_id", "left_semi").select(*docs.columns)
    again = again.mapInArrow(_with_print, T.StructType([*again.schema.fields, T.StructField("__fp", T.LongType())]))
    best = found.where("doc_id = component_id").groupBy("component").agg(F.min("doc_id").alias("doc_id"), F.min("fp").alias("__fp")).select("doc_id", "__fp")
    again = again.join(best, ["doc_id", "__fp"], "left_semi").dropDuplicates(["doc_id", "__fp"])
    return restored(once.unionByName(again.select(*docs.columns)), docs, documents)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
