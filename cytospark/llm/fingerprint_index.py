"""Incremental substring dedup with a log-structured index of window fingerprints.

Documents come in batches, by doc_id. The index is a folder with a list of immutable tables, three for each batch: its fingerprints (see `repeats`: the
anchor's hash g, the hash s of the windows' text, the first document), bucketed by g and sorted by (g, s); the hashes of the windows at anchors
with several fingerprints, bucketed and sorted by (g, window); and its texts, bucketed by document. A batch is dealt to buckets first, which are its
only shuffles of size; then its buckets are merge-joined with the same buckets of older tables, which stay where they are. Equal (g, s) are
repeats; where only the anchor agrees, the windows are verified one by one. Those of older documents are in the index since the anchor had
several fingerprints; for an anchor that the batch opens, they come from the stored text of the one document that it had before. So a batch is answered
from the index alone. When there are more than `MAX_RUNS` tables of fingerprints or of windows, the oldest two are merge-joined into one with a row
for each name, bucket by bucket, also without a shuffle.

Each change of the list is a new small file, so that an index that is opened again sees all tables of finished batches and nothing of others.

Contract of the query: words are what white space (space, U+0009 to U+000D) divides; a word goes if a window of 13 consecutive words
covers it whose sequence also starts in a document with a smaller doc_id. Repeats within one document stay.

Nulls and edge cases: a null text has no words; a null doc_id is larger than all others; rows with the same doc_id leave each other
alone; texts of fewer than 13 words have no windows; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import drop_path, materialize, scratch, table, text_blocks
from .repeats import COVERED, OPEN, PLAIN, Spec, by_document, covered_units, first_of_name, is_covered, is_late, keyed_documents, known, run_rows, window_rows

#: 13 words, anchored by 5; only other documents count.
SPEC = Spec(n=13, k=5, words=True, within=False)
#: Runs that the index has before they are compacted.
MAX_RUNS = 2
#: The query takes the documents in so many batches of about equal size.
BATCHES = 3


class Layout(NamedTuple):
    """Columns of a kind of table, and what it is bucketed and sorted by."""

    schema: str
    buckets: tuple[str, ...]
    order: tuple[str, ...]


FINGERPRINTS = Layout("g BIGINT, s BIGINT, key BIGINT, kind TINYINT", ("g",), ("g", "s", "key"))
WINDOWS = Layout("g BIGINT, s BIGINT, key BIGINT, kind TINYINT", ("g", "s"), ("g", "s", "key"))
TEXTS = Layout("late BOOLEAN, key BIGINT, text STRING", ("key",), ("late", "key"))
_STATE = "buckets int, runs array<string>, windows array<string>, texts array<string>, highest bigint"


@contextmanager
def _merging(spark: SparkSession) -> Iterator[None]:
    """Lets Spark join and group tables that are bucketed by g and sorted by (g, s) by both without moving or sorting them."""
    wanted = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.legacy.bucketedTableScan.outputOrdering": "true", "spark.sql.execution.replaceHashWithSortAgg": "true"}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


class FingerprintIndex:
    """Sorted, bucketed tables of fingerprints, windows and texts in a folder that all executors share.

    An index is opened again by giving its folder. The number of buckets is that of Spark's shuffle partitions when it was made.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, spec: Spec = SPEC, max_runs: int = MAX_RUNS):
        self.spark, self.spec, self.max_runs = spark, spec, max_runs
        self.folder = folder or scratch(spark, "index")
        self.buckets, self.version, self.highest = int(spark.conf.get("spark.sql.shuffle.partitions")), 0, None
        self.runs, self.windows, self.texts = [], [], []
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/runs-*/_SUCCESS")
        done = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
        versions = [int(f.getPath().getParent().getName().removeprefix("runs-")) for f in done]
        if versions:
            self.version = max(versions)
            state = spark.read.schema(_STATE).json(f"{self.folder}/runs-{self.version}").first()
            self.buckets, self.highest = state.buckets, state.highest
            self.runs, self.windows, self.texts = list(state.runs), list(state.windows), list(state.texts)

    def _commit(self, runs: list[str], windows: list[str], texts: list[str], highest: int | None) -> None:
        self.version += 1
        state = self.spark.createDataFrame([(self.buckets, runs, windows, texts, highest)], _STATE)
        state.coalesce(1).write.json(f"{self.folder}/runs-{self.version}")
        self.runs, self.windows, self.texts, self.highest = runs, windows, texts, highest

    def _write(self, rows: DataFrame, layout: Layout = FINGERPRINTS) -> str:
        """A new table; `rows` are dealt to as many tasks as there are buckets."""
        name = f"run-{uuid.uuid4().hex}"
        table_ = f"cytospark_{name.replace('-', '_')}"
        rows.write.bucketBy(self.buckets, *layout.buckets).sortBy(*layout.order).option("path", f"{self.folder}/{name}").saveAsTable(table_)
        self.spark.sql(f"DROP TABLE {table_}")  # the files stay
        return name

    def run(self, name: str, layout: Layout = FINGERPRINTS) -> DataFrame:
        """The rows of a table, known to Spark as bucketed and sorted."""
        table_ = f"cytospark_{name.replace('-', '_')}_{uuid.uuid4().hex}"
        by, order = ", ".join(layout.buckets), ", ".join(layout.order)
        self.spark.sql(f"CREATE TABLE {table_} ({layout.schema}) USING parquet CLUSTERED BY ({by}) SORTED BY ({order}) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{name}'")
        out = self.spark.table(table_)
        self.spark.sql(f"DROP TABLE {table_}")
        return out

    def _old(self, name: str, layout: Layout = FINGERPRINTS) -> DataFrame:
        """(g, s, key): the names of documents with an id of an older table."""
        return self.run(name, layout).where(F.col("kind") == PLAIN).select("g", "s", "key")

    def _opened(self, name: str) -> DataFrame:
        """(g): the anchors of the run at which it and older runs have several fingerprints; `s` is 1 where older runs have not, else 0."""
        groups = self.run(name).where(known() == PLAIN).groupBy("g").agg(F.min("s").alias("low"), F.max("s").alias("high"))
        low, high = [], []
        for i, old in enumerate(self.runs):
            theirs = self._old(old).groupBy("g").agg(F.min("s").alias(f"low_{i}"), F.max("s").alias(f"high_{i}"))
            groups = groups.join(theirs.hint("merge"), "g", "left")
            low, high = [*low, F.col(f"low_{i}")], [*high, F.col(f"high_{i}")]
        # least and greatest pass over nulls, and take two columns at least
        several = lambda low, high: F.least(*low, low[0]) != F.greatest(*high, high[0])
        before = F.coalesce(several(low, high), F.lit(False)) if low else F.lit(False)
        opened = groups.where(several([F.col("low"), *low], [F.col("high"), *high]))
        return opened.select("g", F.when(before, 0).otherwise(1).cast("bigint").alias("s"), F.lit(0).cast("bigint").alias("key"), F.lit(OPEN).cast("tinyint").alias("kind"))

    def compare(self, name: str, opened: str) -> DataFrame:
        """Repeats between the run and all older ones, as (late, key, s, kind) of `repeats.settle`, with the anchors of `_opened`. No run is moved."""
        anchors = self.run(opened).select("g", F.lit(True).alias("several"), (F.col("s") == 1).alias("new"))
        rows, seen = self.run(name).withColumn("first", first_of_name()), F.lit(False)
        for i, old in enumerate(self.runs):
            names = self._old(old).groupBy("g", "s").agg(F.min("key").alias(f"old_{i}"))
            rows = rows.join(names.hint("merge"), ["g", "s"], "left")
            seen = seen | (F.col(f"old_{i}").isNotNull() & (is_late() | (F.col("key") > F.col(f"old_{i}"))))
        rows = rows.join(anchors.hint("merge"), "g", "left")
        kind = F.when(known() != PLAIN, known()).when(seen | is_covered(F.col("first")), F.lit(COVERED)).when(F.col("several"), F.lit(OPEN))
        found = rows.select(is_late().alias("late"), "key", "s", kind.cast("tinyint").alias("kind")).where("kind IS NOT NULL")
        for old in self.runs:  # where the batch opens an anchor, the windows of the older document are needed, too
            again = self._old(old).join(anchors.where("new").hint("merge"), "g", "left_semi").groupBy("g", "s").agg(F.min("key").alias("key"))
            found = found.unionByName(again.select(F.lit(False).alias("late"), "key", "s", F.lit(OPEN).cast("tinyint").alias("kind")))
        return found

    def _window_rows(self, texts: list[str], opened: DataFrame) -> DataFrame:
        """Windows of (late, key, open) from tables of texts, which aren't moved."""
        joined = [self.run(name, TEXTS).join(opened.hint("merge"), ["late", "key"]) for name in texts]
        rows = [window_rows(self.spec, j.select("late", "key", "text", "open")) for j in joined]
        return reduce(DataFrame.unionByName, rows).repartition(self.buckets, "g", "s")

    def _settled(self, name: str) -> DataFrame:
        """(late, key, windows): the repeated windows of the table's documents, by merge joins with older tables of windows."""
        rows, seen = self.run(name, WINDOWS).withColumn("first", first_of_name()), F.lit(False)
        for i, old in enumerate(self.windows):
            names = self._old(old, WINDOWS).groupBy("g", "s").agg(F.min("key").alias(f"old_{i}"))
            rows = rows.join(names.hint("merge"), ["g", "s"], "left")
            seen = seen | (F.col(f"old_{i}").isNotNull() & (is_late() | (F.col("key") > F.col(f"old_{i}"))))
        covered = (known() == COVERED) | ((known() == PLAIN) & (seen | is_covered(F.col("first"))))
        return rows.where(covered).groupBy(is_late().alias("late"), "key").agg(F.collect_set("s").alias("windows"))

    def _take(self, batch: DataFrame, digest: Callable | None, schema: str) -> tuple[DataFrame, DataFrame | None]:
        """What `add` and `answer` return."""
        key = F.col("doc_id").cast("bigint")
        low, high = batch.agg(F.min(key), F.max(key)).first()
        if low is not None and self.highest is not None and low < self.highest:
            raise ValueError(f"document {low} comes after {self.highest}; batches are to be added by rising doc_id")
        keyed, on, answer = keyed_documents(batch), ["late", "key"], None
        texts = self._write(keyed.repartition(self.buckets, "key"), TEXTS)
        name = self._write(run_rows(self.spec, keyed).repartition(self.buckets, "g"))
        with _merging(self.spark):
            opened = self._write(self._opened(name))
            found = materialize(self.compare(name, opened), "found")
            replies = materialize(by_document(found), "replies")
            windows = self._write(self._window_rows([*self.texts, texts], replies.where(F.size("open") > 0).select(*on, "open")), WINDOWS)
            if digest:
                joined = self.run(texts, TEXTS).join(replies.hint("merge"), on, "left").join(self._settled(windows).hint("merge"), on, "left")
                rows = joined.select(*on, "text", "covered", "open", "windows").mapInArrow(digest, f"late boolean, key bigint, {schema}")
                answer = materialize(rows.select(F.when(~F.col("late"), F.col("key")).alias("doc_id"), *rows.columns[2:]), "answer")
        drop_path(self.spark, f"{self.folder}/{opened}")
        highest = max((x for x in (self.highest, high) if x is not None), default=None)
        self._commit([*self.runs, name], [*self.windows, windows], [*self.texts, texts], highest)
        while len(self.runs) > max(1, self.max_runs):
            self.compact()
        return found, answer

    def add(self, batch: DataFrame) -> DataFrame:
        """Repeats between the batch and all before it, as (late, key, s, kind), written out; the batch joins the index.

        A document of a smaller id than an earlier batch had is an error. Documents without id are later than all that the index has so far,
        and than their own batch.
        """
        return self._take(batch, None, "")[0]

    def answer(self, batch: DataFrame, digest: Callable, schema: str) -> DataFrame:
        """As `add`, but what `digest` makes of each document of the batch: doc_id and `schema`, written out; older documents aren't read."""
        return self._take(batch, digest, schema)[1]

    def _merged(self, names: list[str], layout: Layout) -> str:
        """One table of two, with the first document of each name."""
        one, two = (self._old(r, layout).groupBy("g", "s").agg(F.min("key").alias("key")) for r in names)
        with _merging(self.spark):
            both = one.join(two.withColumnRenamed("key", "other").hint("merge"), ["g", "s"], "full")
            return self._write(both.select("g", "s", F.least("key", "other").alias("key"), F.lit(PLAIN).cast("tinyint").alias("kind")), layout)

    def compact(self) -> None:
        """Merge the oldest two tables of fingerprints into one, and those of windows."""
        old = [*self.runs[:2], *self.windows[:2]]
        runs, windows = self._merged(self.runs[:2], FINGERPRINTS), self._merged(self.windows[:2], WINDOWS)
        self._commit([runs, *self.runs[2:]], [windows, *self.windows[2:]], self.texts, self.highest)
        for run in old:
            drop_path(self.spark, f"{self.folder}/{run}")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_blocks(batches):
        r, gone = covered_units(SPEC, batch, texts)
        raw, n_words, n_removed, digests = r.blob.tobytes(), [], [], []
        for first, last in zip(r.first.tolist(), r.last.tolist(), strict=True):
            cut = gone[first:last]
            keep = first + np.flatnonzero(~cut)
            n_words.append(last - first)
            n_removed.append(last - first - len(keep))
            digests.append(hashlib.sha256(b" ".join([raw[a:b] for a, b in zip(r.starts[keep].tolist(), r.ends[keep].tolist(), strict=True)])).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("late"), batch.column("key"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests)], ["late", "key", "n_words", "n_removed", "kept_sha256"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_blocks(batches):
        r, gone = covered_units(SPEC, batch, texts)
        raw, kept = r.blob.tobytes(), []
        for first, last in zip(r.first.tolist(), r.last.tolist(), strict=True):
            keep = first + np.flatnonzero(~gone[first:last])
            kept.append(b" ".join([raw[a:b] for a, b in zip(r.starts[keep].tolist(), r.ends[keep].tolist(), strict=True)]).decode())
        yield pa.RecordBatch.from_arrays([batch.column("late"), batch.column("key"), pa.array(kept, pa.string())], ["late", "key", "kept_text"])


def _cut(documents: DataFrame, batches: int) -> Iterator[DataFrame]:
    """The documents in batches of about equal size, by rising doc_id; those without id are in the last one."""
    shares = [i / batches for i in range(1, batches)]
    ends = documents.select(F.percentile_approx(F.col("doc_id").cast("bigint"), shares, 10000)).first()[0] if shares else []
    key, low = F.col("doc_id").cast("bigint"), None
    for end in [*sorted(set(ends or [])), None]:
        batch = documents
        if low is not None:
            batch = batch.where((key > low) | key.isNull())
        if end is not None:
            batch = batch.where(key <= end)
        yield batch
        low = end


def find_repeats(documents: DataFrame, batches: int = BATCHES, index: FingerprintIndex | None = None) -> DataFrame:
    """(late, key, covered, open) of all documents, batch by batch through an index."""
    index = index or FingerprintIndex(documents.sparkSession)
    found = [index.add(batch) for batch in _cut(documents, batches)]
    return materialize(by_document(reduce(DataFrame.unionByName, found)), "replies")


def by_batches(documents: DataFrame, digest: Callable, schema: str, batches: int = BATCHES, index: FingerprintIndex | None = None) -> DataFrame:
    """doc_id and `schema` of all documents, batch by batch; each batch is answered as it joins the index."""
    index = index or FingerprintIndex(documents.sparkSession)
    return reduce(DataFrame.unionByName, [index.answer(batch, digest, schema) for batch in _cut(documents, batches)])


def remove_repeats(documents: DataFrame) -> DataFrame:
    """(doc_id, kept_text): the words that stay, joined by single spaces."""
    return by_batches(documents, _kept, "kept_text string")


def op8_fingerprint_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, removed words and digest of the rest for every document."""
    return by_batches(table(spark, sf_dir, "documents"), _digest, "n_words bigint, n_removed bigint, kept_sha256 string")


OP8_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS s FROM d WHERE len(w) >= 13),
f AS (SELECT s, min(doc_id) AS first_doc FROM x GROUP BY 1),
g AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM x JOIN f USING (s) WHERE doc_id > first_doc) GROUP BY 1),
k AS (SELECT d.doc_id, w, list_filter(range(1, len(w) + 1), lambda i: gone IS NULL OR NOT list_contains(gone, i)) AS keep FROM d LEFT JOIN g USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - len(keep) AS BIGINT) AS n_removed, sha256(coalesce(array_to_string(list_transform(keep, lambda i: w[i]), ' '), '')) AS kept_sha256 FROM k
"""
