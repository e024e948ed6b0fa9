"""Severity of toxic text by cumulative-link ordinal regression on sparse word features.

Grades are ordered: 0 good, 1 of low quality, 2 toxic (from the columns quality and toxic of the labels). One weight
vector serves all thresholds: P(grade > k) = sigmoid(w . x - theta_k) with theta_0 < theta_1, and the expected severity is the
sum of these probabilities. A feature is whether a word, or a stem (the first bytes of longer words), occurs in the text, for those that Spark's counts over the labelled
sample show to depend on a grade (chi-squared above `MIN_CHI2`).

The model is fitted on a bounded sample, the `SAMPLE` labelled documents of the smallest hash of doc_id; all their words that pass the test go to the
driver, which is what bounds the model.
All documents are scored, whole texts, by one pass without a shuffle.

Nulls and edge cases: a null or empty text has no features and gets the base rate; labels with a null, and labels of no
document, are left out; without usable labels nothing is toxic; a repeated label counts as often; repeated rows give a row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ALNUM_LOWER, Rolling, byte_symbols, join_texts, materialize, mix, numbered, restored, table, text_blocks, words_of

#: The most labelled documents that the fit looks at.
SAMPLE = 20_000
#: Words of the model: each in so many documents of the sample at least, with such a chi-squared.
MIN_DOCS, MIN_CHI2 = 5, 25.0
#: Bytes of the stems that are features beside the whole words.
STEMS = (8,)
#: Grades, steps and step size of the fit, and its ridge penalty.
GRADES, STEPS, RATE, RIDGE = 3, 400, 0.1, 1e-4
#: A document is rejected if P(grade = 2) is at least this.
CUTOFF = 0.5


def _word_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, hash of a word or stem) pairs, sorted by text."""
    blob, bounds = join_texts([t.lower() for t in texts])
    starts, ends, before = words_of(blob, bounds, ALNUM_LOWER)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc, roll = np.repeat(np.arange(len(texts)), np.diff(before)), Rolling(byte_symbols(blob))
    docs, names = [doc], [roll(starts, ends)]
    for n in STEMS:
        longer = ends - starts > n
        docs.append(doc[longer])
        names.append(mix(roll(starts[longer], starts[longer] + n) ^ np.uint64(n)))
    doc, hashes = np.concatenate(docs), np.concatenate(names)
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])))
    return doc[new], hashes[new]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_blocks(batches):
        doc, hashes = _word_sets(texts)
        words = np.split(hashes.view(np.int64), np.searchsorted(doc, np.arange(1, len(texts))))
        yield pa.RecordBatch.from_arrays([batch.column("grade"), pa.array(words, pa.list_(pa.int64()))], ["grade", "words"])


def labelled_features(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(grade, words) of the sampled labelled documents; words are hashes of the distinct words."""
    grade = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0).alias("grade")
    some = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL AND quality IS NOT NULL").select("doc_id", grade)
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample)
    found = documents.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("grade", "text")
    return found.mapInArrow(_features, "grade int, words array<bigint>")


def fit(features: DataFrame) -> dict:
    """Words (sorted hashes), their weights, and the thresholds, from (grade, words)."""
    features = materialize(features, "features")
    totals = np.zeros(GRADES)
    for g, n in features.groupBy("grade").count().collect():
        totals[g] = n
    n = totals.sum()
    # chi-squared of a word against "grade above k", from counts by word and grade
    counts = features.select("grade", F.explode("words").alias("word")).groupBy("word").agg(*[F.count_if(F.col("grade") == g).alias(f"g{g}") for g in range(GRADES)])
    seen = sum(F.col(f"g{g}") for g in range(GRADES))
    scores = []
    for k in range(GRADES - 1):
        above, pos = sum(F.col(f"g{g}") for g in range(k + 1, GRADES)), float(totals[k + 1 :].sum())
        if 0 < pos < n:
            scores.append(F.lit(float(n)) * F.pow(above * float(n) - seen * pos, F.lit(2.0)) / (seen * (float(n) - seen + 0.5) * pos * (float(n) - pos)))
    if not scores:
        return {"words": np.zeros(0, np.uint64), "weights": np.zeros(0), "theta": np.array([50.0, 60.0])}
    score = F.greatest(*scores) if len(scores) > 1 else scores[0]
    chosen = counts.where((seen >= MIN_DOCS) & (score >= MIN_CHI2)).select("word")
    words = np.sort(np.array([r[0] for r in chosen.collect()], np.int64).view(np.uint64))
    chosen = features.mapInArrow(_chooser(features.sparkSession.sparkContext.broadcast(words)), "grade int, columns binary")
    rows = chosen.groupBy("grade", "columns").count().orderBy("grade", "columns").collect()
    return {"words": words, **_ordinal(rows, words)}


def _numbers(words: np.ndarray) -> str:
    """The type of a document's column numbers."""
    return "<u2" if len(words) <= 1 << 16 else "<u4"


def _chooser(words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The model's columns of each document, in order, as 16-bit numbers, or 32-bit ones where there are many words."""
        known = words.value
        for batch in batches:
            columns = []
            for own in batch.column("words"):
                own = own.values.to_numpy().view(np.uint64)
                at = np.minimum(np.searchsorted(known, own), max(len(known) - 1, 0))
                columns.append(np.sort(at[known[at] == own]).astype(_numbers(known)).tobytes() if len(known) else b"")
            yield pa.RecordBatch.from_arrays([batch.column("grade"), pa.array(columns, pa.binary())], ["grade", "columns"])

    return run


def _ordinal(rows: list, words: np.ndarray) -> dict:
    """Weights and thresholds by gradient steps (Adam) on the mean log-likelihood of (grade, columns, count)."""
    grade, times = np.array([r[0] for r in rows]), np.array([r[2] for r in rows], float)
    parts = [np.frombuffer(r[1], _numbers(words)) for r in rows]
    at = np.repeat(np.arange(len(rows)), [len(p) for p in parts])
    col = np.concatenate(parts).astype(np.int64)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    total = times.sum()
    above = [(times[grade > k].sum() + 0.5) / (total + 1) for k in range(GRADES - 1)]
    first = -np.log(above[0] / (1 - above[0]))
    gap = np.log(np.maximum(np.diff([-np.log(a / (1 - a)) for a in above]), 1e-2))  # thresholds stay ordered as sums of exponentials
    x = np.concatenate((np.zeros(len(words)), [first], gap))
    m, v = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, STEPS + 1):
        w, theta = x[: len(words)], x[len(words)] + np.concatenate(([0.0], np.cumsum(np.exp(x[len(words) + 1 :]))))
        z = np.bincount(at, w[col], len(rows))
        # P(grade > k) at both ends of each row's grade; its likelihood is their difference
        s = np.concatenate((np.ones((len(rows), 1)), sigmoid(z[:, None] - theta), np.zeros((len(rows), 1))), 1)
        d = s * (1 - s)
        index = np.arange(len(rows))
        high, low = s[index, grade], s[index, grade + 1]
        inv = times / np.maximum(high - low, 1e-12) / total
        g_high, g_low = d[index, grade] * inv, d[index, grade + 1] * inv
        grad_z = -(g_high - g_low)
        grad_theta = np.array([-(g_low[grade == k].sum() - g_high[grade == k + 1].sum()) for k in range(GRADES - 1)])
        grad = np.concatenate((np.bincount(col, grad_z[at], len(words)) + RIDGE * w, [grad_theta.sum()], np.exp(x[len(words) + 1 :]) * np.cumsum(grad_theta[::-1])[::-1][1:]))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        x = x - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return {"weights": x[: len(words)], "theta": x[len(words)] + np.concatenate(([0.0], np.cumsum(np.exp(x[len(words) + 1 :]))))}


def probabilities(model: dict, texts: list[bytes]) -> np.ndarray:
    """P(grade > k) of each text, a column for each k."""
    doc, hashes = _word_sets(texts)
    z = np.zeros(len(texts))
    if len(model["words"]) and len(doc):
        seen = np.zeros(1 << 16, bool)
        seen[model["words"] & np.uint64(0xFFFF)] = True
        maybe = np.flatnonzero(seen[hashes & np.uint64(0xFFFF)])
        at = np.minimum(np.searchsorted(model["words"], hashes[maybe]), len(model["words"]) - 1)
        same = model["words"][at] == hashes[maybe]
        z = np.bincount(doc[maybe[same]], model["weights"][at[same]], len(texts))
    return 1 / (1 + np.exp(-np.clip(z[:, None] - model["theta"], -40, 40)))


def _scorer(model, names: list[str], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches):
            p = probabilities(model.value, texts)
            columns = [batch.column(n) for n in names] + [pa.array(p.sum(1)), pa.array(p[:, -1])]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def score(documents: DataFrame, model: dict, keep: list[str]) -> DataFrame:
    """The columns `keep` of the documents, with __severity (0 to 2) and __p_toxic."""
    from pyspark.sql.pandas.types import to_arrow_schema

    part = documents.select(*dict.fromkeys([*keep, "text"]))
    schema = part.select(*keep).schema.add("__severity", "double").add("__p_toxic", "double")
    return part.mapInArrow(_scorer(documents.sparkSession.sparkContext.broadcast(model), keep, to_arrow_schema(schema)), schema)


def severity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, expected_severity, p_toxic, toxic) of every document."""
    out = score(documents, fit(labelled_features(documents, labels)), ["doc_id"])
    return out.select("doc_id", F.col("__severity").alias("expected_severity"), F.col("__p_toxic").alias("p_toxic"), (F.col("__p_toxic") >= CUTOFF).alias("toxic"))


def remove_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all columns, without those that the model rejects."""
    docs = numbered(documents, "doc_id", "text")
    out = score(docs, fit(labelled_features(docs, labels)), docs.columns)
    return restored(out.where(F.col("__p_toxic") < CUTOFF), docs, documents)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document."""
    return severity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
