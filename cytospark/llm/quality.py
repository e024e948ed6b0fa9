"""Quality of texts by histogram gradient-boosted trees over document statistics.

The statistics (`NAMES`) are of whole texts: shares of kinds of bytes, of words and of lines, and how much repeats. They don't look at which words a text has, nor at its id, source or language.
Labelled documents are split by crc32 of the id: those with remainder 0 modulo 5 are held out and never fitted. The fit takes a bounded sample of the others, the `SAMPLE`
of the smallest hash; each statistic is cut into `BINS` bins by quantiles, and trees of depth `DEPTH` grow level by level from histograms of gradients of the logistic loss.
Trees are complete and flattened: arrays of features, thresholds and leaves, so that one numpy step moves all documents of a block
through all trees by one level. All documents are scored in one pass without a shuffle.

Nulls and edge cases: a null text is empty and scored like one; a null doc_id isn't held out; labels without id or quality, or of no document, are left out, a repeated
label counts as often; without labels of both classes all get the base rate; repeated rows give a row each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NON_SPACE, Rolling, byte_symbols, byte_table, join_texts, mix, table, text_blocks, words_of

#: The most labelled documents that the fit looks at.
SAMPLE = 20_000
#: Bins of a statistic, depth, number and step of the trees, ridge of the leaves and least weight of a child.
BINS, DEPTH, TREES, RATE, RIDGE, LEAST = 64, 4, 120, 0.1, 1.0, 2.0
#: A text is good if its score is at least this.
CUTOFF = 0.3
#: Documents whose crc32 has remainder 0 modulo this are held out.
FOLDS = 5

_KINDS = {
    "upper": byte_table(range(0x41, 0x5B)),
    "lower": byte_table(range(0x61, 0x7B)),
    "digit": byte_table(range(0x30, 0x3A)),
    "beyond_ascii": byte_table(range(0x80, 0x100)),
    "space": ~NON_SPACE,
    "newline": byte_table([0x0A]),
    "stop": byte_table(b".!?"),
    "comma": byte_table(b",;:"),
    "markup": byte_table(b"<>{}[]|=_/\\"),
    "symbol": byte_table(b"#$%&*+@^`~"),
    "exclamation": byte_table(b"!"),
    "quote": byte_table(b"'\"()-"),
}
_LETTER = byte_table([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
NAMES = (
    *(f"{k}_share" for k in _KINDS),
    *("log_bytes", "log_words", "entropy", "word_bytes", "word_bytes_spread", "longest_word", "words_without_letter", "words_upper", "words_capital", "words_marked", "words_alone"),
    *("distinct_words", "top_word", "distinct_pairs", "distinct_triples", "lines", "line_words", "distinct_lines", "line_ends", "words_a_stop", "same_as_before"),
)


def _distinct(doc: np.ndarray, name: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """How many different names each document has, and how often its most frequent one occurs."""
    if not len(doc):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((name, doc))
    new = np.ones(len(doc), bool)
    new[1:] = (doc[order][1:] != doc[order][:-1]) | (name[order][1:] != name[order][:-1])
    at = np.flatnonzero(new)
    most = np.zeros(n)
    np.maximum.at(most, doc[order][at], np.diff(np.append(at, len(doc))))
    return np.bincount(doc[order][at], minlength=n).astype(float), most


def statistics(texts: list[bytes]) -> np.ndarray:
    """A row of `NAMES` for each text."""
    n = len(texts)
    blob, bounds = join_texts(texts)
    sizes = np.diff(bounds) - 1
    of_byte = np.repeat(np.arange(n), sizes + 1)
    inside = np.ones(len(blob), bool)
    inside[bounds[1:] - 1] = False  # the newline that was put after each text
    histogram = np.bincount(of_byte[inside] * 256 + blob[inside], minlength=n * 256).reshape(n, 256).astype(float)
    some = np.maximum(sizes, 1).astype(float)
    out = [histogram[:, flags].sum(1) / some for flags in _KINDS.values()]
    share = histogram / some[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(1)

    starts, ends, before = words_of(blob, bounds, NON_SPACE)
    doc = np.repeat(np.arange(n), np.diff(before))
    words = np.diff(before).astype(float)
    per_word = np.maximum(words, 1)
    total = lambda x: np.bincount(doc, x, n)
    length = (ends - starts).astype(float)
    mean = total(length) / per_word
    running = {k: np.append(0, np.cumsum(_KINDS[k][blob])) for k in ("upper", "lower", "symbol")}
    letters = np.append(0, np.cumsum(_LETTER[blob]))
    count = lambda c: c[ends] - c[starts]
    letter, upper = count(letters), count(running["upper"])
    longest = np.zeros(n)
    np.maximum.at(longest, doc, length)
    names = Rolling(byte_symbols(blob))(starts, ends)
    distinct, top = _distinct(doc, names, n)
    same = np.zeros(len(doc), bool)
    same[1:] = (names[1:] == names[:-1]) & (doc[1:] == doc[:-1])
    grams = []
    for k in (2, 3):
        whole = np.flatnonzero(doc[k - 1 :] == doc[: len(doc) - k + 1]) if len(doc) >= k else np.zeros(0, np.int64)
        gram = names[whole]
        for i in range(1, k):
            gram = mix(gram) ^ names[whole + i]
        grams.append(_distinct(doc[whole], gram, n)[0] / np.maximum(words - k + 1, 1))

    line_starts, line_ends, lines_before = words_of(blob, bounds, ~byte_table([0x0A]))
    line_doc, lines = np.repeat(np.arange(n), np.diff(lines_before)), np.diff(lines_before).astype(float)
    per_line = np.maximum(lines, 1)
    lines_distinct, _ = _distinct(line_doc, Rolling(byte_symbols(blob))(line_starts, line_ends), n)
    ended = np.bincount(line_doc, _KINDS["stop"][blob[line_ends - 1]].astype(float), n) / per_line
    stops = histogram[:, _KINDS["stop"]].sum(1)
    out += [np.log1p(sizes), np.log1p(words), entropy, mean, np.sqrt(np.maximum(total(length**2) / per_word - mean**2, 0)), longest]
    out += [total((letter == 0).astype(float)) / per_word, total(((upper > 1) & (count(running["lower"]) == 0)).astype(float)) / per_word, total(_KINDS["upper"][blob[starts]].astype(float)) / per_word]
    out += [total((count(running["symbol"]) > 0).astype(float)) / per_word, total((length == 1).astype(float)) / per_word]
    out += [distinct / per_word, top / per_word, *grams, lines, words / per_line, lines_distinct / per_line, ended, words / np.maximum(stops, 1), total(same.astype(float)) / per_word]
    return np.column_stack(out).astype(np.float32)


def held_out(doc_id: Column) -> Column:
    """Whether a document is never fitted."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_blocks(batches):
        x = statistics(texts)
        yield pa.RecordBatch.from_arrays([batch.column("good"), pa.array(list(x), pa.list_(pa.float32()))], ["good", "x"])


def labelled_statistics(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(good, x) of the sampled labelled documents that aren't held out."""
    some = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", (F.col("quality") == 1).alias("good"))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id", "good").limit(sample)
    found = documents.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("good", "text")
    return found.mapInArrow(_features, "good boolean, x array<float>")


def _grow(binned: np.ndarray, grad: np.ndarray, hess: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One complete tree: feature and threshold of its inner nodes, its leaves, and the leaf of each row. A node without a gain sends all to the left."""
    n, f = binned.shape
    node = np.zeros(n, np.int64)
    feature, threshold = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, np.inf, np.float32)
    columns = np.arange(f) * BINS
    for level in range(DEPTH):
        width = 1 << level
        slot = (node[:, None] * (f * BINS) + columns + binned).ravel()
        g, h = (np.bincount(slot, np.repeat(x, f), width * f * BINS).reshape(width, f, BINS).cumsum(2) for x in (grad, hess))
        gt, ht = g[:, :, -1:], h[:, :, -1:]
        gain = g**2 / (h + RIDGE) + (gt - g) ** 2 / (ht - h + RIDGE) - gt**2 / (ht + RIDGE)
        gain[(h < LEAST) | (ht - h < LEAST)] = 0
        gain[:, :, -1] = 0
        best = gain.reshape(width, -1).argmax(1)
        own, cut = best // BINS, best % BINS
        worth = gain.reshape(width, -1)[np.arange(width), best] > 1e-9
        at = width - 1 + np.arange(width)
        feature[at], threshold[at] = own, np.where(worth, cuts[own, np.minimum(cut, BINS - 2)], np.inf)
        node = 2 * node + (worth[node] & (binned[np.arange(n), own[node]] > cut[node]))
    g, h = (np.bincount(node, x, 2**DEPTH) for x in (grad, hess))
    return feature, threshold, (-RATE * g / (h + RIDGE)).astype(np.float32), node


def fit(rows: DataFrame) -> dict:
    """Flattened trees from (good, x), which are `SAMPLE` rows at most."""
    found = sorted((bool(r.good), tuple(r.x)) for r in rows.collect())
    y = np.array([r[0] for r in found], float)
    base = (y.sum() + 0.5) / (len(y) + 1)
    model = {"base": float(np.log(base / (1 - base))), "feature": np.zeros((0, 2**DEPTH - 1), np.int64), "threshold": np.zeros((0, 2**DEPTH - 1), np.float32), "leaf": np.zeros((0, 2**DEPTH), np.float32)}
    if len(set(y.tolist())) < 2:
        return model
    x = np.array([r[1] for r in found], np.float32)
    cuts = np.quantile(x, np.arange(1, BINS) / BINS, axis=0, method="lower").T.astype(np.float32)
    binned = np.column_stack([np.searchsorted(c, x[:, k], "left") for k, c in enumerate(cuts)])
    z, trees = np.full(len(y), model["base"]), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        feature, threshold, leaf, at = _grow(binned, p - y, p * (1 - p), cuts)
        z += leaf[at]
        trees.append((feature, threshold, leaf))
    return model | {k: np.stack(v) for k, v in zip(("feature", "threshold", "leaf"), zip(*trees, strict=True), strict=True)}


def scores(model: dict, x: np.ndarray) -> np.ndarray:
    """Probability of a good text for each row of statistics."""
    trees = np.arange(len(model["leaf"]))
    node = np.zeros((len(x), len(trees)), np.int64)
    rows = np.arange(len(x))[:, None]
    for _ in range(DEPTH):
        node = 2 * node + 1 + (x[rows, model["feature"][trees, node]] > model["threshold"][trees, node])
    z = model["base"] + model["leaf"][trees, node - (2**DEPTH - 1)].sum(1, dtype=float) if len(trees) else np.full(len(x), model["base"])
    return 1 / (1 + np.exp(-z))


def _scorer(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores(sent.value, statistics(texts)))], ["doc_id", "held_out", "score"])

    return run


def score(documents: DataFrame, model: dict) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    out = rows.mapInArrow(_scorer(documents.sparkSession.sparkContext.broadcast(model)), "doc_id bigint, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= CUTOFF).cast("int"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document, by trees fitted on labelled ones that aren't held out."""
    documents = table(spark, sf_dir, "documents")
    return score(documents, fit(labelled_statistics(documents, table(spark, sf_dir, "labels"))))
