"""Boosted trees: held-out accuracy on the labelled documents, statistics and trees against plain versions."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from cytospark.llm import quality as Q

TEXTS = ["", " ", "One two. Two ONE!\nlast line", "### $$$ a", "x" * 500, "é è é\né è é\n", "A B C D " * 50, "a\n\n\nb", "1 22 333"]


def plain(text: str) -> dict[str, float]:
    data = text.encode()
    words = [w.encode() for w in data.decode().replace("\x0b", " ").split() if w] if text.strip() else []
    lines = [x for x in data.split(b"\n") if x]
    n = max(1, len(words))
    share = [c / len(data) for c in Counter(data).values()]
    return {
        "upper_share": sum(65 <= b <= 90 for b in data) / max(1, len(data)),
        "beyond_ascii_share": sum(b >= 128 for b in data) / max(1, len(data)),
        "newline_share": data.count(b"\n") / max(1, len(data)),
        "log_bytes": math.log1p(len(data)),
        "log_words": math.log1p(len(words)),
        "entropy": -sum(p * math.log2(p) for p in share),
        "word_bytes": sum(map(len, words)) / n,
        "longest_word": max(map(len, words), default=0),
        "distinct_words": len(set(words)) / n,
        "top_word": max(Counter(words).values(), default=0) / n,
        "distinct_pairs": len(set(zip(words, words[1:], strict=False))) / max(1, len(words) - 1),
        "distinct_triples": len(set(zip(words, words[1:], words[2:], strict=False))) / max(1, len(words) - 2),
        "lines": len(lines),
        "distinct_lines": len(set(lines)) / max(1, len(lines)),
        "same_as_before": sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
    }


def test_statistics():
    for texts in (TEXTS, [TEXTS[0]], TEXTS[::-1]):
        x = Q.statistics([t.encode() for t in texts])
        assert x.shape == (len(texts), len(Q.NAMES)) and np.isfinite(x).all()
        for row, text in zip(x, texts, strict=True):
            for name, value in plain(text).items():
                assert row[Q.NAMES.index(name)] == pytest.approx(value, rel=1e-5, abs=1e-5), (name, text[:20])
    assert Q.statistics([]).shape == (0, len(Q.NAMES))


def test_flattened_trees_give_what_the_fit_saw():
    """Traversal of raw statistics reaches the leaves that growing by bins reached."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 5)).astype(np.float32)
    x[:, 4] = 1.0  # one value only
    y = (x[:, 0] > 0.3) ^ (x[:, 1] > 0)
    cuts = np.quantile(x, np.arange(1, Q.BINS) / Q.BINS, axis=0, method="lower").T.astype(np.float32)
    binned = np.column_stack([np.searchsorted(c, x[:, k], "left") for k, c in enumerate(cuts)])
    p = np.full(600, 0.5)
    feature, threshold, leaf, at = Q._grow(binned, p - y, p * (1 - p), cuts)
    model = {"base": 0.0, "feature": feature[None], "threshold": threshold[None], "leaf": leaf[None]}
    assert Q.scores(model, x) == pytest.approx(1 / (1 + np.exp(-leaf[at].astype(float))), rel=1e-6)
    for i in range(600):  # one by one
        k = 0
        while k < len(feature):
            k = 2 * k + 1 + int(x[i, feature[k]] > threshold[k])
        assert k - len(feature) == at[i]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in Q.op13_quality_classifier(spark, sf).collect()}
    labels = [tuple(r) for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect()]
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(q, got[i].predicted) for i, q in labels if got[i].held_out]
    assert sum(q == p for q, p in held) / len(held) >= 0.97
    assert sum(q == 0 == p for q, p in held) / max(1, sum(q == 0 for q, p in held)) >= 0.85


def test_held_out_labels_are_not_looked_at(spark, small):
    documents, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", (1 - labels.quality).cast("int")).where(Q.held_out(labels.doc_id))
    mixed = labels.where(~Q.held_out(labels.doc_id)).unionByName(turned)
    one, two = (Q.fit(Q.labelled_statistics(documents, x)) for x in (labels, mixed))
    assert (one["leaf"] == two["leaf"]).all() and (one["threshold"] == two["threshold"]).all()


def test_nulls_no_labels_and_empty_tables(spark):
    documents = spark.createDataFrame([(1, None, 1), (None, "some text", 2), (1, "", 3)], "doc_id int, text string, score int")
    labels = spark.createDataFrame([(1, None), (None, 0), (7, 1)], "doc_id bigint, quality int")
    model = Q.fit(Q.labelled_statistics(documents, labels))
    rows = Q.score(documents, model).collect()
    assert len(rows) == 3 and {r.score for r in rows} == {0.5}
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    assert Q.score(documents.limit(0), model).count() == 0
