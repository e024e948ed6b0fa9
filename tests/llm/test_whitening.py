"""Whitening against numpy and Python's integers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from cytospark.llm import whitening as Wh

SCHEMA = "vec_id bigint, embedding array<float>, x int"


def brute(rows: list[tuple]) -> dict[tuple, tuple]:
    """(id, x, component) -> (n, deviation, |whitened|, explained), of vectors of one length."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = [list(x) for x in {tuple(x) for _, x in kept}]
    n, d = len(fit), len(fit[0])
    s = [sum(x[k] for x in fit) for k in range(d)]
    centred = np.array(fit, float) - np.array([k / n for k in s])
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    out = {}
    for i, x in kept:
        z = (np.array(x, float) - np.array([k / n for k in s])) @ u / np.sqrt(e)
        for c in range(min(16, d)):
            out[i, tuple(x), c + 1] = (n, sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True)), abs(z[c]), e[c] / np.trace(v))
    return out


def check(got, rows) -> None:
    want = brute(rows)
    by_id = {(i, c): w for (i, _, c), w in want.items()}
    assert len(got) == len(want) == len(by_id)
    for r in got:
        n, deviation, whitened, explained = by_id[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(whitened, rel=1e-6, abs=1e-7)
        assert r.explained == pytest.approx(explained, rel=1e-9)
        assert 0 <= r.identity_error < 1e-8


def test_scatter_is_exact():
    rng = np.random.default_rng(1)
    for most in (1, 50, 1 << 20, 1 << 48):
        y = rng.integers(-most, most, (130, 5))
        assert (Wh.scatter(y) == y.astype(object).T @ y.astype(object)).all()


def test_whole_table(spark, small):
    got = Wh.op11_embedding_whitening(spark, small).collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    check(got, rows)
    # over the fit list the whitened values have the identity as covariance
    z = np.zeros((max(r.vec_id for r in got) + 1, 16))
    for r in got:
        z[r.vec_id, r.component - 1] = r.whitened
    z = z[sorted({r.vec_id for r in got})]
    assert np.abs(z.T @ z / len(z) - np.eye(16)).max() < 1e-6 or len({tuple(r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()}) < len(z)


def test_repeats_nulls_and_non_finite(spark):
    rng = np.random.default_rng(7)
    base = [(i, [float(np.float32(x)) for x in rng.normal(size=3)]) for i in range(40)]
    rows = base + [(100 + i, base[0][1]) for i in range(30)]
    bad = [(200, None), (201, [None, 1.0, 2.0]), (202, [float("nan"), 1.0, 2.0]), (203, [1.0, float("-inf"), 2.0]), (204, [])]
    e = spark.createDataFrame([(*r, 0) for r in rows + bad], SCHEMA).repartition(5)
    got = Wh.whiten(e, Wh.fit(e)).collect()
    check(got, rows)
    assert {r.n for r in got} == {40}


def test_lengths_are_fitted_apart(spark):
    rng = np.random.default_rng(8)
    two = [(i, [float(np.float32(x)) for x in rng.normal(size=2)]) for i in range(20)]
    four = [(100 + i, [float(np.float32(x)) for x in rng.normal(size=4)]) for i in range(30)]
    e = spark.createDataFrame([(*r, 0) for r in two + four], SCHEMA)
    got = Wh.whiten(e, Wh.fit(e)).collect()
    check([r for r in got if r.vec_id < 100], two)
    check([r for r in got if r.vec_id >= 100], four)


def test_no_variance_large_entries_and_empty_table(spark):
    e = spark.createDataFrame([(1, [0.5, 0.5], 0), (None, [0.5, 0.5], 0)], SCHEMA)
    got = Wh.whiten(e, Wh.fit(e)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got] == [(1, 0, None, None, 0.0)] * 4
    assert {r.vec_id for r in got} == {1, None}
    big = spark.createDataFrame([(1, [3e38, 0.0], 0), (2, [-3e38, 1.0], 0), (3, [0.0, 2.0], 0)], SCHEMA)
    got = Wh.whiten(big, Wh.fit(big)).collect()
    assert len(got) == 6 and max(r.deviation for r in got) > 1 << 63
    none = spark.createDataFrame([], SCHEMA)
    assert Wh.whiten(none, Wh.fit(none)).count() == 0
