"""Distributed ranks and quantiles, tiles of images and suppression, against plain versions."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from cytospark.functions import order
from cytospark.operators import imaging


def frame(spark, n=3000):
    rng = np.random.default_rng(11)
    v = np.round(rng.normal(size=n), 2)
    v[: n // 3] = 0.5  # a value that a third of the rows have
    rows = [(None if i % 13 == 0 else "ab"[i % 2], float(x) if i % 17 else None) for i, x in enumerate(v)]
    return spark.createDataFrame(rows, "g string, v double").repartition(5), pd.DataFrame(rows, columns=["g", "v"])


def test_ranks(spark):
    df, rows = frame(spark)
    for by in ([], ["g"]):
        got = order.dense_ranks(order.average_ranks(df, "v", "r", by), "v", "d", by).toPandas()
        assert len(got) == len(rows)
        groups = [got] if not by else [g for _, g in got.groupby("g", dropna=False)]
        for g in groups:
            assert (g.r.fillna(-1) == g.v.rank().fillna(-1)).all() and (g.d.fillna(-1) == g.v.rank(method="dense").fillna(-1)).all()
    plan = order.counts_below(df, [], "v")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("__part")[0]


@pytest.mark.parametrize(("bins", "small"), [(1024, 0), (2, 0), (1024, 1000)])
def test_quantiles(spark, monkeypatch, bins, small):
    monkeypatch.setattr(order, "BINS", bins)
    monkeypatch.setattr(order, "SMALL", small)
    df, rows = frame(spark, 400)
    qs = [0.0, 0.1, 0.5, 0.95, 1.0]
    got = {r.g: r for r in order.quantiles(df, ["g"], "v", qs).collect()}
    for g, own in rows.groupby(rows.g.fillna("-")):
        want = np.quantile(own.v.dropna(), qs)
        r = got[None if g == "-" else g]
        assert r.n == own.v.notna().sum() and [r[f"q{i}"] for i in range(5)] == pytest.approx(list(want), rel=1e-12)
    one = order.quantiles(df, [], "v", [0.25]).first()
    assert one.q0 == pytest.approx(rows.v.quantile(0.25), rel=1e-12)


@pytest.mark.parametrize("small", [0, 1000])
def test_quantiles_edges(spark, monkeypatch, small):
    monkeypatch.setattr(order, "SMALL", small)
    rows = [("one", 4.0), ("inf", float("inf")), ("inf", float("-inf")), ("inf", 1.0), ("nan", float("nan")), ("none", None), ("wide", -1.7e308), ("wide", 1.7e308), ("wide", 0.0), *[("same", 2.5)] * 50]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.n, r.q0) for r in order.quantiles(df, ["g"], "v", [0.5]).collect()}
    assert got == {"one": (1, 4.0), "inf": (3, 1.0), "wide": (3, 0.0), "same": (50, 2.5)}
    assert order.quantiles(df.where("false"), ["g"], "v", [0.5]).count() == 0


def picture(height, width, seed):
    rng = np.random.default_rng(seed)
    image = rng.random((height, width)).cumsum(1) % 3.0
    return image, pd.DataFrame([("x", a, b, float(image[a, b])) for a in range(height) for b in range(width)], columns=["fov", "i", "j", "v"])


def test_kernels_on_tiles_see_the_whole_image(spark, monkeypatch):
    image, rows = picture(40, 70, 1)
    px = spark.createDataFrame(rows)
    score = imaging.log_score(image, 1.0)
    want = {(int(a), int(b)) for a, b in zip(*np.nonzero(imaging.local_maxima(score, 5, 0.2)), strict=True)}
    bright = {(int(a), int(b)) for a, b in zip(*np.nonzero(imaging.local_maxima(image, 3, float(np.percentile(image, 90)))), strict=True)}
    for tile in (512, 16):
        monkeypatch.setattr(imaging, "TILE", tile)
        got = {(r.i, r.j): r.score for r in imaging.score_images(px, ["fov"]).collect()}
        assert len(got) == image.size and all(s == pytest.approx(score[at], abs=1e-9) for at, s in got.items())
        assert {(r.i, r.j) for r in imaging.log_candidates(px, ["fov"], 1.0, 5, 0.2).collect()} == want
        assert {(r.i, r.j) for r in imaging.bright_points(px, ["fov"], 90.0, 3).collect()} == bright


def flood(mask):
    label, n = np.zeros(mask.shape, int), 0
    for a in range(mask.shape[0]):
        for b in range(mask.shape[1]):
            if mask[a, b] and not label[a, b]:
                n += 1
                todo = [(a, b)]
                while todo:
                    x, y = todo.pop()
                    if 0 <= x < mask.shape[0] and 0 <= y < mask.shape[1] and mask[x, y] and not label[x, y]:
                        label[x, y] = n
                        todo += [(x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)]
    return label


def test_components_by_tiles(spark):
    """Random pixels and a spiral through all tiles; edges of the graph are those of seams."""
    rng = np.random.default_rng(3)
    noise = rng.random((30, 41)) < 0.6
    spiral = np.zeros((33, 33), bool)
    a, b, x, y, left = 0, 0, 0, 1, [33, 33]
    spiral[0, 0] = True
    for turn in range(30):
        for _ in range(33 - 2 * ((turn + 1) // 2) - 1 if turn else 32):
            if 0 <= a + x < 33 and 0 <= b + y < 33:
                a, b = a + x, b + y
                spiral[a, b] = True
        x, y = y, -x
    rows = [(f, int(p), int(q)) for f, m in (("noise", noise), ("spiral", spiral)) for p, q in zip(*np.nonzero(m), strict=True)]
    mask = spark.createDataFrame(rows, "fov string, i int, j int")
    want = {(f, int(p), int(q)): int(label[p, q]) for f, label in (("noise", flood(noise)), ("spiral", flood(spiral))) for p, q in zip(*np.nonzero(label), strict=True)}
    for side in (512, 8, 3):
        got = {(r.fov, r.i, r.j): r.label for r in imaging.label_components(mask, ["fov"], 41, side).collect()}
        assert got == want
    assert imaging.label_components(mask.where("false"), ["fov"], 41).count() == 0


def test_nearest_labels_and_tiles(spark, monkeypatch):
    rng = np.random.default_rng(6)
    label = np.where(rng.random((37, 45)) < 0.01, rng.integers(1, 9, (37, 45)), 0)
    for distance in (0.5, 2.0, 10.0, 3.5):
        want = np.zeros_like(label)
        at = np.argwhere(label > 0)
        for a in range(label.shape[0]):
            for b in range(label.shape[1]):
                near = min(((p - a) ** 2 + (q - b) ** 2, int(label[p, q])) for p, q in at)
                want[a, b] = near[1] if near[0] <= distance**2 else 0
        assert (imaging.nearest_labels(label, distance) == want).all()
    monkeypatch.setattr(imaging, "TILE", 16)
    rows = [("x", int(a), int(b), int(label[a, b])) for a in range(37) for b in range(45)]
    px = spark.createDataFrame(rows, "fov string, i int, j int, label int")
    got = imaging.expand_labels(px.where("label > 0"), px.where("label = 0 AND j <> 7").drop("label"), ["fov"], 3.5)
    assert {(r.i, r.j): r.label for r in got.collect()} == {(a, b): int(want[a, b]) for a in range(37) for b in range(45) if want[a, b] and (b != 7 or label[a, b])}


def greedy(rows, distance):
    kept = []
    for r in sorted(rows, key=lambda r: (-r[3], r[1], r[2])):
        if all(k[0] != r[0] or (k[1] - r[1]) ** 2 + (k[2] - r[2]) ** 2 >= distance**2 for k in kept):
            kept.append(r)
    return sorted(kept)


def test_suppression_along_a_chain_of_scores(spark):
    """A line of falling scores, where each spot waits for the one before, and random spots; few rounds, whatever the chain's length."""
    rng = np.random.default_rng(9)
    line = [("line", 2 * n, 0, float(1000 - n)) for n in range(300)]
    spots = [("cloud", int(a), int(b), float(s)) for a, b, s in zip(rng.integers(0, 60, 300), rng.integers(0, 60, 300), rng.integers(0, 40, 300), strict=True)]
    rows = sorted(set(line + spots))
    df = spark.createDataFrame(rows, "fov string, i bigint, j bigint, score double").repartition(3)
    for tile in (None, 20.0):
        got = imaging.suppress(df, ["fov"], 5.0, tile=tile)
        assert got.columns == ["fov", "i", "j", "score"]
        want = greedy([r for r in rows if r[0] == "line"], 5.0) + greedy([r for r in rows if r[0] == "cloud"], 5.0)
        assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert imaging.suppress(df.where("false"), ["fov"], 5.0).count() == 0


def test_otsu_of_floats(spark):
    """Bins of equal width, and the middle of the best one."""
    rng = np.random.default_rng(12)
    v = np.concatenate((rng.normal(1, 0.2, 500), rng.normal(4, 0.5, 300)))
    counts, edges = np.histogram(v, 256)
    middle, best = (edges[1:] + edges[:-1]) / 2, (-1.0, 0.0)
    for n in range(255):
        w1, w2 = counts[: n + 1].sum(), counts[n + 1 :].sum()
        m1, m2 = (counts[: n + 1] * middle[: n + 1]).sum() / w1, (counts[n + 1 :] * middle[n + 1 :]).sum() / w2
        best = max(best, (w1 * w2 * (m1 - m2) ** 2, -middle[n]))
    px = spark.createDataFrame([("x", n, 0, float(x)) for n, x in enumerate(v)], "fov string, i int, j int, v double")
    assert imaging.otsu(px, ["fov"], 256).first().threshold == pytest.approx(-best[1], rel=1e-9)
