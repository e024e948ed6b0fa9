"""Image families against plain numpy: calibration, suppression over markers, rescue in bands with their halos, decoding and assignment."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from test_order import flood

from cytospark.operators import imaging as I
from cytospark.plans import families as M
from cytospark.schemas import Codebook

BOOK = Codebook(("m0", "m1", "m2"), (("110", "A"), ("101", "B")), 2, 0)
H, W = 45, 38


@pytest.fixture(scope="module")
def images():
    """(image, marker) -> pixels: background noise and spots that are on in two markers, more of them in the positive images."""
    rng = np.random.default_rng(21)
    out = {}
    for image, n in ((0, 2), (1, 14), (2, 3), (3, 16)):
        stack = rng.random((3, H, W)) * 4 + 1
        for _ in range(n):
            a, b, off = int(rng.integers(3, H - 3)), int(rng.integers(3, W - 3)), int(rng.integers(0, 3))
            for m in range(3):
                if m != off:
                    stack[m, a - 1 : a + 2, b - 1 : b + 2] += 30 * rng.random() + 20
        for m in range(3):
            out[image, f"m{m}"] = stack[m]
    return out


@pytest.fixture(scope="module")
def px(spark, images):
    rows = [(image, m, "negative" if image % 2 == 0 else "positive", a, b, float(p[a, b])) for (image, m), p in images.items() for a in range(H) for b in range(W)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["image", "marker", "field", "i", "j", "v"])).repartition(6)


@pytest.fixture(scope="module")
def centroids(spark):
    rng = np.random.default_rng(22)
    rows = [(f"{image}|{n}", str(image), float(np.round(x * W)), float(np.round(y * H))) for image in range(4) for n, (x, y) in enumerate(rng.random((12, 2)))]
    return rows, spark.createDataFrame(rows, "cell string, field string, x double, y double")


def nms(spots, distance):
    """Greedy, by falling score, then ordinal, i and j; spots are (score, ordinal, i, j)."""
    kept = []
    for s in sorted(spots, key=lambda s: (-s[0], *s[1:])):
        if all(math.hypot(k[2] - s[2], k[3] - s[3]) >= distance for k in kept):
            kept.append(s)
    return kept


def maxima(image, family, threshold):
    score = I.log_score(image, family.sigma)
    return [(float(score[a, b]), a, b) for a, b in np.argwhere(I.local_maxima(score, family.width, threshold)).tolist()]


def ratio(image, a, b):
    core, ring = [], []
    for x in range(max(0, a - 5), min(H, a + 6)):
        for y in range(max(0, b - 5), min(W, b + 6)):
            d = math.hypot(x - a, y - b)
            core += [image[x, y]] if d <= 1 else []
            ring += [image[x, y]] if 3 < d <= 5 else []
    return max(core) / np.median(ring) if np.median(ring) > 0 else math.inf if max(core) > 0 else 0.0


def decoded(stack, a, b):
    """(code, weakest bit, margin, exact) of a place."""
    snr = [ratio(stack[m], a, b) for m in range(3)]
    order = sorted(range(3), key=lambda m: (-snr[m], m))
    code = "".join("1" if m in order[:2] else "0" for m in range(3))
    return code, snr[order[1]], snr[order[1]] - snr[order[2]], code in ("110", "101")


def score_of(negative, positive, family):
    rate = positive / negative if negative > 0 else math.inf if positive > 0 else 0.0
    passes = negative <= family.max_negative and positive >= family.min_positive
    return (0.0 if math.isinf(rate) else rate) + (1000.0 if passes else 0.0)


def calls(rows, spots, family):
    """Call of each cell from spots (image, i, j, code)."""
    bits = {c: [0, 0, 0] for c, *_ in rows}
    for image, a, b, code in spots:
        near = min(((math.sqrt((b - x) ** 2 + (a - y) ** 2), c) for c, field, x, y in rows if field == str(image)), default=(math.inf, ""))
        if near[0] < family.radius:
            bits[near[1]] = [n + int(c) for n, c in zip(bits[near[1]], code, strict=True)]
    out = {}
    for cell, n in bits.items():
        code = "".join("1" if x else "0" for x in n)
        call = dict(BOOK.calls).get(code)
        out[cell] = (sum(n), code, "no_barcode" if not sum(n) else "exact" if call else "ambiguous_mixed", call if call and sum(n) else "no_barcode")
    return out


def found(cells):
    return {r.cell: (r.total_barcode_spots, r.barcode, r.barcode_match_status, r.lnp_call) for r in cells.collect()}


def test_calibrated_family(px, images, centroids):
    family = M.Family(BOOK, width=7, distance=4.0, min_margin=0.0, radius=8.0, max_negative=1500.0, thresholds=(2.0, 5.0, 9.0, 14.0, 500.0), min_on=(0.8, 1.5, 3.0, 6.0))
    rows, frame = centroids
    got = M.calibrated_family(px, frame, ["image"], "marker", "field", family)
    area = 2 * H * W / 1e6
    chosen = {}
    table = {(r.marker, r.threshold): r for r in got["markers"].collect()}
    assert len(table) == 15
    for m in BOOK.markers:
        scores = []
        for t in family.thresholds:
            n = [sum(len(maxima(images[image, m], family, t)) for image in pair) / area for pair in ((0, 2), (1, 3))]
            r = table[m, t]
            assert (r.neg_matches_per_mpx, r.pos_matches_per_mpx) == pytest.approx(n) and r.selection_score == pytest.approx(score_of(*n, family))
            scores.append((-score_of(*n, family), t))
        chosen[m] = min(scores)[1]
    spots = []
    for image in range(4):
        stack = [images[image, m] for m in BOOK.markers]
        for _, _, a, b in nms([(s, k, a, b) for k, m in enumerate(BOOK.markers) for s, a, b in maxima(images[image, m], family, chosen[m])], family.distance):
            spots.append((image, a, b, *decoded(stack, a, b)))
    weakest = []
    for t in family.min_on:
        n = [sum(s[0] % 2 == side and s[6] and s[4] >= t for s in spots) / area for side in (0, 1)]
        weakest.append((-score_of(*n, family), t))
        r = next(r for r in got["decoding"].collect() if r.threshold == t)
        assert (r.neg_matches_per_mpx, r.pos_matches_per_mpx) == pytest.approx(n)
    limit = min(weakest)[1]
    want = calls(rows, [s[:4] for s in spots if s[4] >= limit and s[5] >= 0 and s[6]], family)
    assert found(got["cells"]) == want and any(c[3] != "no_barcode" for c in want.values())


def test_fixed_family_with_rescue(px, images, centroids):
    family = M.Family(BOOK, sigma=2.0, width=3, distance=3.0, min_margin=0.0, radius=8.0, min_on=(1.1,), threshold=2.0, own=(("m1", 3.5),), n_tiles=3, overlap=7, point_percentile=96.0, blob_percentile=97.0, areas=(4, 30))
    rows, frame = centroids
    got = M.fixed_family(px, frame, ["image"], "marker", family, H, W)
    want, spots, seeds = [], [], set()
    for image in range(4):
        stack = np.stack([images[image, m] for m in BOOK.markers])
        for tile in range(3):
            start, end = 15 * tile, 15 * tile + 15
            low, high = max(0, start - 7), min(H, end + 7)
            band = stack[:, low:high]
            first = nms([(s, k, a, b) for k, t in enumerate((2.0, 3.5, 2.0)) for s, a, b in maxima(band[k], family, t)], 3.0)
            top = band.max(0)
            points = I.local_maxima(top, 3, float(np.percentile(top, 96)))
            more = [(float(top[a, b]), 3, a, b) for a, b in np.argwhere(points).tolist()]
            label = flood(top > np.percentile(top, 97))
            for n in range(1, label.max() + 1):
                at = np.argwhere(label == n)
                if 4 <= len(at) <= 30:
                    w = np.array([top[a, b] for a, b in at])
                    a, b = (int(round(x)) for x in (at * w[:, None]).sum(0) / w.sum())
                    more.append((float(top[a, b]), 4, a, b))
            for s, k, a, b in nms(first + more, 3.0):
                if start <= a + low < end:
                    want.append((image, tile, a + low, b))
                    seeds.add(k)
                    spots.append((image, a + low, b, *decoded(stack, a + low, b)))
    assert sorted((r.image, r.tile, r.i, r.j) for r in got["candidates"].collect()) == sorted(want)
    assert {3, 4} & seeds and {0, 1, 2} & seeds
    assert found(got["cells"]) == calls(rows, {s[:4] for s in spots if s[4] >= 1.1 and s[5] >= 0 and s[6]}, family)


def test_parameters_of_the_four_families():
    assert [len(f.book.markers) for f in (M.FULL_BARCODE, M.SINGLE_BIT, M.ROUND_1, M.ROUND_2)] == [12, 1, 12, 15]
    assert M.ROUND_2.own and set(dict(M.ROUND_2.own)) <= set(M.ROUND_2.book.markers)
