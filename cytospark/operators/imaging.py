"""Spots and cells in images that are tables: long pixels (image columns, i, j, v), cut into bands where a kernel needs neighbours."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.order import dense_ranks, joined, quantiles, same_keys
from ..sources.scratch import materialize
from .components import components
from .spatial import nearest_within


def dense(pixels: DataFrame, by: Sequence[str], height: int, width: int) -> DataFrame:
    """Every pixel of every image; absent ones are 0."""
    grid = pixels.select(*by).distinct().withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(height - 1)))).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    # the grid seems small where it isn't, as Spark doesn't count what `explode` adds: never broadcast it
    return grid.hint("merge").join(pixels.withColumns({"i": F.col("i").cast("int"), "j": F.col("j").cast("int")}), [*by, "i", "j"], "left").fillna(0, ["v"])


def bands(pixels: DataFrame, height: int, n_tiles: int, overlap: int) -> DataFrame:
    """Pixels by band, with `core` for those that the band owns; a pixel in a halo belongs to several bands, the last band takes what is left."""
    size = max(1, height // n_tiles)
    last = F.lit(n_tiles - 1)
    own = F.least(F.floor(F.col("i") / size), last).cast("int")
    tiles = F.sequence(F.greatest(F.lit(0), F.least(F.floor((F.col("i") - overlap) / size), last)).cast("int"), F.greatest(F.lit(0), F.least(F.floor((F.col("i") + overlap) / size), last)).cast("int"))
    return pixels.withColumn("__own", own).withColumn("tile", F.explode(tiles)).withColumn("core", F.col("tile") == F.col("__own")).drop("__own")


def _kernels(sigma: float) -> tuple[np.ndarray, np.ndarray]:
    """A Gaussian and its second derivative, four sigmas wide."""
    x = np.arange(-int(4 * sigma + 0.5), int(4 * sigma + 0.5) + 1, dtype=float)
    g = np.exp(-(x**2) / (2 * sigma**2))
    g /= g.sum()
    return g, g * (x**2 / sigma**4 - 1 / sigma**2)


def log_score(image: np.ndarray, sigma: float) -> np.ndarray:
    """Minus the Laplacian of the Gaussian-smoothed image, edges mirrored."""
    g, second = _kernels(sigma)
    r = len(g) // 2

    def along(a: np.ndarray, k: np.ndarray, axis: int) -> np.ndarray:
        pad = [(r, r) if i == axis else (0, 0) for i in range(2)]
        view = np.lib.stride_tricks.sliding_window_view(np.pad(a, pad, mode="symmetric"), len(k), axis)
        return view @ k[::-1]

    return -(along(along(image, second, 0), g, 1) + along(along(image, g, 0), second, 1))


def local_maxima(score: np.ndarray, width: int, threshold: float) -> np.ndarray:
    """Where a pixel is the largest of the square around it and above the threshold."""
    r = width // 2
    top = score
    for axis in (0, 1):
        pad = [(r, width - 1 - r) if i == axis else (0, 0) for i in range(2)]
        top = np.lib.stride_tricks.sliding_window_view(np.pad(top, pad, constant_values=-np.inf), width, axis).max(-1)
    return (top == score) & (score > threshold)


def _grid(part: pd.DataFrame) -> tuple[np.ndarray, int, int]:
    i0, j0 = int(part["i"].min()), int(part["j"].min())
    image = np.zeros((int(part["i"].max()) - i0 + 1, int(part["j"].max()) - j0 + 1))
    image[part["i"].to_numpy() - i0, part["j"].to_numpy() - j0] = part["v"].to_numpy(float)
    return image, i0, j0


#: Pixels along the side of a tile.
TILE = 512


def _per_tile(pixels: DataFrame, by: Sequence[str], kernel, schema: str, reach: int, more: Sequence[str] = ()) -> DataFrame:
    """Applies a kernel (image, rows) to square tiles with a halo of `reach` pixels, and keeps what it finds in the tile itself.

    An image of any size comes as tiles of `TILE + 2 reach` pixels along a side at most. What a kernel finds at a pixel must not depend on more than the pixels within the reach; at the edges of the image
    there is no halo, so that a kernel sees them.
    """
    kinds = dict(pixels.dtypes)
    keys = ", ".join(f"`{c}` {kinds[c]}" for c in by)

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        image, i0, j0 = _grid(part)
        out = kernel(image, part)
        out["i"] += i0
        out["j"] += j0
        ti, tj = key[-2:]
        out = out[(out["i"] // TILE == ti) & (out["j"] // TILE == tj)]
        for n, (name, value) in enumerate(zip(by, key, strict=False)):
            out.insert(n, name, value)
        return out

    near = lambda c: F.explode(F.sequence(F.floor((F.col(c) - reach) / TILE), F.floor((F.col(c) + reach) / TILE)))
    cut = pixels.select(*by, "i", "j", "v", *more).withColumn("__ti", near("i")).withColumn("__tj", near("j"))
    # a tile with nothing but halo has nothing of its own
    own = pixels.select(*by, F.floor(F.col("i") / TILE).alias("__ti"), F.floor(F.col("j") / TILE).alias("__tj")).distinct()
    cut = cut.alias("a").join(own.alias("b"), same_keys([*by, "__ti", "__tj"], "a", "b"), "left_semi")
    return cut.groupBy(*by, "__ti", "__tj").applyInPandas(run, f"{keys}, {schema}")


def _reach(sigma: float) -> int:
    return int(4 * sigma + 0.5)


def score_images(pixels: DataFrame, by: Sequence[str], sigma: float = 1.0) -> DataFrame:
    """(by, i, j, score) of each pixel."""

    def kernel(image: np.ndarray, part: pd.DataFrame) -> pd.DataFrame:
        i, j = np.indices(image.shape)
        return pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "score": log_score(image, sigma).ravel()})

    return _per_tile(pixels, by, kernel, "i bigint, j bigint, score double", _reach(sigma))


def log_candidates(pixels: DataFrame, by: Sequence[str], sigma: float = 1.0, width: int = 21, threshold: float = 0.0) -> DataFrame:
    """(by, i, j, score) of the local maxima of the score."""

    def kernel(image: np.ndarray, part: pd.DataFrame) -> pd.DataFrame:
        score = log_score(image, sigma)
        i, j = np.nonzero(local_maxima(score, width, threshold))
        return pd.DataFrame({"i": i, "j": j, "score": score[i, j]})

    return _per_tile(pixels, by, kernel, "i bigint, j bigint, score double", _reach(sigma) + width)


def bright_points(pixels: DataFrame, by: Sequence[str], percentile: float = 98.0, width: int = 3) -> DataFrame:
    """(by, i, j, score) of local maxima of the raw values above the image's percentile."""

    def kernel(image: np.ndarray, part: pd.DataFrame) -> pd.DataFrame:
        i, j = np.nonzero(local_maxima(image, width, float(part["t"].iloc[0])))
        return pd.DataFrame({"i": i, "j": j, "score": image[i, j]})

    cut = quantiles(pixels, by, "v", [percentile / 100]).select(*by, F.col("q0").alias("t"))
    return _per_tile(joined(pixels, cut, by), by, kernel, "i bigint, j bigint, score double", width, ["t"])


def _decide(nodes: pd.DataFrame, distance: float) -> np.ndarray:
    """State of each node, in falling order of rank, as far as what is here decides it: 1 stays, 0 drops, -1 isn't decided.

    A node drops if one that outranks it stays nearer than the distance, and stays if all that outrank it there drop. Of nodes of the halo only what earlier rounds found is known.
    """
    i, j, known, core = nodes["i"].to_numpy(), nodes["j"].to_numpy(), nodes["state"].to_numpy(), nodes["core"].to_numpy()
    cells: dict[tuple[int, int], list[int]] = {}
    state = np.full(len(nodes), -1, np.int64)
    for n in range(len(nodes)):
        a, b = int(i[n] // distance), int(j[n] // distance)
        near = [m for x in (a - 1, a, a + 1) for y in (b - 1, b, b + 1) for m in cells.get((x, y), ()) if (i[m] - i[n]) ** 2 + (j[m] - j[n]) ** 2 < distance * distance]
        if known[n] >= 0:
            state[n] = known[n]
        elif core[n]:
            seen = state[near]
            state[n] = 0 if (seen == 1).any() else -1 if (seen == -1).any() else 1
        if state[n] != 0:  # dropped ones are in nobody's way
            cells.setdefault((a, b), []).append(n)
    return state


def suppress(candidates: DataFrame, by: Sequence[str], distance: float, ordinal: str | None = None, tile: float | None = None) -> DataFrame:
    """Greedy non-maximum suppression: the candidates that stay when each, in falling order of score, drops all nearer than `distance`.

    The order is total: score, ordinal, i, j. Candidates meet in square tiles (of 32 distances, if `tile` doesn't say) with a halo of the distance, where a kernel goes through them in order. It decides those that depend on
    nothing beyond the tile; in the next round the others know what their neighbours' tiles have found. Rounds follow a chain of falling scores from tile to tile and not from spot to spot.
    """
    side = float(tile or 32 * distance)
    columns = candidates.columns
    rank = F.struct((-F.col("score")).alias("s"), (F.col(ordinal) if ordinal else F.lit(0)).cast("bigint").alias("o"), F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"))
    nodes = materialize(candidates.withColumn("__rank", rank).withColumn("__group", F.to_json(F.struct(*by)) if by else F.lit("")), "candidates")
    key = ["__group", "__rank"]
    live = nodes.select(*key).distinct().withColumn("state", F.lit(-1))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["s", "o", "i", "j"], ignore_index=True)
        state = _decide(part, distance)
        out = part.assign(state=state)
        return out.loc[part["core"].to_numpy() & (part["state"].to_numpy() < 0), ["__group", "s", "o", "i", "j", "state"]]

    kept = None
    near = lambda c: F.explode(F.sequence(F.floor((F.col(c) - distance) / side), F.floor((F.col(c) + distance) / side)))
    while True:
        placed = live.select("__group", "__rank.*", "state").withColumn("a", near("i")).withColumn("b", near("j"))
        placed = placed.withColumn("core", (F.col("a") == F.floor(F.col("i") / side)) & (F.col("b") == F.floor(F.col("j") / side)))
        found = placed.groupBy("__group", "a", "b").applyInPandas(run, "__group string, s double, o bigint, i bigint, j bigint, state int")
        found = materialize(found.select("__group", F.struct("s", "o", "i", "j").alias("__rank"), "state"), "decided")
        stay = found.where("state = 1").select(*key)
        kept = stay if kept is None else kept.unionByName(stay)
        if found.where("state < 0").isEmpty():
            break
        # those that stayed go on, as their neighbours may have to know; those that dropped don't matter any more
        live = materialize(found.where("state < 0").unionByName(kept.withColumn("state", F.lit(1))), "live")
    return nodes.join(kept, key, "left_semi").select(*columns)


def detect_tiled(pixels: DataFrame, by: Sequence[str], height: int, n_tiles: int, overlap: int, sigma: float = 1.0, width: int = 21, threshold: float = 0.0, distance: float = 9.0) -> DataFrame:
    """Candidates of each band after its own suppression; only those in the band's core stay."""
    cut = bands(pixels, height, n_tiles, overlap)
    size = max(1, height // n_tiles)
    found = suppress(log_candidates(cut, [*by, "tile"], sigma, width, threshold), [*by, "tile"], distance)
    own = F.least(F.floor(F.col("i") / size), F.lit(n_tiles - 1))
    return found.where(F.col("tile") == own)


def _disk(outer: int) -> list[tuple[int, int, float]]:
    return [(a, b, math.hypot(a, b)) for a in range(-outer, outer + 1) for b in range(-outer, outer + 1) if math.hypot(a, b) <= outer]


def local_snr(candidates: DataFrame, pixels: DataFrame, by: Sequence[str], core: int = 1, inner: int = 3, outer: int = 5, channel: Sequence[str] = ()) -> DataFrame:
    """(by, i, j, channel, snr): the largest value of the core over the median of the ring, in each channel of the image; infinite over a dark ring, 0 without signal.

    Tiles with a halo of the ring; a pixel goes out once and not once for each candidate around it.
    """
    disk = _disk(outer)
    middle, around = ([(a + outer, b + outer) for a, b, d in disk if keep(d)] for keep in (lambda d: d <= core, lambda d: d > inner))

    def kernel(image: np.ndarray, part: pd.DataFrame) -> pd.DataFrame:
        spot = part["spot"].to_numpy(bool)
        i, j, v = part["i"].to_numpy() - part["i"].min(), part["j"].to_numpy() - part["j"].min(), part["v"].to_numpy(float)
        values, there = np.full([n + 2 * outer for n in image.shape], np.nan), np.zeros([n + 2 * outer for n in image.shape], bool)
        values[i[~spot] + outer, j[~spot] + outer], there[i[~spot] + outer, j[~spot] + outer] = v[~spot], True
        i, j = i[spot], j[spot]
        snr, seen = np.zeros(len(i)), np.zeros(len(i), bool)
        for n in range(0, len(i), 16_384):
            a, b = i[n : n + 16_384], j[n : n + 16_384]
            at = lambda table, steps, a=a, b=b: np.stack([table[a + x, b + y] for x, y in steps], 1)
            ring = np.sort(at(values, around), 1)  # absent pixels are last
            m = (~np.isnan(ring)).sum(1)
            row = np.arange(len(a))
            ring = np.where(m > 0, (ring[row, np.maximum(m - 1, 0) // 2] + ring[row, np.minimum(m // 2, ring.shape[1] - 1)]) / 2, 0.0)
            signal = np.fmax.reduce(at(values, middle), 1)
            with np.errstate(divide="ignore", invalid="ignore"):
                snr[n : n + 16_384] = np.where(ring > 0, signal / ring, np.where(signal > 0, np.inf, 0.0))
            seen[n : n + 16_384] = at(there, [(x + outer, y + outer) for x, y, _ in disk]).any(1)
        return pd.DataFrame({"i": i[seen], "j": j[seen], "snr": snr[seen]})

    spots = candidates.select(*by, "i", "j").distinct()
    if channel:
        spots = spots.join(pixels.select(*by, *channel).distinct(), list(by))
    every = [*by, *channel]
    place = lambda df, v, spot: df.select(*every, F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), v.cast("double").alias("v"), F.lit(spot).alias("spot"))
    both = place(pixels, F.col("v"), False).unionByName(place(spots, F.lit(None), True))
    kinds = dict(candidates.dtypes)
    out = _per_tile(both, every, kernel, "i bigint, j bigint, snr double", outer, ["spot"])
    return out.select(*by, *[F.col(c).cast(kinds[c]).alias(c) for c in "ij"], *channel, "snr")


def binned(pixels: DataFrame, by: Sequence[str], bins: int = 256) -> DataFrame:
    """(by, v): values as the middles of so many equal bins between the least and the largest value of the image."""
    ends = pixels.groupBy(*by).agg(F.min("v").cast("double").alias("__lo"), F.max("v").cast("double").alias("__hi"))
    width = (F.col("__hi") - F.col("__lo")) / bins
    place = F.least(F.lit(bins - 1), F.floor(F.try_divide((F.col("v") - F.col("__lo")) * bins, F.col("__hi") - F.col("__lo"))))
    return joined(pixels.select(*by, "v"), ends, by).select(*by, F.coalesce(F.col("__lo") + (place + 0.5) * width, F.col("v").cast("double")).alias("v"))


def otsu(pixels: DataFrame, by: Sequence[str], bins: int | None = None) -> DataFrame:
    """(by, threshold): the value that parts the histogram with the largest variance between both sides, of equal ones the least.

    The histogram is of the values as they are, as for images of integers, or of so many bins, as for images of floats (256 there); then the threshold is the middle of a bin.
    """
    pixels = binned(pixels, by, bins) if bins else pixels
    hist = pixels.groupBy(*by, "v").agg(F.count(F.lit(1)).cast("double").alias("n"))
    upto = W.partitionBy(*by).orderBy("v").rowsBetween(W.unboundedPreceding, 0)
    every = W.partitionBy(*by)
    hist = hist.withColumns({"w1": F.sum("n").over(upto), "s1": F.sum(F.col("n") * F.col("v")).over(upto), "w": F.sum("n").over(every), "s": F.sum(F.col("n") * F.col("v")).over(every)}).where("w1 < w")
    gap = F.col("s1") / F.col("w1") - (F.col("s") - F.col("s1")) / (F.col("w") - F.col("w1"))
    spread = F.col("w1") * (F.col("w") - F.col("w1")) * gap * gap
    return hist.groupBy(*by).agg(F.max(F.struct(spread.alias("b"), (-F.col("v")).alias("t"))).alias("m")).select(*by, (-F.col("m.t")).cast("double").alias("threshold"))


def _roots(node: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least node of each pixel's 4-connected component: larger roots are hung below smaller ones, and paths are halved, until no edge is left between two."""
    at = {(a, b): n for n, (a, b) in enumerate(zip(i.tolist(), j.tolist(), strict=True))}
    edges = [(n, m) for (a, b), n in at.items() for m in (at.get((a + 1, b)), at.get((a, b + 1))) if m is not None]
    order = np.argsort(node, kind="stable")
    rank = np.empty(len(node), np.int64)
    rank[order] = np.arange(len(node))
    parent = np.arange(len(node))
    if edges:
        u, v = rank[np.array(edges).T]
        while True:
            a, b = parent[u], parent[v]
            differ = a != b
            if not differ.any():
                break
            u, v, a, b = u[differ], v[differ], a[differ], b[differ]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            while (parent != parent[parent]).any():
                parent = parent[parent]
    return node[order][parent[rank]]


def seam_edges(local: DataFrame, width: int, side: int) -> DataFrame:
    """(u, v): roots of two tiles that touch, from (node, i, j, root)."""
    edge = local.where((F.col("i") % side == 0) | (F.col("i") % side == side - 1) | (F.col("j") % side == 0) | (F.col("j") % side == side - 1)).select("node", "i", "j", "root")
    steps = F.array_compact(F.array(F.when((F.col("j") % side == side - 1) & (F.col("j") + 1 < width), F.col("node") + 1), F.when(F.col("i") % side == side - 1, F.col("node") + width)))
    across = edge.select(F.col("root").alias("u"), F.explode(steps).alias("node"))
    return across.join(edge.select("node", F.col("root").alias("v")), "node").select("u", "v").distinct()


def label_components(mask: DataFrame, by: Sequence[str], width: int, side: int = TILE) -> DataFrame:
    """(by, i, j, label): 4-connected components of the mask's pixels, labelled from 1 in each image by their first pixel.

    A kernel joins the pixels of a tile; only components of tiles that touch at a seam are edges of the graph.
    """
    # an image's number is its task's and its row there, packed, so that no task sees all images
    images = materialize(mask.select(*by).distinct().withColumn("__id", F.monotonically_increasing_id()), "images")
    task, row = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    tasks = images.agg(F.coalesce(F.max(task), F.lit(0)) + 1).first()[0]
    images = images.select(*by, (row * tasks + task).alias("__image"))
    node = F.col("__image") * (1 << 32) + F.col("i").cast("bigint") * width + F.col("j")
    pixels = mask.select(*by, "i", "j")
    pixels = (pixels.join(images, list(by)) if by else pixels.crossJoin(images)).select("__image", F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), node.alias("node"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        return part[["__image", "i", "j", "node"]].assign(root=_roots(part["node"].to_numpy(), part["i"].to_numpy(), part["j"].to_numpy()))

    tiles = pixels.withColumn("ti", F.floor(F.col("i") / side)).withColumn("tj", F.floor(F.col("j") / side)).groupBy("__image", "ti", "tj")
    local = materialize(tiles.applyInPandas(run, "__image bigint, i bigint, j bigint, node bigint, root bigint"), "mask")
    roots = components(seam_edges(local, width, side)).select(F.col("u").alias("root"), F.col("root").alias("top"))
    whole = materialize(local.join(roots, "root", "left").select("__image", "i", "j", F.coalesce("top", "root").alias("root")), "roots")
    numbers = dense_ranks(whole.select("__image", "root").distinct(), "root", "label", ["__image"])
    kinds = {c: t for c, t in mask.dtypes if c in "ij"}
    out = whole.join(numbers, ["__image", "root"])
    out = out.join(images, "__image") if by else out
    return out.select(*by, F.col("i").cast(kinds["i"]).alias("i"), F.col("j").cast(kinds["j"]).alias("j"), "label")


def keep_areas(labels: DataFrame, by: Sequence[str], least: int, most: int) -> DataFrame:
    """Components of so many pixels, labelled anew without gaps."""
    sizes = labels.groupBy(*by, "label").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n").between(least, most)).drop("__n")
    numbers = dense_ranks(sizes, "label", "__new", by)
    return labels.join(numbers, [*by, "label"]).select(*[F.col("__new").alias("label") if c == "label" else F.col(c) for c in labels.columns])


def segment(pixels: DataFrame, by: Sequence[str], width: int, least: int = 100, most: int = 5000, bins: int | None = None) -> DataFrame:
    """Foreground components above the image's Otsu threshold, within the areas."""
    bright = joined(pixels, otsu(pixels, by, bins), by).where("v > threshold")
    return keep_areas(label_components(bright, by, width), by, least, most)


def blobs(pixels: DataFrame, by: Sequence[str], width: int, percentile: float = 99.0, least: int = 4, most: int = 400) -> DataFrame:
    """(by, label, i, j, area): components above the percentile, at their value-weighted centre, rounded half to even."""
    cut = quantiles(pixels, by, "v", [percentile / 100]).select(*by, F.col("q0").alias("__t"))
    bright = joined(pixels, cut, by).where("v > __t").drop("__t")
    labels = label_components(bright, by, width).join(pixels, [*by, "i", "j"])
    centre = lambda c: F.bround(F.sum(F.col(c) * F.col("v")) / F.sum("v")).cast("bigint")
    out = labels.groupBy(*by, "label").agg(centre("i").alias("i"), centre("j").alias("j"), F.count(F.lit(1)).alias("area"))
    return out.where(F.col("area").between(least, most))


def nearest_labels(label: np.ndarray, distance: float) -> np.ndarray:
    """The nearest label (over 0) of each pixel within the distance, of equally near ones the least; 0 where there is none.

    Separable: the best of a column within reach depends on the vertical distance only, and the best of all on these and the horizontal one.
    """
    d, none = int(distance), np.int64(1) << 62
    best = np.where(label > 0, label.astype(np.int64), none)  # squared distance << 40 | label
    for axis in (0, 1):
        out = best.copy()
        for step in range(1, min(d, best.shape[axis] - 1) + 1):
            away = np.int64(step * step) << 40
            low, high = [slice(None)] * 2, [slice(None)] * 2
            low[axis], high[axis] = slice(None, -step), slice(step, None)
            for to, of in ((tuple(low), tuple(high)), (tuple(high), tuple(low))):
                out[to] = np.minimum(out[to], np.where(best[of] < none, best[of] + away, none))
        best = out
    return np.where((best < none) & (best >> 40 <= distance * distance), best & ((np.int64(1) << 40) - 1), 0)


def expand_labels(labels: DataFrame, background: DataFrame, by: Sequence[str], distance: float) -> DataFrame:
    """(by, i, j, label): labels, and background pixels within the distance with their nearest label, of equally near ones the least.

    Tiles with a halo of the distance; the work is linear in the pixels and in the distance.
    """

    def kernel(image: np.ndarray, part: pd.DataFrame) -> pd.DataFrame:
        found = nearest_labels(image, distance)
        own = part[part["free"]]
        i, j = own["i"].to_numpy() - int(part["i"].min()), own["j"].to_numpy() - int(part["j"].min())
        hit = found[i, j] > 0
        return pd.DataFrame({"i": i[hit], "j": j[hit], "label": found[i[hit], j[hit]]})

    place = lambda df, v, free: df.select(*by, F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), v.cast("double").alias("v"), F.lit(free).alias("free"))
    both = place(labels, F.col("label"), False).unionByName(place(background, F.lit(0), True))
    near = _per_tile(both, by, kernel, "i bigint, j bigint, label bigint", int(distance) + 1, ["free"])
    kinds = dict(labels.dtypes)
    return labels.select(*by, "i", "j", "label").unionByName(near.select(*by, *[F.col(c).cast(kinds[c]).alias(c) for c in ("i", "j", "label")]))


def spots_per_cell(labels: DataFrame, spots: DataFrame, by: Sequence[str], channels: Sequence[str]) -> DataFrame:
    """(by, label, <channel>_spot_count): spots of each channel inside each label, zeros included."""
    inside = spots.join(labels, [*by, "i", "j"]).groupBy(*by, "label").agg(*[F.count_if(F.col("channel") == c).alias(f"{c}_spot_count") for c in channels])
    return labels.select(*by, "label").distinct().join(inside, [*by, "label"], "left").fillna(0, [f"{c}_spot_count" for c in channels])


def assign_spots(spots: DataFrame, centroids: DataFrame, radius: float, group: str) -> DataFrame:
    """Spots with `cell`, the centroid nearest below the radius; null where there is none."""
    near = nearest_within(spots, centroids, radius, group=group, target_id="spot_id", ref_id="cell")
    return spots.join(near.select(F.col("target_id").alias("spot_id"), F.col("neighbor_id").alias("cell"), F.col("distance").alias("cell_distance")), "spot_id", "left")


def density_per_megapixel(n: Column, pixels: Column) -> Column:
    return F.try_divide(n.cast("double"), pixels.cast("double") / 1e6)
