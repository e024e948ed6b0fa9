"""Spots and cell calls of whole image families, from pixel tables with a marker column (by, marker, i, j, v).

Two kinds of families: *calibrated* ones choose a threshold for each marker, and then one for decoding, so that spots are dense in positive fields and rare in negative ones; *fixed* ones have given
thresholds, are cut into bands, and add bright points and blobs of the channels' maximum to what the filter finds. Images of any size come as tiles (see `imaging`); what goes to the driver is a threshold for each marker.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import decode as D
from ..operators import imaging as I
from ..schemas import Codebook
from ..sources.scratch import materialize


class Family(NamedTuple):
    """How a family's images are searched and decoded; the defaults are those of the calibrated ones."""

    book: Codebook
    sigma: float = 1.0
    width: int = 21
    distance: float = 9.0
    min_margin: float = 0.05
    bright: float = 1.75
    max_bright: int | None = None
    radius: float = 25.0
    max_negative: float = 3.0
    min_positive: float = 0.5
    thresholds: tuple[float, ...] = (50.0, 100.0, 200.0, 300.0, 500.0)
    min_on: tuple[float, ...] = (0.8, 1.0, 1.2, 1.5, 2.0)
    # of fixed families: the threshold of markers that have none of their own, those that have, and bands with their halo
    threshold: float = 0.0
    own: tuple[tuple[str, float], ...] = ()
    n_tiles: int = 10
    overlap: int = 128
    point_percentile: float = 98.0
    blob_percentile: float = 99.0
    areas: tuple[int, int] = (4, 400)


# The parameters of the four families.
FULL_BARCODE = Family(D.FULL_BARCODE, max_bright=9)
SINGLE_BIT = Family(D.SINGLE_BIT, radius=20.0, max_negative=5.0)
ROUND_1 = Family(D.ROUND_1, sigma=2.0, width=3, distance=0.8, min_margin=0.1, max_bright=12, min_on=(1.2,), threshold=2.5)
ROUND_2 = Family(D.ROUND_2, sigma=2.0, width=3, distance=0.8, min_margin=0.02, max_bright=10, min_on=(0.8,), threshold=1.8, own=(("A6", 1.6), ("A17", 0.8), ("A72", 1.3), ("A63", 1.3), ("A55", 2.0), ("A76", 3.0), ("A79", 3.0), ("A20", 2.8)))


def _of_book(pixels: DataFrame, marker: str, book: Codebook) -> DataFrame:
    return pixels.where(F.col(marker).isin(list(book.markers)))


def _ordinal(marker: str, book: Codebook) -> Column:
    return F.array_position(F.lit(list(book.markers)), F.col(marker)).cast("int") - 1


def _above(found: DataFrame, marker: str, thresholds: dict[str, float]) -> DataFrame:
    """Those over their marker's threshold; local maxima don't depend on it."""
    limit = F.create_map(*[F.lit(x) for kv in thresholds.items() for x in kv])
    return found.where(F.col("score") > limit[F.col(marker)])


def megapixels(pixels: DataFrame, field: str, marker: str) -> tuple[float, float]:
    """Millions of pixels of one marker in the negative and in the positive fields."""
    n = {r[0]: r[1] for r in pixels.groupBy(field, marker).count().groupBy(field).agg(F.max("count")).collect()}
    return n.get("negative", 0) / 1e6, n.get("positive", 0) / 1e6


def marker_calibration(pixels: DataFrame, by: Sequence[str], marker: str, field: str, family: Family) -> DataFrame:
    """(marker, threshold, densities, enrichment, passes_policy, selection_score) of each marker and threshold; `field` is negative or positive, and fields of neither are passed over."""
    px = _of_book(pixels, marker, family.book).where(F.col(field).isin("negative", "positive"))
    found = I.log_candidates(px, [*by, field, marker], family.sigma, family.width, min(family.thresholds))
    every = pixels.sparkSession.createDataFrame([(m,) for m in family.book.markers], f"`{marker}` string")
    hits = found.select(marker, F.col(field).alias("field"), "score")
    return D.threshold_table(hits, family.thresholds, "score", megapixels(px, field, marker), True, family.max_negative, family.min_positive, by=[marker], every=every)


def candidates(pixels: DataFrame, by: Sequence[str], marker: str, family: Family, thresholds: dict[str, float]) -> DataFrame:
    """(by, marker, ordinal, i, j, score): local maxima of all markers after one suppression."""
    found = I.log_candidates(_of_book(pixels, marker, family.book), [*by, marker], family.sigma, family.width, min(thresholds.values()))
    found = _above(found, marker, thresholds).withColumn("ordinal", _ordinal(marker, family.book))
    return I.suppress(found, by, family.distance, "ordinal")


def rescued(pixels: DataFrame, by: Sequence[str], family: Family, image_width: int) -> DataFrame:
    """(by, i, j, score, seed): bright points and blobs of values (by, i, j, v), by percentiles of the values of each of `by`."""
    points = I.bright_points(pixels, by, family.point_percentile, 3).withColumn("seed", F.lit("rescue_bright"))
    blobs = I.blobs(pixels, by, image_width, family.blob_percentile, *family.areas)
    objects = blobs.select(*by, "i", "j").join(pixels.select(*by, F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), F.col("v").cast("double").alias("score")), [*by, "i", "j"])
    return points.unionByName(objects.withColumn("seed", F.lit("rescue_object")))


def tiled_candidates(pixels: DataFrame, by: Sequence[str], marker: str, family: Family, height: int, image_width: int) -> DataFrame:
    """(by, tile, i, j, score, seed) of all bands: the filter's candidates after their suppression, then with points and blobs after another; of each band, what its core has."""
    px, here = _of_book(pixels, marker, family.book), [*by, "tile"]
    own = dict(family.own)
    thresholds = {m: own.get(m, family.threshold) for m in family.book.markers}
    cut = materialize(I.bands(px, height, family.n_tiles, family.overlap), "bands")
    found = I.log_candidates(cut, [*here, marker], family.sigma, family.width, min(thresholds.values()))
    found = I.suppress(_above(found, marker, thresholds).withColumn("ordinal", _ordinal(marker, family.book)), here, family.distance, "ordinal")
    top = materialize(cut.groupBy(*here, "i", "j").agg(F.max("v").cast("double").alias("v")), "top")
    last = len(family.book.markers)
    more = rescued(top, here, family, image_width).withColumn("ordinal", F.when(F.col("seed") == "rescue_bright", last).otherwise(last + 1))
    found = found.withColumnRenamed(marker, "seed").select(*here, "i", "j", "score", "seed", "ordinal")
    found = I.suppress(found.unionByName(more.select(*found.columns)), here, family.distance, "ordinal")
    size = max(1, height // family.n_tiles)
    return found.where(F.col("tile") == F.least(F.floor(F.col("i") / size), F.lit(family.n_tiles - 1))).drop("ordinal")


def ratios(spots: DataFrame, pixels: DataFrame, by: Sequence[str], marker: str, book: Codebook) -> DataFrame:
    """(by, i, j, snr) of distinct places: the ratios of all markers in the book's order."""
    each = I.local_snr(spots, _of_book(pixels, marker, book), by, channel=[marker]).withColumn("n", _ordinal(marker, book))
    arrays = each.groupBy(*by, "i", "j").agg(F.array_sort(F.collect_list(F.struct("n", "snr"))).alias("s"))
    return arrays.select(*by, "i", "j", F.transform("s", lambda s: s["snr"]).alias("snr"))


def decode_calibration(decoded: DataFrame, family: Family, areas: tuple[float, float]) -> DataFrame:
    """The table of thresholds for the weakest bit, from decoded spots with `field`."""
    hits = decoded.where("barcode_match_status <> 'unmapped'").select("field", "min_on_snr")
    return D.threshold_table(hits, family.min_on, "min_on_snr", areas, False, family.max_negative, family.min_positive)


def cells_of(spots: DataFrame, centroids: DataFrame, by: Sequence[str], family: Family, min_on: float) -> tuple[DataFrame, DataFrame]:
    """(accepted spots with cell, cell calls) of spots with their ratios; centroids are (cell, field, x, y), where field joins `by` with bars."""
    decoded = D.decode(spots, family.book, min_on=min_on, min_margin=family.min_margin, bright=family.bright, max_bright=family.max_bright)
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in by])
    placed = decoded.where("accepted").withColumns({"x": F.col("j").cast("double"), "y": F.col("i").cast("double"), "field": key}).withColumn("spot_id", F.concat_ws("|", "field", "i", "j"))
    assigned = I.assign_spots(placed, centroids, family.radius, "field")
    return assigned, D.cell_calls(centroids, D.bit_counts(assigned, family.book), family.book)


def calibrated_family(pixels: DataFrame, centroids: DataFrame, by: Sequence[str], marker: str, field: str, family: Family) -> dict[str, DataFrame]:
    """`markers` and `decoding`, the tables of both calibrations, `spots` and `cells`; `field` says which images are negative and positive, all are searched."""
    book = family.book
    table = materialize(marker_calibration(pixels, by, marker, field, family), "calibration")
    thresholds = {r[0]: r[1] for r in D.best_threshold(table, [marker]).collect()}
    spots = materialize(ratios(candidates(pixels, by, marker, family, thresholds), pixels, by, marker, book), "spots")
    fields = pixels.select(*by, F.col(field).alias("field")).where(F.col("field").isin("negative", "positive")).distinct()
    decoded = D.decode(spots.join(fields, list(by)), book, min_on=0.0, min_margin=-1e9)
    decoding = materialize(decode_calibration(decoded, family, megapixels(_of_book(pixels, marker, book), field, marker)), "calibration")
    assigned, cells = cells_of(spots, centroids, by, family, D.best_threshold(decoding).first()[0])
    return {"markers": table, "decoding": decoding, "spots": assigned, "cells": cells}


def fixed_family(pixels: DataFrame, centroids: DataFrame, by: Sequence[str], marker: str, family: Family, height: int, image_width: int) -> dict[str, DataFrame]:
    """`candidates`, `spots` and `cells` by given thresholds, in bands, with rescue."""
    found = materialize(tiled_candidates(pixels, by, marker, family, height, image_width), "candidates")
    spots = ratios(found, pixels, by, marker, family.book)
    assigned, cells = cells_of(spots, centroids, by, family, family.min_on[0])
    return {"candidates": found, "spots": assigned, "cells": cells}
