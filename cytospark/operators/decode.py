"""Barcodes of spots and cells: bits from channel ratios, codebook matches, consensus calls and threshold choices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import LNP_ORDER, Codebook

# Channels and codes of the single-word and the ten-word codebooks.
MARKERS_12 = ("A6", "A17", "A55", "A56", "A76", "A79", "A20", "A46", "A28", "A72", "A2", "A63")
MARKERS_15 = (*MARKERS_12, "A126", "A127", "A128")
CODES = ("101001100011", "100110100011", "101010001011", "000101101110", "011010100101", "010000110111", "011110010100", "111101010000", "010100011011", "011011000110")

FULL_BARCODE = Codebook(MARKERS_12, (("100110100011", "LNP_A"),), 6, 4)
SINGLE_BIT = Codebook(("A20",), (("1", "LNP_A"),), 1, 0)
ROUND_1 = Codebook(MARKERS_12, tuple(zip(CODES, LNP_ORDER, strict=True)), 6, 2)
ROUND_2 = Codebook(MARKERS_15, tuple((c + "000", n) for c, n in zip(CODES, LNP_ORDER, strict=True)), 6, 2)


def bits(code: Column) -> Column:
    """A code of up to 63 bits as an integer."""
    return F.conv(code, 2, 10).cast("bigint")


def match(code: Column, book: Codebook) -> Column:
    """Struct (distance, ordinal, call) of the closest code; of equally close ones the first of the library. Libraries are short constants."""
    if not book.calls:
        return F.struct(F.lit(len(book.markers)).alias("distance"), F.lit(0).alias("ordinal"), F.lit(None).cast("string").alias("call"))
    value = bits(code)
    entries = [F.struct(F.bit_count(value.bitwiseXOR(F.lit(int(c, 2)))).cast("int").alias("distance"), F.lit(i).alias("ordinal"), F.lit(call).alias("call")) for i, (c, call) in enumerate(book.calls)]
    return F.array_min(F.array(*entries))


def decode(spots: DataFrame, book: Codebook, min_on: float = 1.2, min_margin: float = 0.05, bright: float = 1.75, max_bright: int | None = None, snr: str = "snr") -> DataFrame:
    """Bits of each spot from its ratios by channel (an array in marker order), the match, quality and acceptance."""
    ranked = F.array_sort(F.transform(snr, lambda x, i: F.struct((-x).alias("down"), i.alias("i"))))
    out = spots.withColumn("__r", ranked).withColumn("__on", F.transform(F.slice("__r", 1, book.on_bits), lambda s: s["i"]))
    out = out.withColumn("called_code", F.array_join(F.transform(snr, lambda x, i: F.when(F.array_contains("__on", i), "1").otherwise("0")), ""))
    off = F.get("__r", F.lit(book.on_bits))["down"]
    out = out.withColumn("min_on_snr", F.coalesce(-F.get("__r", F.least(F.size("__r"), F.lit(book.on_bits)) - 1)["down"], F.lit(0.0)))
    out = out.withColumn("snr_margin", F.col("min_on_snr") - F.coalesce(-off, F.lit(0.0)))
    n_bright = F.size(F.filter(snr, lambda x: x >= bright))
    out = out.withColumn("promiscuous", n_bright > (len(book.markers) if max_bright is None else max_bright)).withColumn("__m", match(F.col("called_code"), book))
    status = F.when(F.col("__m.distance") == 0, "exact").when(F.col("__m.distance") <= book.tolerance, "tolerant").otherwise("unmapped")
    mapped = status != "unmapped"
    return out.select(
        *spots.columns,
        "called_code",
        F.when(mapped, F.col("__m.call")).alias("matched_barcode"),
        F.when(mapped, F.col("__m.call")).otherwise("no_barcode").alias("lnp_call"),
        F.col("__m.distance").alias("barcode_match_distance"),
        status.alias("barcode_match_status"),
        "min_on_snr",
        "snr_margin",
        "promiscuous",
        ((F.col("min_on_snr") >= min_on) & (F.col("snr_margin") >= min_margin) & ~F.col("promiscuous") & mapped).alias("accepted"),
    )


def bit_counts(spots: DataFrame, book: Codebook, cell: str = "cell") -> DataFrame:
    """Spots of each cell by marker that is on, those that decode, and all; spots without cell don't count."""
    columns = [F.count_if(F.substring("called_code", i + 1, 1) == "1").alias(f"bit_{m}") for i, m in enumerate(book.markers)]
    return spots.where(F.col(cell).isNotNull()).groupBy(cell).agg(*columns, F.count_if(F.col("barcode_match_status") != "unmapped").alias("decoded_spots"), F.count(F.lit(1)).alias("total_spots"))


def cell_calls(features: DataFrame, counts: DataFrame, book: Codebook, cell: str = "cell") -> DataFrame:
    """Each cell's consensus: a bit is on if any spot has it; the closest code within the tolerance is the call."""
    names = [f"bit_{m}" for m in book.markers]
    out = features.join(counts, cell, "left").fillna(0, names)
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    out = out.withColumn("total_barcode_spots", total).withColumn("barcode", F.concat(*[F.when(F.col(n) >= 1, "1").otherwise("0") for n in names]))
    out = out.withColumn("__m", match(F.col("barcode"), book))
    status = F.when(F.col("total_barcode_spots") == 0, "no_barcode").when(F.col("__m.distance") == 0, "exact").when(F.col("__m.distance") <= book.tolerance, "tolerant").otherwise("ambiguous_mixed")
    out = out.withColumn("barcode_match_status", status).withColumn("barcode_match_distance", F.col("__m.distance"))
    out = out.withColumn("lnp_positive", F.col("barcode_match_status").isin("exact", "tolerant"))
    return out.withColumn("lnp_call", F.when(F.col("lnp_positive"), F.col("__m.call")).otherwise("no_barcode")).drop("__m")


def two_barcode_class(first: str, second: str, least: int = 1) -> Column:
    a, b = F.col(first) >= least, F.col(second) >= least
    return F.when(a & b, "both_barcodes").when(a, "barcode1_only").when(b, "barcode2_only").otherwise("no_barcode")


def threshold_table(hits: DataFrame, thresholds: Sequence[float], value: str, megapixels: tuple[float, float], strict: bool, max_negative: float = 3.0, min_positive: float = 0.5, bonus: float = 1000.0, by: Sequence[str] = (), every: DataFrame | None = None) -> DataFrame:
    """For each threshold the density of hits in the negative and the positive field, their ratio and a score, from (by, field, value).

    An infinite ratio counts as zero in the score; thresholds that keep both bounds get the bonus. Groups of `every` that have no hit have rows, too. A field without pixels has no hits.
    """
    steps = sorted({float(t) for t in thresholds})
    # a hit passes the first so many thresholds; hits are counted by that number, and a threshold has the hits of its number and of larger ones
    passed = F.size(F.filter(F.array(*[F.lit(t) for t in steps]), lambda t: F.col(value) > t if strict else F.col(value) >= t))
    sides = [F.count_if(F.col("field") == f).alias(n) for f, n in (("negative", "n"), ("positive", "p"))]
    counts = hits.where(F.col(value).isNotNull()).groupBy(*by, passed.alias("passed")).agg(*sides)
    none = hits.sparkSession.createDataFrame([(0, 0, 0)], "passed int, n bigint, p bigint")
    if not by:  # thresholds that no hit passes have a row, too
        counts = counts.unionByName(none)
    elif every is not None:
        counts = counts.unionByName(every.select(*by, F.lit(0).alias("passed"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("p")))
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), F.lit(i).alias("step")) for i, t in enumerate(steps)])).alias("g")
    over = lambda c: F.sum(F.when(F.col("passed") > F.col("step"), F.col(c)).otherwise(0)).alias(c)
    out = counts.select("*", each).select(*by, "g.*", "passed", "n", "p").groupBy(*by, "threshold", "step").agg(over("n"), over("p"))
    neg, pos = (F.coalesce(F.try_divide(F.col(c).cast("double"), F.lit(float(m))), F.lit(0.0)) for c, m in zip("np", megapixels, strict=True))
    out = out.select(*by, "threshold", neg.alias("neg_matches_per_mpx"), pos.alias("pos_matches_per_mpx"))
    rate = F.try_divide("pos_matches_per_mpx", "neg_matches_per_mpx")
    passes = (F.col("neg_matches_per_mpx") <= max_negative) & (F.col("pos_matches_per_mpx") >= min_positive)
    infinite = F.col("pos_matches_per_mpx") > 0
    return out.select("*", F.coalesce(rate, F.when(infinite, F.lit(float("inf"))).otherwise(0.0)).alias("enrichment"), passes.alias("passes_policy"), (F.coalesce(rate, F.lit(0.0)) + F.when(passes, bonus).otherwise(0.0)).alias("selection_score"))


def best_threshold(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, threshold): the highest score, of equal ones the lowest threshold."""
    return table.groupBy(*by).agg(F.max(F.struct("selection_score", (-F.col("threshold")).alias("t"))).alias("b")).select(*by, (-F.col("b.t")).alias("threshold"))
