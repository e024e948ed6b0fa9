"""Uptake, composition and enrichment tables over annotated cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import log2, percent, positive_subset, ratio, sem
from ..operators.relational import complete_grid, dimension, share, top_categories, top_one
from ..schemas import AVERAGE_BASIS, AVERAGE_FORMULATION, CALL_BASIS, LNP_ORDER, LNP_REGIONS, REFERENCE_REGIONS, TISSUE_AVERAGE, lnp_detail

def _n() -> Column:
    return F.count(F.lit(1))


def uptake_by_region(cells: DataFrame, order: Sequence[str] = LNP_ORDER, regions: Sequence[str] = LNP_REGIONS, reference: Sequence[str] = REFERENCE_REGIONS) -> DataFrame:
    """Positive cells of each call in each region, zeros included, and their share of the region's cells."""
    spark = cells.sparkSession
    cells = cells.where(F.col("lnp_region").isin([*regions, *reference]))
    totals = cells.groupBy("condition", "lnp_region").agg(_n().alias("n_cells_total"))
    counts = cells.where(positive_subset(order)).groupBy("condition", "lnp_region", "lnp_call").agg(_n().alias("n_lnp_positive"))
    grid = spark.createDataFrame([(c, r) for c, own in (("LNP", regions), ("reference", reference)) for r in own], "condition string, lnp_region string").crossJoin(dimension(spark, "lnp_call", order).select("lnp_call"))
    out = complete_grid(counts, ["condition", "lnp_region", "lnp_call"], grid, ["n_lnp_positive"]).join(totals, ["condition", "lnp_region"], "left")
    return out.withColumn("pct_cells_lnp_positive", percent("n_lnp_positive", "n_cells_total")).join(F.broadcast(lnp_detail(spark)), "lnp_call", "left")


def uptake_summary(by_region: DataFrame) -> DataFrame:
    """Means over regions, and pooled over cells, of each call."""
    out = by_region.groupBy("condition", "lnp_call").agg(
        F.countDistinct("lnp_region").alias("n_regions"),
        F.avg("pct_cells_lnp_positive").alias("mean_pct_cells_lnp_positive"),
        sem("pct_cells_lnp_positive").alias("sem_pct_cells_lnp_positive"),
        F.sum("n_lnp_positive").alias("total_positive_cells"),
        F.sum("n_cells_total").alias("total_cells"),
    )
    return out.withColumn("pooled_pct_cells_lnp_positive", percent("total_positive_cells", "total_cells")).join(F.broadcast(lnp_detail(by_region.sparkSession)), "lnp_call", "left")


def celltype_uptake(cells: DataFrame, order: Sequence[str] = LNP_ORDER) -> DataFrame:
    """Positive cells by region, type and call, and their share of the type's cells there; only what occurs."""
    cells = cells.where("condition = 'LNP'")
    totals = cells.groupBy("lnp_region", "cell_type").agg(_n().alias("n_cell_type_total"))
    counts = cells.where(positive_subset(order)).groupBy("lnp_region", "cell_type", "lnp_call").agg(_n().alias("n_lnp_positive"))
    return counts.join(totals, ["lnp_region", "cell_type"], "left").withColumn("pct_cell_type_lnp_positive", percent("n_lnp_positive", "n_cell_type_total"))


def celltype_uptake_summary(uptake: DataFrame) -> DataFrame:
    out = uptake.groupBy("cell_type", "lnp_call").agg(
        F.countDistinct("lnp_region").alias("n_regions"),
        F.avg("pct_cell_type_lnp_positive").alias("mean_pct_cell_type_lnp_positive"),
        sem("pct_cell_type_lnp_positive").alias("sem_pct_cell_type_lnp_positive"),
        F.sum("n_lnp_positive").alias("total_positive_cells"),
        F.median("pct_cell_type_lnp_positive").alias("median_region_pct"),
    )
    return out.join(F.broadcast(lnp_detail(uptake.sparkSession)), "lnp_call", "left")


def top_celltypes(summary: DataFrame, n: int = 12) -> DataFrame:
    return top_categories(summary, "cell_type", "total_positive_cells", n)


def positive_composition(cells: DataFrame, order: Sequence[str] = LNP_ORDER, n_types: int = 10, average: str = TISSUE_AVERAGE) -> DataFrame:
    """What types each call's positive cells are, with a row of all cells; totals are over the types that are kept."""
    spark = cells.sparkSession
    cells = cells.where("condition = 'LNP'")
    counts = cells.where(positive_subset(order)).groupBy("lnp_call", "cell_type").agg(_n().alias("n_lnp_positive"))
    types = top_categories(counts, "cell_type", "n_lnp_positive", n_types)
    every = cells.groupBy("cell_type").agg(_n().alias("n_lnp_positive")).withColumn("lnp_call", F.lit(average))
    grid = dimension(spark, "lnp_call", [*order, average]).select("lnp_call").crossJoin(types)
    out = complete_grid(counts.unionByName(every), ["lnp_call", "cell_type"], grid, ["n_lnp_positive"])
    out = share(out, "n_lnp_positive", ["lnp_call"], "pct_of_lnp_positive_cells", "n_lnp_positive_total").join(F.broadcast(lnp_detail(spark)), "lnp_call", "left")
    is_average = F.col("lnp_call") == average
    basis = F.when(is_average, AVERAGE_BASIS).otherwise(CALL_BASIS)
    return out.withColumn("composition_basis", basis).withColumn("formulation", F.when(is_average, AVERAGE_FORMULATION).otherwise(F.col("formulation")))


def relative_enrichment(cells: DataFrame, order: Sequence[str] = LNP_ORDER) -> DataFrame:
    """Each type's share of a call's positive cells against its share of all cells, and against the type's best call."""
    spark = cells.sparkSession
    cells = cells.where("condition = 'LNP'")
    background = share(cells.groupBy("cell_type").agg(_n().alias("n_cells_background")), "n_cells_background", [], "__pct")
    background = background.select("cell_type", "n_cells_background", (F.col("__pct") / 100).alias("background_fraction"))
    counts = cells.where(positive_subset(order)).groupBy("lnp_call", "cell_type").agg(_n().alias("n_lnp_positive"))
    grid = dimension(spark, "lnp_call", order).select("lnp_call").crossJoin(background)
    out = complete_grid(counts, ["lnp_call", "cell_type"], grid, ["n_lnp_positive"])
    out = out.withColumn("n_lnp_positive_total", F.sum("n_lnp_positive").over(W.partitionBy("lnp_call")))
    out = out.withColumn("positive_fraction_within_lnp", ratio("n_lnp_positive", "n_lnp_positive_total"))
    out = out.withColumn("enrichment_vs_background", ratio("positive_fraction_within_lnp", "background_fraction"))
    out = out.withColumn("log2_enrichment_vs_background", log2("enrichment_vs_background"))
    out = out.withColumn("max_enrichment_for_cell_type", F.max("enrichment_vs_background").over(W.partitionBy("cell_type")))
    out = out.withColumn("relative_enrichment_within_cell_type", ratio("enrichment_vs_background", "max_enrichment_for_cell_type"))
    return out.join(F.broadcast(lnp_detail(spark)), "lnp_call", "left")


def best_call_by_type(enrichment: DataFrame) -> DataFrame:
    """The most enriched call of each type; equal ones by call."""
    keep = ["cell_type", "lnp_call", "formulation", "helper_lipid", "ionizable_lipid", "n_lnp_positive", "positive_fraction_within_lnp", "background_fraction", "enrichment_vs_background", "log2_enrichment_vs_background"]
    return top_one(enrichment, ["cell_type"], F.desc_nulls_last("enrichment_vs_background"), F.asc("lnp_call")).select(*keep)


def region_qc(cells: DataFrame) -> DataFrame:
    out = cells.groupBy("condition", "lnp_region").agg(_n().alias("n_cells"), F.count_if("lnp_positive").alias("n_any_lnp_positive"))
    return out.withColumn("pct_any_lnp_positive", percent("n_any_lnp_positive", "n_cells"))


def call_qc(cells: DataFrame) -> DataFrame:
    out = cells.groupBy("condition", "lnp_call").agg(_n().alias("n_cells"), F.count_if("lnp_positive").alias("n_positive"))
    return out.join(F.broadcast(lnp_detail(cells.sparkSession)), "lnp_call", "left")


def type_enrichment(cells: DataFrame, min_percent: float = 5.0, other: str = "Other") -> DataFrame:
    """Share of each type in positive and in all cells; types below `min_percent` in both are pooled."""
    both = cells.select("cell_type", F.explode(F.array_compact(F.array(F.lit("all"), F.when(F.col("lnp_positive"), F.lit("positive"))))).alias("group"))
    raw = share(both.groupBy("group", "cell_type").agg(_n().alias("n_cells")), "n_cells", ["group"], "percent")
    raw = raw.withColumn("shown", F.max("percent").over(W.partitionBy("cell_type")) >= min_percent)
    pooled = raw.groupBy("group", F.when(F.col("shown"), F.col("cell_type")).otherwise(other).alias("cell_type")).agg(F.sum("n_cells").alias("n_cells"))
    pooled = share(pooled, "n_cells", ["group"], "percent")
    wide = pooled.groupBy("cell_type").pivot("group", ["positive", "all"]).agg(F.first("n_cells").alias("n"), F.first("percent").alias("p"))
    wide = wide.select("cell_type", F.col("positive_n").alias("n_cells_lnppositive_cells"), F.col("all_n").alias("n_cells_all_cells"), F.col("positive_p").alias("percent_lnppositive_cells"), F.col("all_p").alias("percent_all_cells"))
    wide = wide.withColumn("representation_ratio", ratio("percent_lnppositive_cells", "percent_all_cells"))
    return wide.withColumn("log2_representation_ratio", log2("representation_ratio"))


def tile_summary(cells: DataFrame, tile: float = 150.0, min_cells: int = 10) -> tuple[DataFrame, DataFrame]:
    """(tiles, whole regions): percent positive by two strategies; tiles of few cells are left out of the first only."""
    strategies = F.explode(F.array(F.struct(F.lit("codebook").alias("strategy"), F.col("lnp_positive").alias("hit")), F.struct(F.lit("single_bit").alias("strategy"), F.col("single_positive").alias("hit")))).alias("s")
    rows = cells.dropna(subset=["x", "y", "lnp_region"]).select("lnp_region", F.floor(F.col("x") / tile).alias("tile_x"), F.floor(F.col("y") / tile).alias("tile_y"), strategies).select("lnp_region", "tile_x", "tile_y", "s.*")
    tiles = rows.groupBy("strategy", "lnp_region", "tile_x", "tile_y").agg(_n().alias("n_cells"), F.count_if("hit").alias("n_positive"))
    whole = tiles.groupBy("strategy", "lnp_region").agg(F.sum("n_cells").alias("n_cells"), F.sum("n_positive").alias("n_positive"))
    return tuple(t.withColumn("percent_positive", percent("n_positive", "n_cells")) for t in (tiles.where(F.col("n_cells") >= min_cells), whole))


def assemble(calls: DataFrame, annotations: DataFrame, rename: dict[str, str] | None = None) -> DataFrame:
    """Calls with the annotation of their cell, one to one at most; cells without get Unknown."""
    out = calls.join(annotations, ["lnp_region", "cell_id"], "left")
    kind = F.coalesce(F.col("cell_type"), F.lit("Unknown"))
    for old, new in (rename or {}).items():
        kind = F.when(kind == old, new).otherwise(kind)
    return out.withColumn("cell_type", kind)


def overlay_counts(cells: DataFrame, lineage: str, order: Sequence[str] = LNP_ORDER) -> DataFrame:
    """Cells by region, lineage and label: the call and `+` for positive ones, Other for the rest."""
    label = F.when(positive_subset(order), F.concat(F.col("lnp_call"), F.lit("+ "), F.col(lineage))).otherwise(F.concat(F.lit("Other "), F.col(lineage)))
    return cells.where(F.col(lineage).isNotNull()).groupBy("lnp_region", F.col(lineage).alias("cell_class"), label.alias("label")).agg(_n().alias("n_cells"))
