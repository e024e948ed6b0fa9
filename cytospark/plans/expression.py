"""Gene expression gates and what follows from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import percent, positive_subset, sem
from ..functions.order import joined, medians
from ..operators.relational import complete_grid, dimension, share
from ..schemas import LNP_ORDER, NO_SIGNAL, SELECTED_TYPES, lnp_detail
from ..sources.cells import gates, with_gates

GENES = {"Luc": "Fluc", "OVA": "OVA"}


def _n() -> Column:
    return F.count(F.lit(1))


def gate_genes(cells: DataFrame, q: float = 0.95) -> DataFrame:
    """Cells with Luc_positive, OVA_positive and both."""
    out = with_gates(cells, gates(cells, GENES, q), GENES)
    return out.withColumn("Luc_OVA_double_positive", F.col("Luc_positive") & F.col("OVA_positive"))


def summarize(cells: DataFrame, by: Sequence[str], population: str) -> DataFrame:
    """Counts, means, medians and percentages of a group."""
    out = cells.groupBy(*by).agg(
        _n().alias("n_cells"),
        F.count_if("lnp_positive").alias("n_lnp_positive"),
        F.count_if("Luc_positive").alias("n_luc_positive"),
        F.count_if("OVA_positive").alias("n_ova_positive"),
        F.count_if("Luc_OVA_double_positive").alias("n_luc_ova_double_positive"),
        F.avg("Fluc").alias("mean_luc"),
        F.avg("OVA").alias("mean_ova"),
    )
    out = joined(out, medians(cells, by, {"median_luc": F.col("Fluc"), "median_ova": F.col("OVA")}), by)
    return out.withColumns({"analysis_population": F.lit(population), **{f"pct_{m}": percent(f"n_{m}", "n_cells") for m in ("luc_positive", "ova_positive", "luc_ova_double_positive")}})


def region_summary(gated: DataFrame, order: Sequence[str] = LNP_ORDER) -> DataFrame:
    """All cells, and positive cells, by region and call."""
    by = ["condition", "lnp_region", "lnp_call"]
    return summarize(gated, by, "all_cells").unionByName(summarize(gated.where(positive_subset(order)), by, "lnp_positive_cells"))


def positive_summary(regions: DataFrame) -> DataFrame:
    """Means over the treated regions of the positive cells' percentages."""
    rows = regions.where("analysis_population = 'lnp_positive_cells' AND condition = 'LNP'")
    means = [f(f"pct_{m}").alias(f"{a}_pct_{m}") for m in ("luc_positive", "ova_positive", "luc_ova_double_positive") for a, f in (("mean", F.avg), ("sem", sem))]
    out = rows.groupBy("lnp_call").agg(F.countDistinct("lnp_region").alias("n_regions"), *means, F.sum("n_cells").alias("total_lnp_positive_cells"), F.sum("n_luc_positive").alias("total_luc_positive"), F.sum("n_ova_positive").alias("total_ova_positive"))
    return out.join(F.broadcast(lnp_detail(regions.sparkSession)), "lnp_call", "left")


def _marked(gated: DataFrame, order: Sequence[str]) -> DataFrame:
    """A row for each treated cell and each gene that it is positive for, with the call or `no_lnp_signal`."""
    label = F.when(positive_subset(order), F.col("lnp_call")).otherwise(NO_SIGNAL)
    genes = F.explode(F.array_compact(F.array(*[F.when(F.col(f"{m}_positive"), F.lit(m)) for m in GENES]))).alias("marker")
    return gated.where("condition = 'LNP'").select("cell_id", "cell_type", label.alias("lnp_label"), genes)


def label_composition(gated: DataFrame, order: Sequence[str] = LNP_ORDER) -> DataFrame:
    """Which calls the cells of each gene have, zeros included."""
    spark = gated.sparkSession
    counts = _marked(gated, order).groupBy("marker", "lnp_label").agg(_n().alias("n_positive_cells"))
    grid = dimension(spark, "marker", GENES).select("marker").crossJoin(dimension(spark, "lnp_label", [*order, NO_SIGNAL]).select("lnp_label"))
    return share(complete_grid(counts, ["marker", "lnp_label"], grid, ["n_positive_cells"]), "n_positive_cells", ["marker"], "pct_of_marker_positive_cells")


def label_summary(composition: DataFrame) -> DataFrame:
    labelled = F.when(F.col("lnp_label") != NO_SIGNAL, F.col("n_positive_cells")).otherwise(0)
    out = composition.groupBy("marker").agg(F.sum("n_positive_cells").alias("n_positive_cells"), F.sum(labelled).alias("n_lnp_labeled"))
    return out.withColumn("pct_lnp_labeled", percent("n_lnp_labeled", "n_positive_cells")).withColumn("n_no_lnp_signal", F.col("n_positive_cells") - F.col("n_lnp_labeled"))


def type_composition(gated: DataFrame, order: Sequence[str] = LNP_ORDER) -> DataFrame:
    counts = _marked(gated, order).groupBy("marker", "cell_type").agg(_n().alias("n_positive_cells"))
    return share(counts, "n_positive_cells", ["marker"], "pct_positive_cells", "total_positive_cells")


def type_label_composition(gated: DataFrame, order: Sequence[str] = LNP_ORDER, types: Sequence[str] = SELECTED_TYPES) -> DataFrame:
    """Calls within each selected type that occurs, by gene, zeros included."""
    spark = gated.sparkSession
    marked = _marked(gated, order)
    present = dimension(spark, "cell_type", types).select("cell_type").join(gated.where("condition = 'LNP'").select("cell_type").distinct(), "cell_type", "left_semi")
    counts = marked.groupBy("marker", "cell_type", "lnp_label").agg(_n().alias("n_positive_cells"))
    grid = dimension(spark, "marker", GENES).select("marker").crossJoin(present).crossJoin(dimension(spark, "lnp_label", [*order, NO_SIGNAL]).select("lnp_label"))
    out = complete_grid(counts, ["marker", "cell_type", "lnp_label"], grid, ["n_positive_cells"])
    return share(out, "n_positive_cells", ["marker", "cell_type"], "pct_positive_cells_in_cell_type", "total_positive_cells_in_cell_type")


def gate_peptide(gated: DataFrame, column: str = "SIINFEKL", q: float = 0.9) -> DataFrame:
    return with_gates(gated, gates(gated, {"SIINFEKL": column}, q), {"SIINFEKL": column})


def dc_by_region(gated: DataFrame, order: Sequence[str] = LNP_ORDER, column: str = "SIINFEKL", costimulus: str = "CD86") -> DataFrame:
    """Positive dendritic cells by region and call: peptide and gene gates, expression, and the costimulus of gated cells."""
    cells = gated.where("condition = 'LNP'").where(positive_subset(order, "DC"))
    inside = F.when(F.col("SIINFEKL_positive"), F.col(costimulus))
    out = cells.groupBy("lnp_region", "lnp_call").agg(
        _n().alias("n_lnp_positive_dc"),
        F.count_if("SIINFEKL_positive").alias("n_siinfekl_positive"),
        F.count_if("OVA_positive").alias("n_ova_positive"),
        F.avg(column).alias("mean_siinfekl_expression"),
        F.avg(inside).alias("mean_cd86_in_siinfekl_positive"),
    )
    by = ["lnp_region", "lnp_call"]
    out = joined(out, medians(cells, by, {"median_siinfekl_expression": F.col(column), "median_cd86_in_siinfekl_positive": inside}), by)
    out = out.withColumns({"pct_siinfekl_positive": percent("n_siinfekl_positive", "n_lnp_positive_dc"), "pct_ova_positive": percent("n_ova_positive", "n_lnp_positive_dc")})
    return out.withColumn("siinfekl_minus_ova_pct_points", F.col("pct_siinfekl_positive") - F.col("pct_ova_positive"))


def dc_summary(by_region: DataFrame, order: Sequence[str] = LNP_ORDER) -> DataFrame:
    """All calls in order, those without cells with nulls."""
    spark = by_region.sparkSession
    pairs = (("pct_siinfekl_positive",) * 2, ("pct_ova_positive",) * 2, ("siinfekl_expression", "mean_siinfekl_expression"), ("cd86_in_siinfekl_positive", "mean_cd86_in_siinfekl_positive"))
    means = [f(c).alias(f"{a}_{n}") for n, c in pairs for a, f in (("mean", F.avg), ("sem", sem))]
    out = by_region.groupBy("lnp_call").agg(F.countDistinct("lnp_region").alias("n_regions"), F.sum("n_lnp_positive_dc").alias("total_lnp_positive_dc"), F.sum("n_siinfekl_positive").alias("total_siinfekl_positive"), F.sum("n_ova_positive").alias("total_ova_positive"), *means)
    out = dimension(spark, "lnp_call", order).select("lnp_call").join(out, "lnp_call", "left")
    out = out.withColumns({"pooled_pct_siinfekl_positive": percent("total_siinfekl_positive", "total_lnp_positive_dc"), "pooled_pct_ova_positive": percent("total_ova_positive", "total_lnp_positive_dc")})
    out = out.withColumn("mean_siinfekl_minus_ova_pct_points", F.col("mean_pct_siinfekl_positive") - F.col("mean_pct_ova_positive"))
    return out.join(F.broadcast(lnp_detail(spark)), "lnp_call", "left")


def peptide_composition(by_region: DataFrame, order: Sequence[str] = LNP_ORDER) -> DataFrame:
    """Which calls the gated positive dendritic cells have; the total is 1 at least."""
    spark = by_region.sparkSession
    counts = by_region.groupBy("lnp_call").agg(F.sum("n_siinfekl_positive").alias("n_siinfekl_positive_lnp_dc"))
    out = complete_grid(counts, ["lnp_call"], dimension(spark, "lnp_call", order).select("lnp_call"), ["n_siinfekl_positive_lnp_dc"])
    total = out.agg(F.greatest(F.sum("n_siinfekl_positive_lnp_dc"), F.lit(1)).alias("__total"))
    return out.crossJoin(F.broadcast(total)).withColumn("pct_siinfekl_positive_lnp_dc", percent("n_siinfekl_positive_lnp_dc", "__total")).drop("__total")
