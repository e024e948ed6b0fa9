"""Composed products: merged annotations, correlations, fitted neighbourhoods, the distance sections and image families."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import stats as S
from ..functions.columns import percent, positive_subset
from ..functions.order import joined, medians
from ..operators import cluster as C
from ..operators import neighbors as N
from ..operators.relational import anti_count, merge_report, relabel, union_columns
from ..schemas import LNP_ORDER, REFERENCE_REGIONS, SWAPPED, TISSUE_AVERAGE, Codebook, lnp_detail
from ..sources import contracts
from ..sources.scratch import materialize

PAIR = ("LNP_08", "LNP_10")


def merge_annotations(annotated: DataFrame, calls: DataFrame, regions: Sequence[str], keys: Sequence[str] = ("lnp_region", "cell_id"), check: bool = True) -> DataFrame:
    """Annotated cells with their barcode call, one to one; labels corrected, missing calls filled, formulations joined.

    With `check`, the regions must be exactly the given ones, the calls unique, and each cell must find one.
    """
    if check:
        contracts.enforce(contracts.region_mismatch(annotated, "lnp_region", regions), "regions differ")
        contracts.enforce(contracts.duplicates(calls, list(keys)), "calls repeat")
        contracts.enforce(contracts.unmatched(annotated, calls, list(keys)), "cells without a call")
    out = annotated.join(calls, list(keys), "left")
    out = out.withColumn("condition", F.when(F.col("lnp_region").isin(list(REFERENCE_REGIONS)), "reference").otherwise("LNP"))
    out = out.withColumn("lnp_call_raw", F.coalesce("lnp_call", F.lit("no_barcode")))
    out = relabel(out, "lnp_call_raw", SWAPPED, "lnp_call").withColumn("lnp_positive", F.coalesce("lnp_positive", F.lit(False)))
    out = out.withColumn("lnp_call_positive_only", F.when(F.col("lnp_positive"), F.col("lnp_call")).otherwise("no_barcode"))
    detail = lnp_detail(annotated.sparkSession)
    detail = detail.select(F.col("lnp_call"), *[F.col(c).alias(f"lnp_detail_{c}") for c in detail.columns if c != "lnp_call"])
    return out.join(F.broadcast(detail), "lnp_call", "left")


def annotation_report(annotated: DataFrame, calls: DataFrame, keys: Sequence[str] = ("lnp_region", "cell_id")) -> DataFrame:
    """(item, n): kept cells, keys on both sides or one, and calls of no annotated cell."""
    merged = merge_report(annotated, calls, keys).select(F.col("_merge").alias("item"), "n")
    kept = annotated.agg(F.count(F.lit(1)).alias("n")).select(F.lit("n_retained").alias("item"), "n")
    return merged.unionByName(kept).unionByName(anti_count(calls, annotated, keys).select(F.lit("extra_spot_rows").alias("item"), "n"))


def uptake_against_expression(uptake: DataFrame, labels: DataFrame, kind: str = "B", marker: str = "OVA", without_average: bool = True) -> DataFrame:
    """(lnp_call, both shares, their difference): how one type's uptake and its gene-positive cells spread over the calls.

    `without_average` leaves the tissue average out of the uptake's total.
    """
    up = uptake.where(F.col("cell_type") == kind).select("lnp_call", "n_lnp_positive", "lnp_number", "formulation")
    counted = up.where(F.col("lnp_call") != TISSUE_AVERAGE) if without_average else up
    up = up.crossJoin(F.broadcast(counted.agg(F.sum("n_lnp_positive").alias("__t")))).withColumn("uptake_composition_pct", percent("n_lnp_positive", "__t")).drop("__t")
    tr = labels.where((F.col("cell_type") == kind) & (F.col("marker") == marker) & F.col("lnp_label").startswith("LNP_")).select(F.col("lnp_label").alias("lnp_call"), F.col("n_positive_cells").alias("n_ova_positive_lnp_b"))
    tr = tr.crossJoin(F.broadcast(tr.agg(F.sum("n_ova_positive_lnp_b").alias("__t")))).withColumn("ova_transfection_composition_pct", percent("n_ova_positive_lnp_b", "__t")).drop("__t")
    out = up.join(tr, "lnp_call").withColumn("composition_delta_transfection_minus_uptake", F.col("ova_transfection_composition_pct") - F.col("uptake_composition_pct"))
    return out.withColumn("lnp_label", F.replace(F.col("lnp_call"), F.lit("_"), F.lit(" ")))


def correlations(table: DataFrame, x: str = "uptake_composition_pct", y: str = "ova_transfection_composition_pct") -> DataFrame:
    """(n, spearman_rho, spearman_pvalue, pearson_r, pearson_pvalue): one row."""
    rho = S.spearman(table, x, y).select("n", F.col("rho").alias("spearman_rho"))
    both = rho.crossJoin(S.pearson(table, x, y).select(F.col("r").alias("pearson_r")))
    return both.withColumn("spearman_pvalue", S.correlation_p(F.col("spearman_rho"), F.col("n"))).withColumn("pearson_pvalue", S.correlation_p(F.col("pearson_r"), F.col("n")))


def fit_neighborhoods(cells: DataFrame, kinds: Sequence[str], k: int = 12, seed: int = 0, names: dict[int, str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cells with cluster and name, composition of names, names by size) of k-means over the ten nearest cells' types."""
    rows = N.composition_array(cells, kinds)
    centroids, _ = C.fit_centroids(rows, k, seed)
    assigned = C.assign(rows, centroids)
    pct = C.composition_percent(C.cluster_means(assigned, kinds))
    labels, weights = C.ranked_names(pct, names), C.sizes(assigned, k)
    named = cells.join(assigned.select("cell_id", "cluster"), "cell_id", "left").join(F.broadcast(labels), "cluster", "left")
    return named, C.merge_named(pct, labels, weights), C.names_by_size(labels, weights)


def target_section(cells: DataFrame, targets: DataFrame, kind: str, markers: Sequence[str], k: int = 10, radius: float = 25.0) -> dict[str, DataFrame]:
    """Pairs of the targets with their nearest cells of a type, per-target metrics, and the state of distinct neighbours by region with tests."""
    pairs = N.neighbor_pairs(targets, cells, kind, k=k, radius=radius)
    metrics = pairs.groupBy("lnp_region", "lnp_call", "target_id").agg(F.countDistinct("neighbor_id").alias("n_neighbors"), F.median("distance_um").alias("median_distance_um"))
    spatial = metrics.groupBy("lnp_region", "lnp_call").agg(F.count(F.lit(1)).alias("n_targets"), F.avg("n_neighbors").alias("mean_neighbors"), F.median("median_distance_um").alias("median_distance_um"))
    state = N.neighbor_state(pairs, cells, markers, ["lnp_region", "lnp_call"])
    own = N.own_state(targets, markers, ["lnp_region", "lnp_call"])
    tests = S.paired_t_test(state, "lnp_call", PAIR, "median", ["marker"])
    return {"pairs": pairs, "metrics": metrics, "spatial": spatial, "state": state, "own_state": own, "state_tests": tests, "spatial_tests": S.paired_t_test(spatial, "lnp_call", PAIR, "mean_neighbors"), "own_tests": S.paired_t_test(own, "lnp_call", PAIR, "median", ["marker"])}


class AroundSection:
    """What lies around targets, by region and call: nearest cells of a type at several k, within several radii, and of the k nearest within a radius; composition of the neighbours; neighbourhoods of the targets.

    `composition` is (cell_id, cell_type, fraction), and is made for the targets when it is asked for, if none is given; `label`, if given, is the column of cells with their neighbourhood. Tests compare the two calls of `PAIR`. Each table is made when it is asked for.
    """

    BY = ("lnp_region", "lnp_call")

    def __init__(self, cells: DataFrame, targets: DataFrame, kind: str, name: str, composition: DataFrame | None = None, label: str | None = None, ks: Sequence[int] = (10, 20, 30), radii: Sequence[float] = (10.0, 25.0, 50.0), k: int = 10, radius: float = 25.0, marker: str = "CD86"):
        self.cells, self.targets, self.kind, self.name, self.composition, self.label = cells, targets, kind, name, composition, label
        self.ks, self.radii, self.k, self.radius, self.marker = ks, radii, k, radius, marker

    def _placed(self, metrics: DataFrame) -> DataFrame:
        return materialize(metrics.join(self.targets.select("cell_id", *self.BY), "cell_id"), "around")

    def _regions(self, metrics: DataFrame, steps: Sequence[object], n: str, has: str, mean: str) -> DataFrame:
        each = lambda f: [f.format(self.name, x) for x in steps]
        return N.region_metrics(metrics, self.BY, each(n), each(has), each(mean))

    @cached_property
    def multiscale(self) -> DataFrame:
        return self._placed(N.multiscale_metrics(self.targets, self.cells, self.kind, self.ks, self.name))

    @cached_property
    def multiscale_by_region(self) -> DataFrame:
        return self._regions(self.multiscale, self.ks, "n_{}_neighbors_k{}", "has_{}_neighbor_k{}", "mean_{}_distance_um_k{}")

    @cached_property
    def within(self) -> DataFrame:
        return self._placed(N.radius_metrics(self.targets, self.cells, self.kind, self.radii, self.name))

    @cached_property
    def radius_by_region(self) -> DataFrame:
        return self._regions(self.within, [f"{r:g}" for r in self.radii], "n_{}_within_r{}", "has_{}_within_r{}", "mean_{}_distance_um_r{}")

    @cached_property
    def hybrid(self) -> DataFrame:
        return self._placed(N.hybrid_metrics(self.targets, self.cells, self.kind, self.k, self.radius, self.name))

    @cached_property
    def hybrid_by_region(self) -> DataFrame:
        n = self.name
        return N.region_metrics(self.hybrid, self.BY, [f"n_{n}_neighbors"], [f"has_{n}_neighbor"], [f"mean_{n}_distance_um", f"median_{n}_distance_um"])

    @cached_property
    def metrics_by_region(self) -> DataFrame:
        n, marker = self.name, self.marker
        own = self.targets.groupBy(*self.BY).agg(F.count(F.lit(1)).alias("n_targets"), F.avg(marker).alias(f"mean_{marker.lower()}"))
        near = self.hybrid.groupBy(*self.BY).agg(F.avg(f"n_{n}_neighbors").alias(f"mean_n_{n}_neighbors"), F.count_if(f"has_{n}_neighbor").alias(f"n_with_{n}_neighbor"), F.avg(f"mean_{n}_distance_um").alias(f"mean_{n}_distance_um"))
        middle = medians(self.hybrid, self.BY, {f"median_{n}_distance_um": F.col(f"median_{n}_distance_um")})
        return joined(joined(own, near, self.BY), middle, self.BY).withColumn(f"pct_with_{n}_neighbor", percent(f"n_with_{n}_neighbor", "n_targets"))

    def composition_around(self, by: Sequence[str] = BY) -> DataFrame:
        """Mean shares of the neighbours' types; by call only, they are those of all regions together."""
        composition = N.neighbor_composition(self.cells, targets=self.targets) if self.composition is None else self.composition
        return N.focused_composition(self.targets, composition, by)

    def abundance(self, by: Sequence[str] = ("lnp_region",)) -> DataFrame:
        """How the targets of each call spread over the neighbourhoods."""
        return N.subset_distribution(self.targets, "lnp_call", self.label, by)

    def _tests(self, table: DataFrame, columns: Sequence[str]) -> DataFrame:
        table = materialize(table, "tested")
        return union_columns(*[S.paired_t_test(table, "lnp_call", PAIR, c).select(F.lit(c).alias("metric"), "*") for c in columns])

    def hybrid_tests(self) -> DataFrame:
        n = self.name
        return self._tests(self.hybrid_by_region, [f"pct_has_{n}_neighbor", f"mean_n_{n}_neighbors", f"median_median_{n}_distance_um"])

    def metrics_tests(self) -> DataFrame:
        n = self.name
        return self._tests(self.metrics_by_region, [f"pct_with_{n}_neighbor", f"n_with_{n}_neighbor", f"mean_{n}_distance_um", f"mean_{self.marker.lower()}"])


def paired_panels(cells: DataFrame) -> DataFrame:
    """The eight panels of the two calls compared by region, from gated cells with FOXP3, CD19, CD138 and CD25."""
    by = ["lnp_region", "lnp_call"]
    dc = positive_of(cells, "DC", "SIINFEKL_positive")
    hybrid = N.hybrid_metrics(dc, cells, "CD8+ T", 10, 25.0, "cd8").join(dc.select("cell_id", *by), "cell_id")
    by_region = materialize(N.region_metrics(hybrid, by, ["n_cd8_neighbors"], ["has_cd8_neighbor"], ["median_cd8_distance_um"]), "hybrid")
    b = positive_of(cells, "B", "OVA_positive")
    own = materialize(N.own_state(b, ("CD19", "CD138", "CD25"), by), "own")
    around = lambda targets: materialize(N.neighbor_state(N.neighbor_pairs(targets, cells, "CD4+ T"), cells, ("FOXP3",), by), "state")
    tables = {
        "mean_cd86_siinfekl_positive_dc": (dc.where("condition = 'LNP'").groupBy(*by).agg(F.avg("CD86").alias("mean")), "mean", "two-sided", True),
        "median_cd8_distance": (by_region, "median_median_cd8_distance_um", "less", False),
        "pct_cd8_presence": (by_region, "pct_has_cd8_neighbor", "greater", False),
        "cd4_foxp3_median": (around(positive_of(cells, "DC", "OVA_positive")), "median", "two-sided", False),
        "surrounding_cd4_foxp3_median": (around(b), "median", "two-sided", False),
    }
    return panels(tables | {f"ova_b_{m.lower()}_median": (own.where(F.col("marker") == m), "median", "two-sided", False) for m in ("CD19", "CD138", "CD25")})


def panels(tables: dict[str, tuple[DataFrame, str, str, bool]]) -> DataFrame:
    """(panel, test, n, statistic, p_value) of paired panels: name -> (table by region and call, metric, side, whether ranks are tested too)."""
    out = None
    for name, (table, metric, side, ranks) in tables.items():
        rows = S.paired_t_test(table, "lnp_call", PAIR, metric, side=side).select(F.lit(name).alias("panel"), F.lit("paired_t").alias("test"), F.col("n_regions").alias("n"), F.col("t").alias("statistic"), "p_value")
        if ranks:
            w = S.signed_rank_test(table, "lnp_call", PAIR, metric)
            rows = rows.unionByName(w.select(F.lit(name).alias("panel"), F.lit("wilcoxon").alias("test"), "n", F.col("w").alias("statistic"), "p_value"))
        out = rows if out is None else out.unionByName(rows)
    return out


def positive_of(cells: DataFrame, kind: str, gate: str | None = None) -> DataFrame:
    return cells.where(positive_subset(LNP_ORDER, kind, gate))
