"""Queries of relational tables: uptake, composition, expression, quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import lineage, rounded
from ..schemas import AVERAGE_BASIS, AVERAGE_FORMULATION, CALL_BASIS, lnp_detail
from ..sources.cells import cells, clean_cells, gates
from . import expression as E
from . import uptake as U
from .sql import CALLS, CELLS, DETAIL, GATES, LABELS, REGIONS, r, sem, with_

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    """Registers a query, rounded, with its SQL."""

    def add(f):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return f

    return add


_UPTAKE = with_(
    CELLS,
    DETAIL,
    CALLS,
    REGIONS,
    "t AS (SELECT lnp_region, count(*) AS n_cells_total FROM cells GROUP BY 1)",
    "p AS (SELECT lnp_region, lnp_call, count(*) AS n FROM cells WHERE lnp_positive GROUP BY 1, 2)",
    "u AS (SELECT condition, g.lnp_region, g.lnp_call, coalesce(n, 0) AS n_lnp_positive, n_cells_total, 100.0::DOUBLE * coalesce(n, 0) / nullif(n_cells_total, 0) AS pct FROM (SELECT * FROM regions, calls) g LEFT JOIN p USING (lnp_region, lnp_call) LEFT JOIN t USING (lnp_region))",
)


@query("G3_uptake_by_region", _UPTAKE + f"SELECT lnp_call, condition, lnp_region, n_lnp_positive, n_cells_total, {r('pct')} AS pct_cells_lnp_positive, lnp_number, source_raw_lnp_call, ionizable_lipid, helper_lipid, formulation FROM u LEFT JOIN detail USING (lnp_call)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return U.uptake_by_region(cells(spark, d))


@query(
    "G3_uptake_summary",
    _UPTAKE
    + f"""SELECT lnp_call, condition, count(DISTINCT lnp_region) AS n_regions, {r("avg(pct)")} AS mean_pct_cells_lnp_positive, {r(sem("pct"))} AS sem_pct_cells_lnp_positive,
CAST(sum(n_lnp_positive) AS BIGINT) AS total_positive_cells, CAST(sum(n_cells_total) AS BIGINT) AS total_cells, {r("100.0::DOUBLE * sum(n_lnp_positive) / nullif(sum(n_cells_total), 0)")} AS pooled_pct_cells_lnp_positive,
lnp_number, source_raw_lnp_call, ionizable_lipid, helper_lipid, formulation FROM u LEFT JOIN detail USING (lnp_call) GROUP BY ALL""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return U.uptake_summary(U.uptake_by_region(cells(spark, d)))


_TYPES = with_(
    CELLS,
    DETAIL,
    "t AS (SELECT lnp_region, cell_type, count(*) AS n_cell_type_total FROM cells WHERE condition = 'LNP' GROUP BY 1, 2)",
    "u AS (SELECT lnp_region, cell_type, lnp_call, count(*) AS n_lnp_positive, any_value(n_cell_type_total) AS n_cell_type_total, 100.0::DOUBLE * count(*) / any_value(n_cell_type_total) AS pct FROM cells JOIN t USING (lnp_region, cell_type) WHERE lnp_positive GROUP BY 1, 2, 3)",
)


@query("G4_celltype_uptake", _TYPES + f"SELECT lnp_region, cell_type, lnp_call, n_lnp_positive, n_cell_type_total, {r('pct')} AS pct_cell_type_lnp_positive FROM u")
def _(spark: SparkSession, d: str) -> DataFrame:
    return U.celltype_uptake(cells(spark, d))


@query(
    "G4_celltype_summary",
    _TYPES
    + f"""SELECT lnp_call, cell_type, count(DISTINCT lnp_region) AS n_regions, {r("avg(pct)")} AS mean_pct_cell_type_lnp_positive, {r(sem("pct"))} AS sem_pct_cell_type_lnp_positive,
CAST(sum(n_lnp_positive) AS BIGINT) AS total_positive_cells, {r("median(pct)")} AS median_region_pct, lnp_number, source_raw_lnp_call, ionizable_lipid, helper_lipid, formulation FROM u LEFT JOIN detail USING (lnp_call) GROUP BY ALL""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return U.celltype_uptake_summary(U.celltype_uptake(cells(spark, d)))


@query("K2_top_celltypes", _TYPES + "SELECT cell_type FROM u GROUP BY 1 ORDER BY sum(n_lnp_positive) DESC, 1 LIMIT 12")
def _(spark: SparkSession, d: str) -> DataFrame:
    return U.top_celltypes(U.celltype_uptake_summary(U.celltype_uptake(cells(spark, d))))


@query(
    "G5_positive_composition",
    with_(
        CELLS,
        DETAIL,
        CALLS,
        "p AS (SELECT lnp_call, cell_type, count(*) AS n FROM cells WHERE lnp_positive GROUP BY 1, 2)",
        "k AS (SELECT cell_type FROM p GROUP BY 1 ORDER BY sum(n) DESC, 1 LIMIT 10)",
        "a AS (SELECT * FROM p UNION ALL SELECT 'Tissue_average', cell_type, count(*) FROM cells WHERE condition = 'LNP' GROUP BY 2)",
        "g AS (SELECT o.lnp_call, k.cell_type, coalesce(n, 0) AS n FROM (SELECT lnp_call FROM calls UNION ALL SELECT 'Tissue_average') o CROSS JOIN k LEFT JOIN a ON a.lnp_call = o.lnp_call AND a.cell_type = k.cell_type)",
        "s AS (SELECT *, CAST(sum(n) OVER (PARTITION BY lnp_call) AS BIGINT) AS total FROM g)",
    )
    + f"""SELECT lnp_call, cell_type, n AS n_lnp_positive, total AS n_lnp_positive_total, {r("100.0::DOUBLE * n / nullif(total, 0)")} AS pct_of_lnp_positive_cells, lnp_number, source_raw_lnp_call, ionizable_lipid, helper_lipid,
CASE WHEN lnp_call = 'Tissue_average' THEN '{AVERAGE_FORMULATION}' ELSE formulation END AS formulation,
CASE WHEN lnp_call = 'Tissue_average' THEN '{AVERAGE_BASIS}' ELSE '{CALL_BASIS}' END AS composition_basis FROM s LEFT JOIN detail USING (lnp_call)""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return U.positive_composition(cells(spark, d))


_ENRICHED = with_(
    CELLS,
    DETAIL,
    CALLS,
    "b AS (SELECT cell_type, count(*) AS nb, count(*)::DOUBLE / sum(count(*)) OVER () AS f FROM cells WHERE condition = 'LNP' GROUP BY 1)",
    "p AS (SELECT lnp_call, cell_type, count(*) AS n FROM cells WHERE lnp_positive GROUP BY 1, 2)",
    "g AS (SELECT lnp_call, cell_type, nb, f, coalesce(n, 0) AS n FROM (SELECT * FROM calls, b) LEFT JOIN p USING (lnp_call, cell_type))",
    "h AS (SELECT *, CAST(sum(n) OVER (PARTITION BY lnp_call) AS BIGINT) AS total FROM g)",
    "i AS (SELECT *, n::DOUBLE / nullif(total, 0) AS pf, n::DOUBLE / nullif(total, 0) / nullif(f, 0) AS e FROM h)",
    "j AS (SELECT *, CASE WHEN e > 0 THEN log2(e) END AS l, max(e) OVER (PARTITION BY cell_type) AS m FROM i)",
)


@query(
    "G6_relative_enrichment",
    _ENRICHED
    + f"""SELECT lnp_call, cell_type, nb AS n_cells_background, {r("f")} AS background_fraction, n AS n_lnp_positive, total AS n_lnp_positive_total, {r("pf")} AS positive_fraction_within_lnp, {r("e")} AS enrichment_vs_background,
{r("l")} AS log2_enrichment_vs_background, {r("m")} AS max_enrichment_for_cell_type, {r("e / nullif(m, 0)")} AS relative_enrichment_within_cell_type, lnp_number, source_raw_lnp_call, ionizable_lipid, helper_lipid, formulation FROM j LEFT JOIN detail USING (lnp_call)""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return U.relative_enrichment(cells(spark, d))


@query(
    "G6_best_call_by_type",
    _ENRICHED
    + f"""SELECT cell_type, lnp_call, formulation, helper_lipid, ionizable_lipid, n AS n_lnp_positive, {r("pf")} AS positive_fraction_within_lnp, {r("f")} AS background_fraction, {r("e")} AS enrichment_vs_background, {r("l")} AS log2_enrichment_vs_background
FROM (SELECT *, row_number() OVER (PARTITION BY cell_type ORDER BY e DESC NULLS LAST, lnp_call) AS k FROM j) LEFT JOIN detail USING (lnp_call) WHERE k = 1""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return U.best_call_by_type(U.relative_enrichment(cells(spark, d)))


@query("G13_region_qc", with_(CELLS) + f"SELECT condition, lnp_region, count(*) AS n_cells, count_if(lnp_positive) AS n_any_lnp_positive, {r('100.0::DOUBLE * count_if(lnp_positive) / count(*)')} AS pct_any_lnp_positive FROM cells GROUP BY 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    return U.region_qc(cells(spark, d))


@query("G13_call_qc", with_(CELLS, DETAIL) + "SELECT lnp_call, condition, count(*) AS n_cells, count_if(lnp_positive) AS n_positive, lnp_number, source_raw_lnp_call, ionizable_lipid, helper_lipid, formulation FROM cells LEFT JOIN detail USING (lnp_call) GROUP BY ALL")
def _(spark: SparkSession, d: str) -> DataFrame:
    return U.call_qc(cells(spark, d))


@query(
    "G17_type_enrichment",
    with_(
        CELLS,
        "a AS (SELECT 'all' AS grp, cell_type, count(*) AS n FROM cells GROUP BY 2 UNION ALL SELECT 'positive', cell_type, count(*) FROM cells WHERE lnp_positive GROUP BY 2)",
        "b AS (SELECT *, 100.0::DOUBLE * n / sum(n) OVER (PARTITION BY grp) AS p FROM a)",
        "c AS (SELECT grp, n, CASE WHEN max(p) OVER (PARTITION BY cell_type) >= 18 THEN cell_type ELSE 'Other' END AS cell_type FROM b)",
        "e AS (SELECT grp, cell_type, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY 1, 2)",
        "f AS (SELECT *, 100.0::DOUBLE * n / sum(n) OVER (PARTITION BY grp) AS p FROM e)",
        "w AS (SELECT cell_type, max(n) FILTER (grp = 'positive') AS np, max(n) FILTER (grp = 'all') AS na, max(p) FILTER (grp = 'positive') AS pp, max(p) FILTER (grp = 'all') AS pa FROM f GROUP BY 1)",
    )
    + f"SELECT cell_type, np AS n_cells_lnppositive_cells, na AS n_cells_all_cells, {r('pp')} AS percent_lnppositive_cells, {r('pa')} AS percent_all_cells, {r('pp / pa')} AS representation_ratio, {r('log2(pp / pa)')} AS log2_representation_ratio FROM w",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return U.type_enrichment(cells(spark, d), min_percent=18.0)


def with_single(spark: SparkSession, d: str) -> DataFrame:
    """Cells with the second strategy's call."""
    extra = spark.read.parquet(f"{d}/events.parquet").select(F.col("event_id").alias("cell_id"), F.expr("(event_id * 37 + user_id) % 10 < 4").alias("single_positive"))
    return cells(spark, d).join(extra, "cell_id")


_TILES = with_(
    CELLS,
    "s AS (SELECT lnp_region, CAST(floor(x / 150) AS BIGINT) AS tile_x, CAST(floor(y / 150) AS BIGINT) AS tile_y, 'codebook' AS strategy, lnp_positive AS hit FROM cells UNION ALL SELECT lnp_region, CAST(floor(x / 150) AS BIGINT), CAST(floor(y / 150) AS BIGINT), 'single_bit', single_positive FROM cells)",
)


@query("G16_tile_summary", _TILES + f"SELECT strategy, lnp_region, tile_x, tile_y, count(*) AS n_cells, count_if(hit) AS n_positive, {r('100.0::DOUBLE * count_if(hit) / count(*)')} AS percent_positive FROM s GROUP BY 1, 2, 3, 4 HAVING count(*) >= 10")
def _(spark: SparkSession, d: str) -> DataFrame:
    return U.tile_summary(with_single(spark, d))[0]


@query("G16_whole_region_summary", _TILES + f"SELECT strategy, lnp_region, CAST(count(*) AS BIGINT) AS n_cells, CAST(count_if(hit) AS BIGINT) AS n_positive, {r('100.0::DOUBLE * count_if(hit) / count(*)')} AS percent_positive FROM s GROUP BY 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    return U.tile_summary(with_single(spark, d))[1]


@query("A5_gate_table", with_(CELLS) + f"""SELECT marker, col AS "column", round(quantile_cont(v, 0.95), 6) AS threshold, {r("median(v)")} AS reference_median, count(v) AS reference_n_cells FROM (SELECT 'Luc' AS marker, 'Fluc' AS col, Fluc AS v FROM cells WHERE lnp_region = 'S2_reg004' UNION ALL SELECT 'OVA', 'OVA', OVA FROM cells WHERE lnp_region = 'S2_reg004') GROUP BY 1, 2""")
def _(spark: SparkSession, d: str) -> DataFrame:
    return gates(cells(spark, d), E.GENES, 0.95)


@query("G7_gene_flags", with_(CELLS, GATES) + 'SELECT cell_id, luc_pos AS "Luc_positive", ova_pos AS "OVA_positive", luc_pos AND ova_pos AS "Luc_OVA_double_positive" FROM gated')
def _(spark: SparkSession, d: str) -> DataFrame:
    return E.gate_genes(cells(spark, d)).select("cell_id", "Luc_positive", "OVA_positive", "Luc_OVA_double_positive")


@query("G18_clean_and_gate", with_(CELLS, GATES) + f'SELECT cell_id, lnp_region, cell_type AS cell_type_pooled, {r("x")} AS x, {r("y")} AS y, luc_pos AS "Luc_positive", ova_pos AS "OVA_positive" FROM gated')
def _(spark: SparkSession, d: str) -> DataFrame:
    return E.gate_genes(clean_cells(cells(spark, d))).select("cell_id", "lnp_region", "cell_type_pooled", "x", "y", "Luc_positive", "OVA_positive")


_AGG = f"""count(*) AS n_cells, count_if(lnp_positive) AS n_lnp_positive, count_if(luc_pos) AS n_luc_positive, count_if(ova_pos) AS n_ova_positive, count_if(luc_pos AND ova_pos) AS n_luc_ova_double_positive,
{r("avg(Fluc)")} AS mean_luc, {r("avg(OVA)")} AS mean_ova, {r("median(Fluc)")} AS median_luc, {r("median(OVA)")} AS median_ova"""
_PCT = ", ".join(f"{r(f'100.0::DOUBLE * n_{m} / n_cells')} AS pct_{m}" for m in ("luc_positive", "ova_positive", "luc_ova_double_positive"))


@query(
    "G9_gene_region_summary",
    with_(CELLS, GATES, f"a AS (SELECT condition, lnp_region, lnp_call, 'all_cells' AS analysis_population, {_AGG} FROM gated GROUP BY 1, 2, 3 UNION ALL SELECT condition, lnp_region, lnp_call, 'lnp_positive_cells', {_AGG} FROM gated WHERE lnp_positive GROUP BY 1, 2, 3)") + f"SELECT *, {_PCT} FROM a",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return E.region_summary(E.gate_genes(cells(spark, d)))


_MEANS = ", ".join(f"{r(f'avg(pct_{m})')} AS mean_pct_{m}, {r(sem(f'pct_{m}'))} AS sem_pct_{m}" for m in ("luc_positive", "ova_positive", "luc_ova_double_positive"))


@query(
    "G9_gene_positive_summary",
    with_(CELLS, GATES, DETAIL, f"a AS (SELECT lnp_region, lnp_call, {_AGG} FROM gated WHERE lnp_positive GROUP BY 1, 2)", "b AS (SELECT *, " + ", ".join(f"100.0::DOUBLE * n_{m} / n_cells AS pct_{m}" for m in ("luc_positive", "ova_positive", "luc_ova_double_positive")) + " FROM a)")
    + f"""SELECT lnp_call, count(DISTINCT lnp_region) AS n_regions, {_MEANS}, CAST(sum(n_cells) AS BIGINT) AS total_lnp_positive_cells, CAST(sum(n_luc_positive) AS BIGINT) AS total_luc_positive, CAST(sum(n_ova_positive) AS BIGINT) AS total_ova_positive,
lnp_number, source_raw_lnp_call, ionizable_lipid, helper_lipid, formulation FROM b LEFT JOIN detail USING (lnp_call) GROUP BY ALL""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return E.positive_summary(E.region_summary(E.gate_genes(cells(spark, d))))


_MARKED = (
    "m AS (SELECT 'Luc' AS marker, cell_type, CASE WHEN lnp_positive THEN lnp_call ELSE 'no_lnp_signal' END AS lnp_label FROM gated WHERE condition = 'LNP' AND luc_pos UNION ALL SELECT 'OVA', cell_type, CASE WHEN lnp_positive THEN lnp_call ELSE 'no_lnp_signal' END FROM gated WHERE condition = 'LNP' AND ova_pos)",
    "mk AS (SELECT unnest(['Luc', 'OVA']) AS marker)",
)
_LABELLED = with_(CELLS, GATES, LABELS, *_MARKED, "c AS (SELECT marker, lnp_label, count(*) AS n FROM m GROUP BY 1, 2)", "g AS (SELECT marker, lnp_label, coalesce(n, 0) AS n FROM (SELECT * FROM mk, labels_) LEFT JOIN c USING (marker, lnp_label))")


@query("G10_label_composition", _LABELLED + f"SELECT marker, lnp_label, n AS n_positive_cells, {r('100.0::DOUBLE * n / nullif(sum(n) OVER (PARTITION BY marker), 0)')} AS pct_of_marker_positive_cells FROM g")
def _(spark: SparkSession, d: str) -> DataFrame:
    return E.label_composition(E.gate_genes(cells(spark, d)))


@query(
    "G10_label_summary",
    _LABELLED
    + f"SELECT marker, CAST(sum(n) AS BIGINT) AS n_positive_cells, CAST(sum(n) FILTER (lnp_label <> 'no_lnp_signal') AS BIGINT) AS n_lnp_labeled, {r('100.0::DOUBLE * (sum(n) FILTER (lnp_label <> ' + repr('no_lnp_signal') + ')) / nullif(sum(n), 0)')} AS pct_lnp_labeled, CAST(sum(n) FILTER (lnp_label = 'no_lnp_signal') AS BIGINT) AS n_no_lnp_signal FROM g GROUP BY 1",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return E.label_summary(E.label_composition(E.gate_genes(cells(spark, d))))


@query("G11_type_composition", with_(CELLS, GATES, *_MARKED, "c AS (SELECT marker, cell_type, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY marker) AS BIGINT) AS t FROM m GROUP BY 1, 2)") + f"SELECT marker, cell_type, n AS n_positive_cells, t AS total_positive_cells, {r('100.0::DOUBLE * n / t')} AS pct_positive_cells FROM c")
def _(spark: SparkSession, d: str) -> DataFrame:
    return E.type_composition(E.gate_genes(cells(spark, d)))


@query(
    "G11_type_label_composition",
    with_(
        CELLS,
        GATES,
        LABELS,
        *_MARKED,
        "ty AS (SELECT DISTINCT cell_type FROM cells WHERE condition = 'LNP' AND cell_type IN ('DC', 'CD8+ T', 'CD4+ T', 'B', 'Macrophage'))",
        "c AS (SELECT marker, cell_type, lnp_label, count(*) AS n FROM m GROUP BY 1, 2, 3)",
        "g AS (SELECT marker, cell_type, lnp_label, coalesce(n, 0) AS n FROM (SELECT * FROM mk, ty, labels_) LEFT JOIN c USING (marker, cell_type, lnp_label))",
        "h AS (SELECT *, CAST(sum(n) OVER (PARTITION BY marker, cell_type) AS BIGINT) AS t FROM g)",
    )
    + f"SELECT marker, cell_type, lnp_label, n AS n_positive_cells, t AS total_positive_cells_in_cell_type, {r('100.0::DOUBLE * n / nullif(t, 0)')} AS pct_positive_cells_in_cell_type FROM h",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return E.type_label_composition(E.gate_genes(cells(spark, d)))


def _peptide(spark: SparkSession, d: str) -> DataFrame:
    return E.dc_by_region(E.gate_peptide(E.gate_genes(cells(spark, d))))


_DC = with_(
    CELLS,
    GATES,
    DETAIL,
    CALLS,
    """dc AS (SELECT lnp_region, lnp_call, count(*) AS n, count_if(siin_pos) AS ns, count_if(ova_pos) AS nv, avg(SIINFEKL) AS ms, median(SIINFEKL) AS md, avg(CD86) FILTER (siin_pos) AS mc, median(CD86) FILTER (siin_pos) AS mm,
100.0::DOUBLE * count_if(siin_pos) / count(*) AS ps, 100.0::DOUBLE * count_if(ova_pos) / count(*) AS po FROM gated WHERE condition = 'LNP' AND cell_type = 'DC' AND lnp_positive GROUP BY 1, 2)""",
)


@query(
    "G12_dc_by_region",
    _DC
    + f"""SELECT lnp_region, lnp_call, n AS n_lnp_positive_dc, ns AS n_siinfekl_positive, nv AS n_ova_positive, {r("ms")} AS mean_siinfekl_expression, {r("md")} AS median_siinfekl_expression, {r("mc")} AS mean_cd86_in_siinfekl_positive, {r("mm")} AS median_cd86_in_siinfekl_positive,
{r("ps")} AS pct_siinfekl_positive, {r("po")} AS pct_ova_positive, {r("ps - po")} AS siinfekl_minus_ova_pct_points FROM dc""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return _peptide(spark, d)


@query(
    "G12_dc_summary",
    _DC
    + f"""SELECT lnp_call, n_regions, total_lnp_positive_dc, total_siinfekl_positive, total_ova_positive, a1 AS mean_pct_siinfekl_positive, s1 AS sem_pct_siinfekl_positive, a2 AS mean_pct_ova_positive, s2 AS sem_pct_ova_positive, a3 AS mean_siinfekl_expression, s3 AS sem_siinfekl_expression,
a4 AS mean_cd86_in_siinfekl_positive, s4 AS sem_cd86_in_siinfekl_positive, {r("100.0::DOUBLE * total_siinfekl_positive / total_lnp_positive_dc")} AS pooled_pct_siinfekl_positive, {r("100.0::DOUBLE * total_ova_positive / total_lnp_positive_dc")} AS pooled_pct_ova_positive, dd AS mean_siinfekl_minus_ova_pct_points,
lnp_number, source_raw_lnp_call, ionizable_lipid, helper_lipid, formulation FROM calls LEFT JOIN (SELECT lnp_call, count(DISTINCT lnp_region) AS n_regions, CAST(sum(n) AS BIGINT) AS total_lnp_positive_dc, CAST(sum(ns) AS BIGINT) AS total_siinfekl_positive, CAST(sum(nv) AS BIGINT) AS total_ova_positive,
{r("avg(ps)")} AS a1, {r(sem("ps"))} AS s1, {r("avg(po)")} AS a2, {r(sem("po"))} AS s2, {r("avg(ms)")} AS a3, {r(sem("ms"))} AS s3, {r("avg(mc)")} AS a4, {r(sem("mc"))} AS s4, {r("avg(ps) - avg(po)")} AS dd FROM dc GROUP BY 1) USING (lnp_call) LEFT JOIN detail USING (lnp_call)""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return E.dc_summary(_peptide(spark, d))


@query(
    "G12_peptide_composition",
    _DC + f"SELECT lnp_call, CAST(coalesce(k, 0) AS BIGINT) AS n_siinfekl_positive_lnp_dc, {r('100.0::DOUBLE * coalesce(k, 0) / greatest(sum(coalesce(k, 0)) OVER (), 1)')} AS pct_siinfekl_positive_lnp_dc FROM calls LEFT JOIN (SELECT lnp_call, sum(ns) AS k FROM dc GROUP BY 1) USING (lnp_call)",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return E.peptide_composition(_peptide(spark, d))


@query("G1_detail_join", with_(CELLS, DETAIL) + "SELECT formulation, count(*) AS n_cells FROM cells JOIN detail USING (lnp_call) GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).join(F.broadcast(lnp_detail(spark)), "lnp_call").groupBy("formulation").agg(F.count(F.lit(1)).alias("n_cells"))


@query("G21_overlay_counts", with_(CELLS, "k AS (SELECT *, CASE WHEN cell_type LIKE '%B' THEN 'B' WHEN cell_type LIKE '%T' THEN 'T' WHEN cell_type LIKE '%DC%' THEN 'DC' WHEN cell_type LIKE '%Macrophage%' THEN 'Macrophage' END AS c FROM cells)") + "SELECT lnp_region, c AS cell_class, CASE WHEN lnp_positive THEN lnp_call || '+ ' || c ELSE 'Other ' || c END AS label, count(*) AS n_cells FROM k WHERE c IS NOT NULL GROUP BY 1, 2, 3")
def _(spark: SparkSession, d: str) -> DataFrame:
    return U.overlay_counts(cells(spark, d).withColumn("lineage", lineage("cell_type")), "lineage")
