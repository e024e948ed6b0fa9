"""Queries of the composed products."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats as S
from ..functions.columns import percent, pool_cell_type, region_key, rounded
from ..operators import cluster as C
from ..operators import decode as D
from ..operators import imaging as I
from ..operators import neighbors as N
from ..operators.relational import cross_share, melt, share, union_columns
from ..schemas import LNP_REGIONS, REFERENCE_REGIONS
from ..sources import files
from ..sources.cells import cells, gates, table
from ..sources.scratch import materialize, shared_folder
from . import expression as E
from . import sections as X
from . import uptake as U
from .queries_spatial import KINDS
from .queries_tables import _MARKED as MARKED_SQL
from .sql import CALLS, CELLS, DETAIL, GATES, r, with_

QUERIES, ORACLES = {}, {}
ALL_REGIONS = LNP_REGIONS + REFERENCE_REGIONS


def query(name: str, sql: str | None = None):
    """Registers a query, rounded, with its SQL."""

    def add(f):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return f

    return add


def _annotated(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Cells without their call, and the calls of them and of some others."""
    c = cells(spark, d)
    extra = c.where("cell_id % 100 = 0").withColumn("cell_id", -F.col("cell_id") - 1)
    calls = c.unionByName(extra).select("lnp_region", "cell_id", F.when(F.col("cell_id") % 7 != 0, F.col("lnp_call")).alias("lnp_call"), F.when(F.col("cell_id") % 5 != 0, F.col("lnp_positive")).alias("lnp_positive"))
    return c.select("cell_id", "lnp_region", "cell_type"), calls


@query(
    "G2_merge_annotations",
    with_(
        CELLS,
        DETAIL,
        "k AS (SELECT cell_id, lnp_region, condition, cell_type, coalesce(CASE WHEN cell_id % 7 <> 0 THEN lnp_call END, 'no_barcode') AS lnp_call_raw, coalesce(CASE WHEN cell_id % 5 <> 0 THEN lnp_positive END, false) AS lnp_positive FROM cells)",
        "m AS (SELECT *, CASE lnp_call_raw WHEN 'LNP_01' THEN 'LNP_02' WHEN 'LNP_02' THEN 'LNP_01' ELSE lnp_call_raw END AS lnp_call FROM k)",
    )
    + """SELECT m.*, CASE WHEN lnp_positive THEN lnp_call ELSE 'no_barcode' END AS lnp_call_positive_only, lnp_number AS lnp_detail_lnp_number, source_raw_lnp_call AS lnp_detail_source_raw_lnp_call, ionizable_lipid AS lnp_detail_ionizable_lipid, helper_lipid AS lnp_detail_helper_lipid,
formulation AS lnp_detail_formulation FROM m LEFT JOIN detail USING (lnp_call)""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return X.merge_annotations(*_annotated(spark, d), ALL_REGIONS)


@query("G2_annotation_report", "SELECT 'both' AS item, count(*) AS n FROM events UNION ALL SELECT 'right_only', count(*) FROM events WHERE event_id % 100 = 0 UNION ALL SELECT 'n_retained', count(*) FROM events UNION ALL SELECT 'extra_spot_rows', count(*) FROM events WHERE event_id % 100 = 0")
def _(spark: SparkSession, d: str) -> DataFrame:
    return X.annotation_report(*_annotated(spark, d))


@query("G15_assemble", with_(CELLS) + "SELECT cell_id, lnp_region, lnp_call, CASE WHEN cell_id % 3 = 0 THEN 'Unknown' WHEN cell_type = 'DC' THEN 'Dendritic' ELSE cell_type END AS cell_type FROM cells")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    return U.assemble(c.select("cell_id", "lnp_region", "lnp_call"), c.where("cell_id % 3 <> 0").select("cell_id", "lnp_region", "cell_type"), {"DC": "Dendritic"})


_CORR = with_(
    CELLS,
    GATES,
    DETAIL,
    CALLS,
    *MARKED_SQL,
    "u AS (SELECT lnp_call, count(c.cell_id) AS n FROM calls LEFT JOIN (SELECT * FROM cells WHERE lnp_positive AND cell_type = 'B') c USING (lnp_call) GROUP BY 1)",
    "v AS (SELECT lnp_call, count(m.marker) AS k FROM calls LEFT JOIN (SELECT * FROM m WHERE marker = 'OVA' AND cell_type = 'B') m ON m.lnp_label = lnp_call GROUP BY 1)",
    "z AS (SELECT lnp_call, n, k, 100.0::DOUBLE * n / sum(n) OVER () AS a, 100.0::DOUBLE * k / sum(k) OVER () AS b FROM u JOIN v USING (lnp_call))",
)


def _against(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    return X.uptake_against_expression(U.positive_composition(c), E.type_label_composition(E.gate_genes(c)))


@query(
    "G14_uptake_against_expression",
    _CORR
    + f"SELECT lnp_call, n AS n_lnp_positive, lnp_number, formulation, {r('a')} AS uptake_composition_pct, k AS n_ova_positive_lnp_b, {r('b')} AS ova_transfection_composition_pct, {r('b - a')} AS composition_delta_transfection_minus_uptake, replace(lnp_call, '_', ' ') AS lnp_label FROM z JOIN detail USING (lnp_call)",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return _against(spark, d)


#: Average ranks of both shares; the p-values are left to the operator's own tests.
@query(
    "G14_rank_correlation",
    _CORR.rstrip() + ", k AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0::DOUBLE AS ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0::DOUBLE AS rb FROM z) " + f"SELECT count(*) AS n, {r('corr(ra, rb)')} AS spearman_rho FROM k",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return X.correlations(_against(spark, d)).select("n", "spearman_rho")


@query("G14_correlations")
def _(spark: SparkSession, d: str) -> DataFrame:
    return X.correlations(_against(spark, d))


@query("G14_pearson", _CORR + f"SELECT count(*) AS n, {r('corr(a, b)')} AS r FROM z")
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.pearson(_against(spark, d), "uptake_composition_pct", "ova_transfection_composition_pct")


@query("G19_fit_and_name_neighborhoods")
def _(spark: SparkSession, d: str) -> DataFrame:
    return X.fit_neighborhoods(cells(spark, d), KINDS, 8)[1]


@query("G20_cluster_sizes_and_names")
def _(spark: SparkSession, d: str) -> DataFrame:
    return X.fit_neighborhoods(cells(spark, d), KINDS, 6)[2]


@query("G22_peptide_gate", with_(CELLS) + f"""SELECT 'SIINFEKL' AS marker, 'SIINFEKL' AS "column", round(quantile_cont(SIINFEKL, 0.9), 6) AS threshold, {r("median(SIINFEKL)")} AS reference_median, count(SIINFEKL) AS reference_n_cells FROM cells WHERE lnp_region = 'S2_reg004'""")
def _(spark: SparkSession, d: str) -> DataFrame:
    return gates(cells(spark, d), {"SIINFEKL": "SIINFEKL"}, 0.9)


_MARKERS = ("Fluc", "SIINFEKL", "CD86")


def _section(spark: SparkSession, d: str, kind: str, gate: str | None, neighbor: str) -> dict[str, DataFrame]:
    c = E.gate_peptide(E.gate_genes(cells(spark, d)))
    return X.target_section(c, X.positive_of(c, kind, gate), neighbor, _MARKERS)


def _section_sql(gate: str, neighbor: str) -> str:
    """Pairs (q) of gated dendritic cells with the nearest cells of a type, and each neighbour's nearest pair (u)."""
    near = "sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))"
    return with_(
        CELLS,
        GATES,
        f"tg AS (SELECT * FROM gated WHERE lnp_positive AND cell_type = 'DC' AND {gate})",
        f"pr AS (SELECT a.lnp_region, a.lnp_call, a.cell_id AS t, b.cell_id AS n, {near} AS d, row_number() OVER (PARTITION BY a.cell_id ORDER BY {near}, b.cell_id) AS k FROM tg a JOIN cells b ON a.lnp_region = b.lnp_region AND b.cell_type = '{neighbor}' AND a.cell_id <> b.cell_id)",
        "q AS (SELECT * FROM pr WHERE k <= 10 AND d < 25)",
        "u AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY n ORDER BY d, t) = 1)",
    ).rstrip()


_STATE = " UNION ALL ".join(f"SELECT c.lnp_region, lnp_call, '{m}' AS marker, {m} AS v FROM u JOIN (SELECT cell_id, lnp_region, {m} FROM cells) c ON c.cell_id = n" for m in _MARKERS)


@query(
    "G23_dc_cd8_section",
    _section_sql("siin_pos", "CD8+ T")
    + ", mt AS (SELECT lnp_region, lnp_call, t, count(DISTINCT n) AS c, median(d * 0.5) AS m FROM q GROUP BY 1, 2, 3) "
    + f"SELECT lnp_region, lnp_call, count(*) AS n_targets, {r('avg(c)')} AS mean_neighbors, {r('median(m)')} AS median_distance_um FROM mt GROUP BY 1, 2",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return _section(spark, d, "DC", "SIINFEKL_positive", "CD8+ T")["spatial"]


@query("G23_dc_cd8_tests")
def _(spark: SparkSession, d: str) -> DataFrame:
    return _section(spark, d, "DC", None, "CD8+ T")["spatial_tests"]


@query("G24_dc_cd4_activation", _section_sql("ova_pos", "CD4+ T") + f", l AS ({_STATE}) SELECT lnp_region, lnp_call, marker, {r('avg(v)')} AS mean, {r('median(v)')} AS median, count(*) AS n_unique_neighbors FROM l GROUP BY 1, 2, 3")
def _(spark: SparkSession, d: str) -> DataFrame:
    return _section(spark, d, "DC", "OVA_positive", "CD4+ T")["state"]


_OWN = " UNION ALL ".join(f"SELECT lnp_region, lnp_call, '{m}' AS marker, {m} AS v FROM gated WHERE lnp_positive AND cell_type = 'B' AND ova_pos" for m in _MARKERS)


@query("G25_b_own_state", with_(CELLS, GATES, f"l AS ({_OWN})") + f"SELECT lnp_region, lnp_call, marker, {r('avg(v)')} AS mean, {r('median(v)')} AS median, count(*) AS n_cells FROM l GROUP BY 1, 2, 3")
def _(spark: SparkSession, d: str) -> DataFrame:
    return _section(spark, d, "B", "OVA_positive", "CD4+ T")["own_state"]


@query(
    "G25_b_own_state_tests",
    with_(CELLS, GATES, f"l AS ({_OWN})", "s AS (SELECT lnp_region, lnp_call, marker, median(v) AS v FROM l GROUP BY 1, 2, 3)", "w AS (SELECT marker, lnp_region, max(v) FILTER (lnp_call = 'LNP_08') AS a, max(v) FILTER (lnp_call = 'LNP_10') AS b FROM s GROUP BY 1, 2 HAVING a IS NOT NULL AND b IS NOT NULL)")
    + f"SELECT marker, count(*) AS n_regions, CASE WHEN count(*) >= 2 THEN count(*) - 1 END AS df, {r('CASE WHEN count(*) >= 2 AND stddev_samp(a - b) > 0 THEN avg(a - b) * sqrt(count(*)) / stddev_samp(a - b) END')} AS t, {r('avg(a)')} AS mean_a, {r('avg(b)')} AS mean_b FROM w GROUP BY 1",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    own = _section(spark, d, "B", "OVA_positive", "CD4+ T")["own_state"]
    return S.paired_t(own, "lnp_call", X.PAIR, "median", ["marker"])


def _around(spark: SparkSession, d: str) -> X.AroundSection:
    c = E.gate_peptide(E.gate_genes(cells(spark, d)))
    return X.AroundSection(*_targets(c), "CD8+ T", "cd8", label="quarter", ks=(10, 20), radii=(10.0, 25.0))


def _targets(c: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells with the quarter of the region that they lie in, and the gated dendritic ones."""
    c = c.withColumn("quarter", F.concat(F.when(F.col("x") < 300, "left").otherwise("right"), F.when(F.col("y") < 300, "-low").otherwise("-high")))
    return c, X.positive_of(c, "DC", "SIINFEKL_positive")


_NEAR = "sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))"
#: Gated dendritic cells (tg), their pairs with all cells of the region in order (pr), and those with cells of the type (pk).
_AROUND = with_(
    CELLS,
    GATES,
    "tg AS (SELECT *, concat(CASE WHEN x < 300 THEN 'left' ELSE 'right' END, CASE WHEN y < 300 THEN '-low' ELSE '-high' END) AS quarter FROM gated WHERE lnp_positive AND cell_type = 'DC' AND siin_pos)",
    f"pr AS (SELECT a.lnp_region, a.lnp_call, a.cell_id AS t, b.cell_id AS n, b.cell_type AS nt, {_NEAR} AS d, row_number() OVER (PARTITION BY a.cell_id ORDER BY {_NEAR}, b.cell_id) AS k FROM tg a JOIN cells b ON a.lnp_region = b.lnp_region AND a.cell_id <> b.cell_id)",
).rstrip()


def _by_region(conditions: dict[str, str], n: str, has: str, mean: str) -> str:
    """Mean counts, percents and distances by region of pairs that meet each condition, by the columns' names."""
    per = ", ".join(f"count(*) FILTER (nt = 'CD8+ T' AND {c}) AS n{i}, avg(d * 0.5) FILTER (nt = 'CD8+ T' AND {c}) AS d{i}" for i, c in enumerate(conditions.values()))
    cols = ", ".join(f"{r(f'avg(coalesce(n{i}, 0))')} AS mean_{n.format(x)}, {r(f'avg(CASE WHEN n{i} > 0 THEN 100.0 ELSE 0.0 END)')} AS pct_{has.format(x)}, {r(f'avg(d{i})')} AS mean_{mean.format(x)}, {r(f'median(d{i})')} AS median_{mean.format(x)}" for i, x in enumerate(conditions))
    return f", pc AS (SELECT t, {per} FROM pr GROUP BY 1) SELECT lnp_region, lnp_call, count(*) AS n_target_cells, {cols} FROM tg LEFT JOIN pc ON t = cell_id GROUP BY 1, 2"


@query("G23_multiscale_by_region", _AROUND + _by_region({"10": "k <= 10", "20": "k <= 20"}, "n_cd8_neighbors_k{}", "has_cd8_neighbor_k{}", "mean_cd8_distance_um_k{}"))
def _(spark: SparkSession, d: str) -> DataFrame:
    return _around(spark, d).multiscale_by_region


@query("G23_radius_by_region", _AROUND + _by_region({"10": "d <= 10", "25": "d <= 25"}, "n_cd8_within_r{}", "has_cd8_within_r{}", "mean_cd8_distance_um_r{}"))
def _(spark: SparkSession, d: str) -> DataFrame:
    return _around(spark, d).radius_by_region


_HYBRID = ", hy AS (SELECT t, count(*) FILTER (nt = 'CD8+ T') AS n, avg(d * 0.5) FILTER (nt = 'CD8+ T') AS m, median(d) FILTER (nt = 'CD8+ T') * 0.5 AS md FROM pr WHERE k <= 10 AND d < 25 GROUP BY 1), hc AS (SELECT tg.*, coalesce(n, 0) AS n, coalesce(n, 0) > 0 AS has, m, md FROM tg LEFT JOIN hy ON t = cell_id)"


@query("G23_hybrid_by_region", _AROUND + _HYBRID + f" SELECT lnp_region, lnp_call, count(*) AS n_target_cells, {r('avg(n)')} AS mean_n_cd8_neighbors, {r('avg(CASE WHEN has THEN 100.0 ELSE 0.0 END)')} AS pct_has_cd8_neighbor, {r('avg(m)')} AS mean_mean_cd8_distance_um, {r('median(m)')} AS median_mean_cd8_distance_um, {r('avg(md)')} AS mean_median_cd8_distance_um, {r('median(md)')} AS median_median_cd8_distance_um FROM hc GROUP BY 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    return _around(spark, d).hybrid_by_region


@query("G23_metrics_by_region", _AROUND + _HYBRID + f" SELECT lnp_region, lnp_call, count(*) AS n_targets, {r('avg(CD86)')} AS mean_cd86, {r('avg(n)')} AS mean_n_cd8_neighbors, count(*) FILTER (has) AS n_with_cd8_neighbor, {r('avg(m)')} AS mean_cd8_distance_um, {r('median(md)')} AS median_cd8_distance_um, {r('100.0 * count(*) FILTER (has) / count(*)')} AS pct_with_cd8_neighbor FROM hc GROUP BY 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    return _around(spark, d).metrics_by_region


@query("G23_composition_by_region", _AROUND + f", sz AS (SELECT lnp_region, lnp_call, count(*) AS n FROM tg GROUP BY 1, 2), fr AS (SELECT lnp_region, lnp_call, t, nt, count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY t) AS f FROM pr WHERE k <= 10 GROUP BY 1, 2, 3, 4) SELECT lnp_region, lnp_call, nt AS cell_type, {r('100 * sum(f) / any_value(n)')} AS mean_pct FROM fr JOIN sz USING (lnp_region, lnp_call) GROUP BY 1, 2, 3")
def _(spark: SparkSession, d: str) -> DataFrame:
    return _around(spark, d).composition_around()


@query("G23_abundance_by_region", _AROUND + f" SELECT lnp_region, lnp_call, quarter, count(*) AS n_cells, {r('100.0 * count(*) / sum(count(*)) OVER (PARTITION BY lnp_region, lnp_call)')} AS pct FROM tg GROUP BY 1, 2, 3")
def _(spark: SparkSession, d: str) -> DataFrame:
    return _around(spark, d).abundance()


_EXTRA = {"FOXP3": "cast(cell_id * 29 % 83 as double)", "CD19": "cast(cell_id * 31 % 89 as double)", "CD138": "cast(cell_id * 37 % 97 as double)", "CD25": "cast(cell_id * 41 % 79 as double)"}


def _paired_panels(spark: SparkSession, d: str) -> DataFrame:
    c = E.gate_peptide(E.gate_genes(cells(spark, d)))
    return X.paired_panels(c.withColumns({m: F.expr(e) for m, e in _EXTRA.items()}))


@query("G23_around_tests")
def _(spark: SparkSession, d: str) -> DataFrame:
    section = _around(spark, d)
    return section.hybrid_tests().unionByName(section.metrics_tests())


@query("G27_paired_panels")
def _(spark: SparkSession, d: str) -> DataFrame:
    return _paired_panels(spark, d)


_PANELS = (
    _AROUND
    + _HYBRID
    + ", ex AS (SELECT *, "
    + ", ".join(f"{e} AS {m}" for m, e in _EXTRA.items())
    + " FROM gated)"
    + "".join(
        f""", p{k} AS (SELECT a.lnp_call, a.cell_id AS t, b.cell_id AS n, {_NEAR} AS d, row_number() OVER (PARTITION BY a.cell_id ORDER BY {_NEAR}, b.cell_id) AS k FROM ex a JOIN ex b ON a.lnp_region = b.lnp_region AND b.cell_type = 'CD4+ T' AND a.cell_id <> b.cell_id WHERE a.lnp_positive AND a.ova_pos AND a.cell_type = '{kind}'),
u{k} AS (SELECT * FROM p{k} WHERE k <= 10 AND d < 25 QUALIFY row_number() OVER (PARTITION BY n ORDER BY d, t) = 1)"""
        for k, kind in (("d", "DC"), ("b", "B"))
    )
    + """, pv AS (SELECT 'mean_cd86_siinfekl_positive_dc' AS panel, lnp_region, lnp_call, avg(CD86) AS v FROM tg WHERE condition = 'LNP' GROUP BY ALL
UNION ALL SELECT 'median_cd8_distance', lnp_region, lnp_call, median(md) FROM hc GROUP BY ALL
UNION ALL SELECT 'pct_cd8_presence', lnp_region, lnp_call, avg(CASE WHEN has THEN 100.0 ELSE 0.0 END) FROM hc GROUP BY ALL
UNION ALL SELECT 'cd4_foxp3_median', e.lnp_region, u.lnp_call, median(FOXP3) FROM ud u JOIN ex e ON e.cell_id = u.n GROUP BY ALL
UNION ALL SELECT 'surrounding_cd4_foxp3_median', e.lnp_region, u.lnp_call, median(FOXP3) FROM ub u JOIN ex e ON e.cell_id = u.n GROUP BY ALL"""
    + "".join(f"\nUNION ALL SELECT 'ova_b_{m.lower()}_median', lnp_region, lnp_call, median({m}) FROM ex WHERE lnp_positive AND ova_pos AND cell_type = 'B' GROUP BY ALL" for m in ("CD19", "CD138", "CD25"))
    + f"""), w AS (SELECT panel, lnp_region, max(v) FILTER (lnp_call = 'LNP_08') AS a, max(v) FILTER (lnp_call = 'LNP_10') AS b FROM pv GROUP BY 1, 2 HAVING a IS NOT NULL AND b IS NOT NULL)
SELECT panel, count(*) AS n, {r("CASE WHEN count(*) >= 2 AND stddev_samp(a - b) > 0 THEN avg(a - b) * sqrt(count(*)) / stddev_samp(a - b) END")} AS t FROM w GROUP BY 1"""
)


@query("G27_panel_statistics", _PANELS)
def _(spark: SparkSession, d: str) -> DataFrame:
    out = _paired_panels(spark, d).where("test = 'paired_t' AND n > 0")
    return out.select("panel", "n", F.when(F.abs("statistic") < float("inf"), F.col("statistic")).alias("t"))


@query("S1_csv_round_trip", with_(CELLS) + f"SELECT lnp_region, count(*) AS n, {r('avg(x)')} AS mean_x FROM cells GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    from uuid import uuid4

    path = f"{shared_folder(spark)}/csv-{uuid4().hex}"  # an earlier result may still read its own
    files.write_csv(cells(spark, d).select("cell_id", "lnp_region", "x"), path)
    return files.read_csv(spark, path, "cell_id bigint, lnp_region string, x double").groupBy("lnp_region").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean_x"))


@query("S5_load_batches", with_(CELLS) + "SELECT batch, count(*) AS n, count(CD86) AS n_cd86, count(DISTINCT id) AS n_ids FROM (SELECT 'first' AS batch, CD86, cell_id || '__first' AS id FROM cells WHERE lnp_region <> 'S2_reg004' AND cell_id % 2 = 0 UNION ALL SELECT 'second', NULL, cell_id || '__second' FROM cells WHERE lnp_region <> 'S2_reg004') GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    both = files.load_batches({"first": c.where("cell_id % 2 = 0"), "second": c.drop("CD86")}, LNP_REGIONS)
    return both.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.count("CD86").alias("n_cd86"), F.countDistinct("cell_id").alias("n_ids"))


@query("S10_unfinished_tiles", with_(CELLS) + "SELECT lnp_region, count(*) AS n FROM cells WHERE lnp_region NOT IN ('S1_reg000', 'S1_reg001') GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    from uuid import uuid4

    c, path = cells(spark, d), f"{shared_folder(spark)}/tiles-{uuid4().hex}"
    done = c.where("lnp_region IN ('S1_reg000', 'S1_reg001')")
    files.write_tiles(done.groupBy("lnp_region").agg(F.count(F.lit(1)).alias("n")), path, ["lnp_region"], done)
    return files.unfinished(spark, c, path, ["lnp_region"]).groupBy("lnp_region").agg(F.count(F.lit(1)).alias("n"))


@query("J1_left_join", "SELECT o_orderkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def _(spark: SparkSession, d: str) -> DataFrame:
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    return o.select("o_orderkey", F.col("o_custkey").alias("c_custkey")).join(c.select("c_custkey", "c_mktsegment"), "c_custkey", "left").select("o_orderkey", "c_mktsegment")


@query("J8_semi_join", "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left_semi").select("doc_id", "source")


@query("P2_region_key", with_(CELLS) + "SELECT lnp_region AS k, count(*) AS n FROM cells GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d).select(F.concat(F.lit("run_registered_x_registered_"), F.substring("lnp_region", 1, 2)).alias("slide"), F.substring("lnp_region", 4, 6).alias("region"))
    return c.groupBy(region_key("slide", "region").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("P10_pool_types", "SELECT CASE WHEN lower(trim(p_type)) LIKE '%epithelial%' THEN 'Epithelial' ELSE trim(p_type) END AS pooled, count(*) AS n FROM part GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy(pool_cell_type("p_type").alias("pooled")).agg(F.count(F.lit(1)).alias("n"))


@query("P14_where", with_(CELLS) + "SELECT cell_id FROM cells WHERE lnp_positive AND CD86 > 50 AND cell_type IN ('B', 'DC')")
def _(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).where("lnp_positive AND CD86 > 50 AND cell_type IN ('B', 'DC')").select("cell_id")


@query("R3_melt", with_(CELLS, "l AS (" + " UNION ALL ".join(f"SELECT cell_type, '{m}' AS marker, {m} AS v FROM cells" for m in _MARKERS) + ")") + f"SELECT cell_type, marker, {r('avg(v)')} AS mean FROM l GROUP BY 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    return melt(cells(spark, d), ["cell_type"], _MARKERS, "marker", "v").groupBy("cell_type", "marker").agg(F.avg("v").alias("mean"))


@query("R4_cross_table", with_(CELLS) + f"SELECT cell_type, lnp_positive, count(*) AS n, {r('100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY lnp_positive)')} AS pct FROM cells GROUP BY 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    return cross_share(cells(spark, d), "cell_type", "lnp_positive")


@query("R5_one_hot", with_(CELLS) + "SELECT cell_id, " + ", ".join(f"CASE WHEN cell_type = '{k}' THEN 1 ELSE 0 END AS is_{i}" for i, k in enumerate(KINDS)) + " FROM cells")
def _(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).select("cell_id", *[(F.col("cell_type") == k).cast("int").alias(f"is_{i}") for i, k in enumerate(KINDS)])


@query("A7_normalised_counts", with_(CELLS) + f"SELECT cell_type, count(*) AS n, {r('100.0::DOUBLE * count(*) / sum(count(*)) OVER ()')} AS pct FROM cells GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return share(cells(spark, d).groupBy("cell_type").agg(F.count(F.lit(1)).alias("n")), "n", [], "pct")


@query("U2_union_columns", "SELECT count(*) AS n, count(c_name) AS n_c, count(s_name) AS n_s FROM (SELECT c_name, NULL AS s_name FROM customer UNION ALL SELECT NULL, s_name FROM supplier)")
def _(spark: SparkSession, d: str) -> DataFrame:
    both = union_columns(table(spark, d, "customer").select("c_name"), table(spark, d, "supplier").select("s_name"))
    return both.agg(F.count(F.lit(1)).alias("n"), F.count("c_name").alias("n_c"), F.count("s_name").alias("n_s"))


@query("F4_hamming", "SELECT DISTINCT lpad(bin(l_partkey % 4096), 12, '0') AS code, CAST(hamming(lpad(bin(l_partkey % 4096), 12, '0'), '101001100011') AS INT) AS distance FROM lineitem")
def _(spark: SparkSession, d: str) -> DataFrame:
    code = F.lpad(F.bin(F.col("l_partkey") % 4096), 12, "0")
    return table(spark, d, "lineitem").select(code.alias("code")).distinct().withColumn("distance", F.bit_count(D.bits(F.col("code")).bitwiseXOR(F.lit(int(D.CODES[0], 2)))).cast("int"))


@query("F8_sha256", "SELECT doc_id, sha256(text) AS digest FROM documents")
def _(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))


@query("F6_p_text", "SELECT CASE WHEN l_discount = 0 THEN 'P = NA' WHEN l_discount / 100 < 0.0002 THEN 'P < 0.0001' ELSE printf('P = %.3f', l_discount::DOUBLE) END AS p_text, count(*) AS n FROM lineitem GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    p = F.when(F.col("l_discount") / 100 < 0.0002, F.col("l_discount") * 0.0).otherwise(F.col("l_discount").cast("double"))
    rows = table(spark, d, "lineitem").select(F.when(F.col("l_discount") > 0, p).alias("p"))
    return rows.groupBy(S.p_text("p").alias("p_text")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "K3_best_threshold",
    "WITH h AS (SELECT l_suppkey % 3 AS g, l_quantity AS v FROM lineitem), t AS (SELECT unnest([10.0, 20.0, 30.0, 40.0]::DOUBLE[]) AS t), c AS (SELECT t, count(*) FILTER (g = 0 AND v > t)::DOUBLE AS n, count(*) FILTER (g <> 0 AND v > t) / 2.0::DOUBLE AS p FROM h, t GROUP BY 1) "
    "SELECT t AS threshold FROM c ORDER BY coalesce(p / nullif(n, 0), 0) + CASE WHEN n <= 3 AND p >= 0.5 THEN 1000 ELSE 0 END DESC, t LIMIT 1",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    hits = table(spark, d, "lineitem").select(F.when(F.col("l_suppkey") % 3 == 0, "negative").otherwise("positive").alias("field"), F.col("l_quantity").cast("double").alias("v"))
    return D.best_threshold(D.threshold_table(hits, (10.0, 20.0, 30.0, 40.0), "v", (1.0, 2.0), True))


@query("W5_lag_change", with_(CELLS, "n AS (SELECT lnp_region, count(*) AS n FROM cells GROUP BY 1)") + f"SELECT lnp_region, n, {r('100.0::DOUBLE * (n - lag(n) OVER (ORDER BY lnp_region)) / lag(n) OVER (ORDER BY lnp_region)')} AS change FROM n")
def _(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window as W

    n = cells(spark, d).groupBy("lnp_region").agg(F.count(F.lit(1)).alias("n"))
    before = F.lag("n").over(W.orderBy("lnp_region"))
    return n.withColumn("change", percent(F.col("n") - before, before))


@query("C7_argmax_type", with_(CELLS, "n AS (SELECT lnp_region, cell_type, count(*) AS n FROM cells GROUP BY 1, 2)") + "SELECT lnp_region, cell_type FROM n QUALIFY row_number() OVER (PARTITION BY lnp_region ORDER BY n DESC, cell_type) = 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    n = cells(spark, d).groupBy("lnp_region", "cell_type").agg(F.count(F.lit(1)).alias("n"))
    return C.top_one(n, ["lnp_region"], F.desc("n"), F.asc("cell_type")).select("lnp_region", "cell_type")
