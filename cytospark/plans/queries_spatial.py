"""Queries of neighbours, neighbourhoods and paired tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats as S
from ..functions.columns import positive_subset, rounded
from ..operators import cluster as C
from ..operators import neighbors as N
from ..operators.relational import pivot_unique
from ..operators.spatial import keep_nearest, knn_pairs, nearest_within, radius_pairs
from ..sources.cells import cells
from ..sources.scratch import materialize
from .expression import gate_genes
from .sql import CELLS, GATES, r, with_

QUERIES, ORACLES = {}, {}
KINDS = ("B", "CD4+ T", "CD8+ T", "DC", "Macrophage")
PAIR = ("LNP_08", "LNP_10")


def query(name: str, sql: str | None = None):
    """Registers a query, rounded, with its SQL."""

    def add(f):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return f

    return add


def pairs_sql(targets: str, pool: str = "true", other: bool = True) -> str:
    """All pairs of a region with their rank: (t, n, nt, d, k)."""
    return f"""pr AS (SELECT a.lnp_region, a.cell_id AS t, b.cell_id AS n, b.cell_type AS nt, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d, row_number() OVER (PARTITION BY a.cell_id ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), b.cell_id) AS k
FROM (SELECT * FROM cells WHERE {targets}) a JOIN (SELECT * FROM cells WHERE {pool}) b ON a.lnp_region = b.lnp_region {"AND a.cell_id <> b.cell_id" if other else ""})"""


_DC = "lnp_positive AND cell_type = 'DC'"


def dcs(c: DataFrame) -> DataFrame:
    return c.where(positive_subset([f"LNP_{i:02d}" for i in range(1, 11)], "DC"))


@query("J9_radius_join", with_(CELLS, pairs_sql("cell_type = 'DC'", "cell_type = 'CD8+ T'")) + f"SELECT lnp_region, t AS target_id, n AS neighbor_id, {r('d')} AS distance FROM pr WHERE d <= 25")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    return radius_pairs(c.where("cell_type = 'DC'"), c.where("cell_type = 'CD8+ T'"), 25.0)


@query("J10_knn_join", with_(CELLS, pairs_sql("true")) + f"SELECT lnp_region, t AS target_id, n AS neighbor_id, CAST(k AS INT) AS rank, {r('d')} AS distance FROM pr WHERE k <= 10")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    return knn_pairs(c, c, 10)


@query("J12_nearest_within", with_(CELLS, pairs_sql("cell_type = 'DC'", "cell_type = 'CD8+ T'")) + f"SELECT lnp_region, t AS target_id, n AS neighbor_id, {r('d')} AS distance FROM pr WHERE k = 1 AND d < 30")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    return nearest_within(c.where("cell_type = 'DC'"), c.where("cell_type = 'CD8+ T'"), 30.0)


@query("N1_knn_window", with_(CELLS, pairs_sql("true", other=False)) + "SELECT t AS cell_id, nt AS cell_type, count(*) AS n FROM pr WHERE k <= 10 GROUP BY 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    return N.knn_window(cells(spark, d))


@query("N2_neighbor_composition", with_(CELLS, pairs_sql("true")) + f"SELECT t AS cell_id, nt AS cell_type, {r('count(*) / sum(count(*)) OVER (PARTITION BY t)')} AS fraction FROM pr WHERE k <= 10 GROUP BY 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    return N.neighbor_composition(cells(spark, d))


@query("N2_mean_neighbor_distance", with_(CELLS, pairs_sql("true")) + f"SELECT t AS cell_id, {r('avg(d)')} AS mean_distance FROM pr WHERE k <= 10 GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return N.mean_neighbor_distance(cells(spark, d))


@query("N3_positional_exclusion", with_(CELLS, pairs_sql("true", other=False)) + f"SELECT t AS cell_id, nt AS cell_type, {r('count(*) / sum(count(*)) OVER (PARTITION BY t)')} AS fraction FROM pr WHERE k BETWEEN 2 AND 11 GROUP BY 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    return N.neighbor_composition(cells(spark, d), by_id=False)


_KS = (3, 5, 8, 10, 15, 20, 25)
_MULTI = ", ".join(f"count_if(k <= {k} AND nt = 'CD8+ T') AS n_cd8_neighbors_k{k}, {r(f'avg(d) FILTER (k <= {k} AND nt = ' + repr('CD8+ T') + ') * 0.5')} AS mean_cd8_distance_um_k{k}, count_if(k <= {k} AND nt = 'CD8+ T') > 0 AS has_cd8_neighbor_k{k}" for k in _KS)


@query("N4_multiscale_metrics", with_(CELLS, pairs_sql(_DC)) + f"SELECT t AS cell_id, {_MULTI} FROM pr GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    return N.multiscale_metrics(dcs(c), c, "CD8+ T", _KS, "cd8")


_RS = (15.0, 20.0, 25.0, 30.0)
_RADII = ", ".join(f"count_if(d <= {x}) AS n_cd8_within_r{x:g}, {r(f'avg(d) FILTER (d <= {x}) * 0.5')} AS mean_cd8_distance_um_r{x:g}, count_if(d <= {x}) > 0 AS has_cd8_within_r{x:g}" for x in _RS)


@query("N5_radius_metrics", with_(CELLS, pairs_sql(_DC, "cell_type = 'CD8+ T'")) + f"SELECT t AS cell_id, {_RADII} FROM pr GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    return N.radius_metrics(dcs(c), c, "CD8+ T", _RS, "cd8")


_HYBRID = f"""SELECT t AS cell_id, count_if(k <= 10 AND d < 25) AS n_retained_neighbors, count_if(k <= 10 AND d < 25 AND nt = 'CD8+ T') AS n_cd8_neighbors, avg(d) FILTER (k <= 10 AND d < 25 AND nt = 'CD8+ T') * 0.5 AS mean_cd8_distance_um,
median(d) FILTER (k <= 10 AND d < 25 AND nt = 'CD8+ T') * 0.5 AS median_cd8_distance_um, count_if(k <= 10 AND d < 25 AND nt = 'CD8+ T') > 0 AS has_cd8_neighbor FROM pr GROUP BY 1"""


@query("N6_hybrid_metrics", with_(CELLS, pairs_sql(_DC), f"h AS ({_HYBRID})") + f"SELECT * REPLACE ({r('mean_cd8_distance_um')} AS mean_cd8_distance_um, {r('median_cd8_distance_um')} AS median_cd8_distance_um) FROM h")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    return N.hybrid_metrics(dcs(c), c, "CD8+ T", 10, 25.0, "cd8")


_PAIRS = with_(CELLS, pairs_sql(_DC, "cell_type = 'CD8+ T'"), "q AS (SELECT pr.lnp_region, c.lnp_call, t, n, d FROM pr JOIN cells c ON c.cell_id = t WHERE k <= 10 AND d < 25)", "u AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY n ORDER BY d, t) = 1)")


def _dc_pairs(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    return N.neighbor_pairs(dcs(c), c, "CD8+ T")


@query("N7_neighbor_pairs", _PAIRS + f"SELECT lnp_region, lnp_call, t AS target_id, n AS neighbor_id, {r('d')} AS distance, {r('d * 0.5')} AS distance_um FROM q")
def _(spark: SparkSession, d: str) -> DataFrame:
    return _dc_pairs(spark, d)


@query("N8_keep_nearest_pairs", _PAIRS + f"SELECT lnp_region, lnp_call, t AS target_id, n AS neighbor_id, {r('d')} AS distance, {r('d * 0.5')} AS distance_um FROM u")
def _(spark: SparkSession, d: str) -> DataFrame:
    return keep_nearest(_dc_pairs(spark, d))


_MARKERS = ("Fluc", "OVA", "SIINFEKL", "CD86")
_LONG = " UNION ALL ".join(f"SELECT lnp_region, lnp_call, '{m}' AS marker, {m} AS v FROM {{}}" for m in _MARKERS)


@query("N9_own_state", with_(CELLS, f"l AS ({_LONG.format(*['cells WHERE ' + _DC] * 4)})") + f"SELECT lnp_region, lnp_call, marker, {r('avg(v)')} AS mean, {r('median(v)')} AS median, count(*) AS n_cells FROM l GROUP BY 1, 2, 3")
def _(spark: SparkSession, d: str) -> DataFrame:
    return N.own_state(dcs(cells(spark, d)), _MARKERS, ["lnp_region", "lnp_call"])


@query("N10_neighbor_state", _PAIRS.rstrip() + f", w AS (SELECT c.lnp_region, u.lnp_call, Fluc, OVA, SIINFEKL, CD86 FROM u JOIN cells c ON c.cell_id = n), l AS ({_LONG.format(*['w'] * 4)}) SELECT lnp_region, lnp_call, marker, {r('avg(v)')} AS mean, {r('median(v)')} AS median, count(*) AS n_unique_neighbors FROM l GROUP BY 1, 2, 3")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    return N.neighbor_state(_dc_pairs(spark, d), c, _MARKERS, ["lnp_region", "lnp_call"])


def _hybrid_regions(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    per_cell = N.hybrid_metrics(dcs(c), c, "CD8+ T", 10, 25.0, "cd8").join(c.select("cell_id", "lnp_region", "lnp_call"), "cell_id")
    return N.region_metrics(per_cell, ["lnp_region", "lnp_call"], ["n_cd8_neighbors"], ["has_cd8_neighbor"], ["mean_cd8_distance_um"])


_REGION = with_(
    CELLS,
    pairs_sql(_DC),
    f"h AS ({_HYBRID})",
    """m AS (SELECT lnp_region, lnp_call, count(*) AS n_target_cells, avg(n_cd8_neighbors) AS mean_n_cd8_neighbors, 100.0 * avg(CAST(has_cd8_neighbor AS INT)) AS pct_has_cd8_neighbor, avg(mean_cd8_distance_um) AS mean_mean_cd8_distance_um,
median(mean_cd8_distance_um) AS median_mean_cd8_distance_um FROM h JOIN cells USING (cell_id) GROUP BY 1, 2)""",
)


@query("N11_region_metrics", _REGION + "SELECT lnp_region, lnp_call, n_target_cells, " + ", ".join(f"{r(c)} AS {c}" for c in ("mean_n_cd8_neighbors", "pct_has_cd8_neighbor", "mean_mean_cd8_distance_um", "median_mean_cd8_distance_um")) + " FROM m")
def _(spark: SparkSession, d: str) -> DataFrame:
    return _hybrid_regions(spark, d)


_T = """tt AS (SELECT count(*) AS n_regions, avg(a) AS mean_a, avg(b) AS mean_b, avg(a - b) AS m, stddev_samp(a - b) AS s FROM w)"""


def _t_sql(metric: str) -> str:
    return (
        f", w AS (SELECT lnp_region, max({metric}) FILTER (lnp_call = 'LNP_08') AS a, max({metric}) FILTER (lnp_call = 'LNP_10') AS b FROM m WHERE lnp_call IN ('LNP_08', 'LNP_10') GROUP BY 1 HAVING a IS NOT NULL AND b IS NOT NULL), {_T} "
        f"SELECT n_regions, CASE WHEN n_regions >= 2 THEN n_regions - 1 END AS df, {r('CASE WHEN n_regions >= 2 AND s > 0 THEN m * sqrt(n_regions) / s END')} AS t, {r('mean_a')} AS mean_a, {r('mean_b')} AS mean_b FROM tt"
    )


@query("F9_paired_t", _REGION.rstrip() + _t_sql("mean_n_cd8_neighbors"))
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.paired_t(_hybrid_regions(spark, d), "lnp_call", PAIR, "mean_n_cd8_neighbors")


@query("F9_paired_t_test")
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.paired_t_test(_hybrid_regions(spark, d), "lnp_call", PAIR, "mean_n_cd8_neighbors", side="greater")


_STATE = with_(CELLS, "m AS (SELECT lnp_region, lnp_call, avg(CD86) AS v FROM cells WHERE lnp_positive GROUP BY 1, 2)")


def _cd86(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).where("lnp_positive").groupBy("lnp_region", "lnp_call").agg(F.avg("CD86").alias("v"))


@query(
    "F10_signed_rank",
    _STATE.rstrip()
    + f""", w AS (SELECT lnp_region, max(v) FILTER (lnp_call = 'LNP_08') AS a, max(v) FILTER (lnp_call = 'LNP_10') AS b FROM m GROUP BY 1), e AS (SELECT round(a - b, 9) AS d FROM w WHERE a IS NOT NULL AND b IS NOT NULL AND round(a - b, 9) <> 0),
k AS (SELECT d, count(*) OVER (PARTITION BY abs(d)) AS c, rank() OVER (ORDER BY abs(d)) + (count(*) OVER (PARTITION BY abs(d)) - 1) / 2.0::DOUBLE AS rk FROM e)
SELECT count(*) AS n, {r("least(coalesce(sum(rk) FILTER (d > 0), 0), coalesce(sum(rk) FILTER (d < 0), 0))")} AS w, {r("sum(c * c - 1)")} AS ties, sum(c * c - 1) > 0 AS has_ties FROM k""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.signed_rank(_cd86(spark, d), "lnp_call", PAIR, "v")


@query("F10_signed_rank_test")
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.signed_rank_test(_cd86(spark, d), "lnp_call", PAIR, "v")


@query("F11_spearman", with_(CELLS, "k AS (SELECT lnp_region, rank() OVER (PARTITION BY lnp_region ORDER BY CD86) + (count(*) OVER (PARTITION BY lnp_region, CD86) - 1) / 2.0::DOUBLE AS a, rank() OVER (PARTITION BY lnp_region ORDER BY Fluc) + (count(*) OVER (PARTITION BY lnp_region, Fluc) - 1) / 2.0::DOUBLE AS b FROM cells WHERE Fluc IS NOT NULL)") + f"SELECT lnp_region, count(*) AS n, {r('corr(a, b)')} AS rho FROM k GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.spearman(cells(spark, d), "CD86", "Fluc", ["lnp_region"])


@query("F12_pearson", with_(CELLS) + f"SELECT lnp_region, count(*) AS n, {r('corr(x, y)')} AS r FROM cells GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.pearson(cells(spark, d), "x", "y", ["lnp_region"])


# assignments to fixed centroids, so that SQL can follow
CENTROIDS = ((0.41, 0.17, 0.13, 0.14, 0.15), (0.12, 0.43, 0.16, 0.13, 0.16), (0.11, 0.14, 0.44, 0.17, 0.14), (0.16, 0.13, 0.11, 0.16, 0.44))


def _assigned(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    rows = N.composition_array(c, KINDS)
    return materialize(C.assign(rows, CENTROIDS).join(c.drop("x", "y"), "cell_id"), "assigned")


_ASSIGNED = with_(
    CELLS,
    GATES,
    pairs_sql("true"),
    "f AS (SELECT t AS cell_id, " + ", ".join(f"count_if(nt = '{k}') / 10.0::DOUBLE AS f{i}" for i, k in enumerate(KINDS)) + " FROM pr WHERE k <= 10 GROUP BY 1)",
    "cost AS (SELECT *, " + ", ".join(" + ".join(f"(f{i} - {v}::DOUBLE) * (f{i} - {v}::DOUBLE)" for i, v in enumerate(c)) + f" AS q{j}" for j, c in enumerate(CENTROIDS)) + " FROM f)",
    "asg AS (SELECT cost.*, " + f"CASE least({', '.join(f'q{j}' for j in range(4))}) WHEN q0 THEN 0 WHEN q1 THEN 1 WHEN q2 THEN 2 ELSE 3 END AS cluster, least({', '.join(f'q{j}' for j in range(4))}) AS q FROM cost)",
    "ac AS (SELECT * FROM asg JOIN cells USING (cell_id))",
    "sz AS (SELECT c.cluster, count(cell_id) AS n FROM (SELECT unnest([0, 1, 2, 3]) AS cluster) c LEFT JOIN asg ON asg.cluster = c.cluster GROUP BY 1)",
    "mn AS (" + " UNION ALL ".join(f"SELECT cluster, '{k}' AS cell_type, avg(f{i}) AS mean FROM asg GROUP BY 1" for i, k in enumerate(KINDS)) + ")",
    "pc AS (SELECT *, 100.0::DOUBLE * mean / sum(mean) OVER (PARTITION BY cluster) AS pct FROM mn)",
    "rn AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY pct DESC, cell_type) AS k FROM pc)",
    "nm AS (SELECT cluster, cell_type || ' enriched' AS name FROM rn WHERE k = 1)",
    "mg AS (SELECT name, cell_type, coalesce(sum(pct * n) / nullif(sum(n), 0), 0) AS pct FROM pc JOIN nm USING (cluster) JOIN sz USING (cluster) GROUP BY 1, 2)",
    "an AS (SELECT ac.*, name FROM ac JOIN nm USING (cluster))",
)


@query("C2_assign", _ASSIGNED + f"SELECT cell_id, CAST(cluster AS INT) AS cluster, {r('q')} AS distance2 FROM asg")
def _(spark: SparkSession, d: str) -> DataFrame:
    return _assigned(spark, d).select("cell_id", "cluster", "distance2")


@query("C4_composition_percent", _ASSIGNED + f"SELECT CAST(cluster AS INT) AS cluster, cell_type, {r('mean')} AS mean, {r('pct')} AS pct FROM pc")
def _(spark: SparkSession, d: str) -> DataFrame:
    return _means(spark, d)


def _pct(assigned: DataFrame) -> DataFrame:
    return C.composition_percent(C.cluster_means(assigned, KINDS))


def _means(spark: SparkSession, d: str) -> DataFrame:
    return _pct(_assigned(spark, d))


@query("C5_fold_change", _ASSIGNED.rstrip() + ", b AS (SELECT cell_type, count(*) / sum(count(*)) OVER () AS b FROM cells GROUP BY 1), v AS (SELECT cluster, cell_type, b, (mean + b) / sum(mean + b) OVER (PARTITION BY cluster) / b AS v FROM mn JOIN b USING (cell_type)) " + f"SELECT CAST(cluster AS INT) AS cluster, cell_type, {r('log2(v)')} AS log2_fold_change FROM v")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    background = C.share(c.groupBy("cell_type").agg(F.count(F.lit(1)).alias("n")), "n", [], "p").select("cell_type", (F.col("p") / 100).alias("b"))
    return C.fold_change(C.cluster_means(_assigned(spark, d), KINDS), background)


@query("C6_cluster_sizes", _ASSIGNED + f"SELECT CAST(cluster AS INT) AS cluster, n AS n_cells, {r('100.0::DOUBLE * n / sum(n) OVER ()')} AS pct_cells FROM sz")
def _(spark: SparkSession, d: str) -> DataFrame:
    return C.sizes(_assigned(spark, d), 4)


@query("C7_dominant_names", _ASSIGNED + "SELECT CAST(cluster AS INT) AS cluster, name FROM nm")
def _(spark: SparkSession, d: str) -> DataFrame:
    return C.dominant_names(_means(spark, d))


@query("C8_ranked_names", _ASSIGNED + "SELECT CAST(cluster AS INT) AS cluster, CASE WHEN cluster = 2 THEN 'Killer zone' ELSE printf('N%02d: ', cluster + 1) || string_agg(cell_type, ' + ' ORDER BY k) || '-rich' END AS name FROM rn WHERE k <= 2 GROUP BY cluster")
def _(spark: SparkSession, d: str) -> DataFrame:
    return C.ranked_names(_means(spark, d), {2: "Killer zone", 1: ""})


@query("C9_merge_named", _ASSIGNED + f"SELECT name, cell_type, {r('pct')} AS pct FROM mg")
def _(spark: SparkSession, d: str) -> DataFrame:
    a = _assigned(spark, d)
    return C.merge_named(_pct(a), C.dominant_names(_pct(a)), C.sizes(a, 4))


@query("K5_names_by_size", _ASSIGNED + "SELECT name, CAST(sum(n) AS BIGINT) AS n_cells, CAST(row_number() OVER (ORDER BY sum(n) DESC, min(cluster)) AS INT) AS place FROM nm JOIN sz USING (cluster) GROUP BY name")
def _(spark: SparkSession, d: str) -> DataFrame:
    a = _assigned(spark, d)
    return C.names_by_size(C.dominant_names(_pct(a)), C.sizes(a, 4))


@query("C10_tissue_enrichment", _ASSIGNED.rstrip() + f", ts AS (SELECT cell_type, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS p FROM cells GROUP BY 1) SELECT name, cell_type, {r('log2(pct / p)')} AS log2_enrichment FROM mg JOIN ts USING (cell_type) WHERE pct > 0")
def _(spark: SparkSession, d: str) -> DataFrame:
    a = _assigned(spark, d)
    named = C.merge_named(_pct(a), C.dominant_names(_pct(a)), C.sizes(a, 4))
    return C.tissue_enrichment(named.where("pct > 0"), cells(spark, d))


@query("C11_abundance_difference", _ASSIGNED + f"SELECT name, {r('100.0::DOUBLE * count_if(NOT lnp_positive) / (SELECT count_if(NOT lnp_positive) FROM an)')} AS pct_negative, {r('100.0::DOUBLE * count_if(lnp_positive) / (SELECT count_if(lnp_positive) FROM an)')} AS pct_positive, {r('100.0::DOUBLE * count_if(lnp_positive) / (SELECT count_if(lnp_positive) FROM an) - 100.0::DOUBLE * count_if(NOT lnp_positive) / (SELECT count_if(NOT lnp_positive) FROM an)')} AS difference FROM an GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return C.abundance_difference(_named(spark, d))


def _named(spark: SparkSession, d: str) -> DataFrame:
    a = _assigned(spark, d)
    return a.join(F.broadcast(C.dominant_names(_pct(a))), "cluster")


@query("N12_focused_composition", _ASSIGNED.rstrip() + ", z AS (" + " UNION ALL ".join(f"SELECT lnp_region, lnp_call, '{k}' AS cell_type, sum(f{i}) AS s, count(*) AS n FROM ac WHERE lnp_positive AND ac.cell_type = 'DC' GROUP BY 1, 2" for i, k in enumerate(KINDS)) + f") SELECT lnp_region, lnp_call, cell_type, {r('100.0::DOUBLE * s / n')} AS mean_pct FROM z WHERE s > 0")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    return N.focused_composition(dcs(c), N.neighbor_composition(c, targets=dcs(c)), ["lnp_region", "lnp_call"])


_DIST = f"SELECT lnp_call, name, count(*) AS n_cells, {r('100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY lnp_call)')} AS pct FROM an"


@query("N13_subset_distribution", _ASSIGNED + _DIST + " WHERE lnp_positive AND cell_type = 'DC' GROUP BY 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    return N.subset_distribution(dcs(_named(spark, d)), "lnp_call", "name")


@query("N14_positive_distribution", _ASSIGNED + _DIST + " WHERE lnp_positive GROUP BY 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    return N.subset_distribution(_named(spark, d).where("lnp_positive"), "lnp_call", "name")


@query("R1_distribution_wide", _ASSIGNED.rstrip() + f", di AS ({_DIST} WHERE lnp_positive GROUP BY 1, 2) SELECT name, {', '.join(f'max(pct) FILTER (lnp_call = {c!r}) AS {c}' for c in PAIR)} FROM di GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return pivot_unique(N.subset_distribution(_named(spark, d).where("lnp_positive"), "lnp_call", "name"), ["name"], "lnp_call", PAIR, "pct")


@query(
    "N15_local_enrichment",
    _ASSIGNED.rstrip()
    + ", z AS ("
    + " UNION ALL ".join(f"SELECT lnp_region, condition, '{k}' AS cell_type, avg(f{i}) FILTER (lnp_positive) AS p, avg(f{i}) FILTER (NOT lnp_positive) AS n, sum(f{i}) AS s FROM ac GROUP BY 1, 2" for i, k in enumerate(KINDS))
    + f") SELECT lnp_region, condition, cell_type, {r('p')} AS mean_positive, {r('n')} AS mean_negative, {r('log2((p + 0.0001::DOUBLE) / (n + 0.0001::DOUBLE))')} AS log2_enrichment FROM z WHERE s > 0",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    return N.local_enrichment(c, N.neighbor_composition(c))


@query("G26_gene_positive_neighborhoods", _ASSIGNED.rstrip() + f", ag AS (SELECT an.*, ova_pos FROM an JOIN gated USING (cell_id)) SELECT ag.lnp_region, ag.lnp_call, name, count(*) AS n_cells, {r('100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY ag.lnp_region, ag.lnp_call)')} AS pct FROM ag WHERE ag.lnp_positive AND ova_pos GROUP BY 1, 2, 3")
def _(spark: SparkSession, d: str) -> DataFrame:
    gated = gate_genes(cells(spark, d)).where("OVA_positive").select("cell_id")
    return N.subset_distribution(_named(spark, d).where("lnp_positive").join(gated, "cell_id", "left_semi"), "lnp_call", "name", ["lnp_region"])


@query("C1_fit_neighborhoods")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = N.composition_array(cells(spark, d), KINDS)
    centroids, _cost = C.fit_centroids(rows, 8)
    return C.sizes(C.assign(rows, centroids), 8)


@query("C3_elbow")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = N.composition_array(cells(spark, d), KINDS)
    return C.elbow(rows, (5, 8, 10, 12))


@query(
    "G24_target_metrics",
    with_(CELLS, GATES, pairs_sql("cell_id IN (SELECT cell_id FROM gated WHERE ova_pos) AND " + _DC, "cell_type = 'CD4+ T'"), "q AS (SELECT pr.lnp_region, c.lnp_call, t, n, d FROM pr JOIN cells c ON c.cell_id = t WHERE k <= 10 AND d < 25)")
    + f"SELECT lnp_region, lnp_call, t AS target_id, count(DISTINCT n) AS n_neighbors, {r('median(d * 0.5)')} AS median_distance_um FROM q GROUP BY 1, 2, 3",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    c = gate_genes(cells(spark, d))
    pairs = N.neighbor_pairs(dcs(c).where("OVA_positive"), c, "CD4+ T")
    return pairs.groupBy("lnp_region", "lnp_call", "target_id").agg(F.countDistinct("neighbor_id").alias("n_neighbors"), F.median("distance_um").alias("median_distance_um"))


