"""Queries of spots, barcodes, images, files and contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..functions.order import quantiles
from ..operators import decode as D
from ..operators import imaging as I
from ..operators.relational import anti_count, dense_labels, merge_report, top_one, value_counts
from ..schemas import LNP_REGIONS
from ..sources import contracts, files
from ..sources.cells import cells, table
from ..sources.scratch import materialize
from .sql import CELLS, r, with_

QUERIES, ORACLES = {}, {}
HEIGHT = WIDTH = 96
BY = ["fov"]


def query(name: str, sql: str | None = None):
    """Registers a query, rounded, with its SQL."""

    def add(f):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return f

    return add


#: Orders of an image; each image has three channels, and each channel of an image is a field, so that fields grow in number with the table.
ORDERS, CHANNELS = 15_000, 3
_PLACE = (f"cast(l_orderkey div {ORDERS} * {CHANNELS} + l_suppkey % {CHANNELS} as int) AS fov", "cast(l_orderkey % 96 as int) AS i", "cast(l_partkey % 96 as int) AS j")
_PLACE_SQL = f"CAST(l_orderkey // {ORDERS} * {CHANNELS} + l_suppkey % {CHANNELS} AS INT) AS fov, CAST(l_orderkey % 96 AS INT) AS i, CAST(l_partkey % 96 AS INT) AS j"


def pixels(spark: SparkSession, d: str) -> DataFrame:
    """Pixels of all fields, from order lines."""
    lines = table(spark, d, "lineitem").select(*map(F.expr, _PLACE), F.col("l_quantity").cast("double").alias("v"))
    return I.dense(lines.groupBy("fov", "i", "j").agg(F.sum("v").alias("v")), BY, HEIGHT, WIDTH)


_PIXELS = f"""px0 AS (SELECT {_PLACE_SQL}, sum(CAST(l_quantity AS DOUBLE)) AS v FROM lineitem GROUP BY 1, 2, 3),
px AS (SELECT f.fov, a.i, b.j, coalesce(v, 0) AS v FROM (SELECT DISTINCT fov FROM px0) f, (SELECT CAST(unnest(range(96)) AS INT) AS i) a, (SELECT CAST(unnest(range(96)) AS INT) AS j) b LEFT JOIN px0 ON px0.fov = f.fov AND px0.i = a.i AND px0.j = b.j)"""


def _mirror(x: str, n: int) -> str:
    return f"CASE WHEN {x} < 0 THEN -{x} - 1 WHEN {x} >= {n} THEN {2 * n - 1} - {x} ELSE {x} END"


def _plain(x: float) -> str:
    return repr(float(x))


def kernel_sql(sigma: float) -> str:
    g, s = I._kernels(sigma)
    half = len(g) // 2
    return "kn(di, dj, w) AS (VALUES " + ", ".join(f"({a - half}, {b - half}, {_plain(-(s[a] * g[b] + g[a] * s[b]))}::DOUBLE)" for a in range(len(g)) for b in range(len(g))) + ")"


_SCORED = with_(_PIXELS, kernel_sql(1.0), f"sp AS (SELECT fov, i, j, {_mirror('(i + di)', 96)} AS pi, {_mirror('(j + dj)', 96)} AS pj, w FROM px, kn)", "sc AS (SELECT sp.fov, sp.i, sp.j, sum(w * p.v) AS score FROM sp JOIN px p ON p.fov = sp.fov AND p.i = pi AND p.j = pj GROUP BY 1, 2, 3)")
_MAXIMA = ", mx AS (SELECT a.fov, a.i, a.j, any_value(a.score) AS score FROM sc a JOIN sc b ON a.fov = b.fov AND abs(a.i - b.i) <= 3 AND abs(a.j - b.j) <= 3 GROUP BY 1, 2, 3 HAVING max(b.score) = any_value(a.score))"


@query("I2_log_score", _SCORED + f"SELECT fov, CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, {r('score', 4)} AS score FROM sc")
def _(spark: SparkSession, d: str) -> DataFrame:
    return I.score_images(pixels(spark, d), BY).withColumn("score", F.round("score", 4))


@query("I4_log_candidates", _SCORED.rstrip() + _MAXIMA + f" SELECT fov, CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, {r('score', 4)} AS score FROM mx WHERE score > 5")
def _(spark: SparkSession, d: str) -> DataFrame:
    return I.log_candidates(pixels(spark, d), BY, 1.0, 7, 5.0).withColumn("score", F.round("score", 4))


@query("I5_suppress")
def _(spark: SparkSession, d: str) -> DataFrame:
    return I.suppress(I.log_candidates(pixels(spark, d), BY, 1.0, 7, 5.0), BY, 9.0).withColumn("score", F.round("score", 4))


@query("I6_detect_tiled")
def _(spark: SparkSession, d: str) -> DataFrame:
    return I.detect_tiled(pixels(spark, d), BY, HEIGHT, 4, 16, 1.0, 7, 5.0, 9.0).withColumn("score", F.round("score", 4))


@query("I1_bands", with_(_PIXELS, "t AS (SELECT unnest(range(4)) AS tile)") + "SELECT fov, CAST(tile AS INT) AS tile, count(*) AS n_pixels, count_if(least(i // 24, 3) = tile) AS n_core FROM px, t WHERE i BETWEEN tile * 24 - 16 AND CASE WHEN tile = 3 THEN 95 ELSE tile * 24 + 23 + 16 END GROUP BY 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    return I.bands(pixels(spark, d), HEIGHT, 4, 16).groupBy("fov", "tile").agg(F.count(F.lit(1)).alias("n_pixels"), F.count_if("core").alias("n_core"))


@query("I7_bright_points", with_(_PIXELS, "q AS (SELECT fov, quantile_cont(v, 0.98) AS t FROM px GROUP BY 1)") + f"SELECT a.fov, CAST(a.i AS BIGINT) AS i, CAST(a.j AS BIGINT) AS j, {r('any_value(a.v)')} AS score FROM px a JOIN q ON q.fov = a.fov JOIN px b ON a.fov = b.fov AND abs(a.i - b.i) <= 1 AND abs(a.j - b.j) <= 1 WHERE a.v > t GROUP BY 1, 2, 3 HAVING max(b.v) = any_value(a.v)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return I.bright_points(pixels(spark, d), BY)


_LABELS = """br AS (SELECT px.fov, i, j, v, i * 96 + j AS node FROM px JOIN th USING (fov) WHERE v > t),
ed AS (SELECT a.fov, a.node AS u, b.node AS w FROM br a JOIN br b ON a.fov = b.fov AND abs(a.i - b.i) + abs(a.j - b.j) <= 1),
cc(fov, u, w) AS (SELECT fov, u, w FROM ed UNION SELECT cc.fov, cc.u, ed.w FROM cc JOIN ed ON ed.fov = cc.fov AND ed.u = cc.w),
rt AS (SELECT fov, u AS node, min(w) AS root FROM cc GROUP BY 1, 2),
lb AS (SELECT br.*, dense_rank() OVER (PARTITION BY br.fov ORDER BY root) AS label FROM br JOIN rt ON rt.fov = br.fov AND rt.node = br.node)"""


def _labels(threshold: str) -> str:
    return "WITH RECURSIVE " + ",\n".join((_PIXELS, threshold, _LABELS)) + "\n"


_TOP = "th AS (SELECT fov, quantile_cont(v, 0.95) AS t FROM px GROUP BY 1)"


def _bright(spark: SparkSession, d: str) -> DataFrame:
    px = pixels(spark, d)
    cut = quantiles(px, BY, "v", [0.95]).select("fov", F.col("q0").alias("t"))
    return px.join(cut, "fov").where("v > t").drop("t")


@query("I12_components", _labels(_TOP) + "SELECT fov, i, j, CAST(label AS INT) AS label FROM lb")
def _(spark: SparkSession, d: str) -> DataFrame:
    return I.label_components(_bright(spark, d), BY, WIDTH)


@query("I8_blobs", _labels(_TOP) + "SELECT fov, CAST(label AS INT) AS label, CAST(round_even(sum(i * v) / sum(v), 0) AS BIGINT) AS i, CAST(round_even(sum(j * v) / sum(v), 0) AS BIGINT) AS j, count(*) AS area FROM lb GROUP BY 1, 2 HAVING count(*) BETWEEN 2 AND 400")
def _(spark: SparkSession, d: str) -> DataFrame:
    return I.blobs(pixels(spark, d), BY, WIDTH, 95.0, 2, 400)


_OTSU = """hs AS (SELECT fov, v, CAST(count(*) AS DOUBLE) AS n FROM px GROUP BY 1, 2),
hw AS (SELECT *, sum(n) OVER o AS w1, sum(n * v) OVER o AS s1, sum(n) OVER (PARTITION BY fov) AS w, sum(n * v) OVER (PARTITION BY fov) AS s FROM hs WINDOW o AS (PARTITION BY fov ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
th AS (SELECT fov, arg_max(v, ROW(w1 * (w - w1) * (s1 / w1 - (s - s1) / (w - w1)) * (s1 / w1 - (s - s1) / (w - w1)), -v)) AS t FROM hw WHERE w1 < w GROUP BY 1)"""

@query("A15_otsu_threshold", with_(_PIXELS, _OTSU) + f"SELECT fov, {r('t')} AS threshold FROM th")
def _(spark: SparkSession, d: str) -> DataFrame:
    return I.otsu(pixels(spark, d), BY)


@query(
    "I13_segment",
    _labels(_OTSU) + """SELECT fov, i, j, CAST(dense_rank() OVER (PARTITION BY fov ORDER BY label) AS INT) AS label
FROM (SELECT *, count(*) OVER (PARTITION BY fov, label) AS n FROM lb) WHERE n BETWEEN 3 AND 5000""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return I.segment(pixels(spark, d), BY, WIDTH, 3, 5000)


@query(
    "I14_expand_labels",
    _labels(_TOP).rstrip()
    + """, bg AS (SELECT fov, i, j FROM px WHERE (fov, i, j) NOT IN (SELECT (fov, i, j) FROM br)), nr AS (SELECT bg.fov, bg.i, bg.j, arg_min(label, ROW(sqrt((bg.i - lb.i) * (bg.i - lb.i) + (bg.j - lb.j) * (bg.j - lb.j)), label)) AS label FROM bg JOIN lb ON bg.fov = lb.fov AND abs(bg.i - lb.i) <= 2 AND abs(bg.j - lb.j) <= 2
WHERE sqrt((bg.i - lb.i) * (bg.i - lb.i) + (bg.j - lb.j) * (bg.j - lb.j)) <= 2 GROUP BY 1, 2, 3) SELECT fov, i, j, CAST(label AS INT) AS label FROM nr UNION ALL SELECT fov, i, j, CAST(label AS INT) FROM lb""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return _expanded(spark, d)


def _expanded(spark: SparkSession, d: str) -> DataFrame:
    bright = _bright(spark, d)
    labels = I.label_components(bright, BY, WIDTH)
    return I.expand_labels(labels, pixels(spark, d).join(bright, ["fov", "i", "j"], "left_anti"), BY, 2.0)


def _spots(spark: SparkSession, d: str) -> DataFrame:
    """Every order line is a spot, odd line numbers in the first channel."""
    channel = F.when(F.col("l_linenumber") % 2 == 1, "barcode1").otherwise("barcode2").alias("channel")
    return table(spark, d, "lineitem").select(*map(F.expr, _PLACE), channel)


_CLASSES = (
    _labels(_TOP).rstrip()
    + f""", ss AS (SELECT {_PLACE_SQL}, 2 - l_linenumber % 2 AS ch FROM lineitem),
sc AS (SELECT lb.fov, label, count(*) FILTER (ch = 1) AS a, count(*) FILTER (ch = 2) AS b FROM lb LEFT JOIN ss ON ss.fov = lb.fov AND ss.i = lb.i AND ss.j = lb.j GROUP BY 1, 2), cl AS (SELECT *, CASE WHEN a >= 4 AND b >= 4 THEN 'both_barcodes' WHEN a >= 4 THEN 'barcode1_only' WHEN b >= 4 THEN 'barcode2_only' ELSE 'no_barcode' END AS classification FROM sc) """
)


def _classes(spark: SparkSession, d: str) -> DataFrame:
    labels = I.label_components(_bright(spark, d), BY, WIDTH)
    counts = I.spots_per_cell(labels, _spots(spark, d), BY, ["barcode1", "barcode2"])
    return counts.withColumn("classification", D.two_barcode_class("barcode1_spot_count", "barcode2_spot_count", 4))


@query("I15_spots_per_cell", _CLASSES + "SELECT fov, CAST(label AS INT) AS label, a AS barcode1_spot_count, b AS barcode2_spot_count, classification FROM cl")
def _(spark: SparkSession, d: str) -> DataFrame:
    return _classes(spark, d)


@query("G29_two_oligo_summary", _CLASSES + "SELECT fov, count(*) AS n_cells, " + ", ".join(f"count_if(classification = '{c}') AS n_{c}" for c in ("both_barcodes", "barcode1_only", "barcode2_only", "no_barcode")) + " FROM cl GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    names = ("both_barcodes", "barcode1_only", "barcode2_only", "no_barcode")
    return _classes(spark, d).groupBy("fov").agg(F.count(F.lit(1)).alias("n_cells"), *[F.count_if(F.col("classification") == c).alias(f"n_{c}") for c in names])


@query(
    "I11_local_snr",
    with_(_PIXELS, "cd AS (SELECT fov, i, j FROM px WHERE v > 60)", "ar AS (SELECT cd.fov, cd.i, cd.j, p.v, sqrt((p.i - cd.i) * (p.i - cd.i) + (p.j - cd.j) * (p.j - cd.j)) AS d FROM cd JOIN px p ON p.fov = cd.fov AND abs(p.i - cd.i) <= 5 AND abs(p.j - cd.j) <= 5)", "sg AS (SELECT fov, i, j, max(v) FILTER (d <= 1) AS s, median(v) FILTER (d > 3 AND d <= 5) AS b FROM ar GROUP BY 1, 2, 3)")
    + f"SELECT fov, i, j, {r('s / b')} AS snr FROM sg WHERE b > 0",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    px = materialize(pixels(spark, d), "pixels")
    return I.local_snr(px.where("v > 60"), px, BY).where(F.col("snr") < float("inf"))


@query("I9_density", with_(_PIXELS) + f"SELECT fov, {r('count_if(v > 60) / (count(*) / 1e6::DOUBLE)')} AS per_megapixel FROM px GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return pixels(spark, d).groupBy("fov").agg(I.density_per_megapixel(F.count_if(F.col("v") > 60), F.count(F.lit(1))).alias("per_megapixel"))


_GRID = (40.0, 60.0, 80.0, 100.0)


@query(
    "I10_marker_thresholds",
    with_(
        _PIXELS,
        f"h AS (SELECT CASE WHEN fov % {CHANNELS} = 0 THEN 'negative' ELSE 'positive' END AS field, v FROM px WHERE v > 40)",
        f"g AS (SELECT unnest({list(_GRID)!r}::DOUBLE[]) AS t)",
        "c AS (SELECT t, count_if(field = 'negative' AND v > t) / 0.5::DOUBLE AS n, count_if(field = 'positive' AND v > t) / 1.0::DOUBLE AS p FROM g, h GROUP BY 1)",
    )
    + f"SELECT t AS threshold, {r('n')} AS neg_matches_per_mpx, {r('p')} AS pos_matches_per_mpx, {r('p / nullif(n, 0)')} AS enrichment, n <= 900 AND p >= 0.5 AS passes_policy, {r('coalesce(p / nullif(n, 0), 0) + CASE WHEN n <= 900 AND p >= 0.5 THEN 1000 ELSE 0 END')} AS selection_score FROM c",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    hits = pixels(spark, d).where("v > 40").select(F.when(F.col("fov") % CHANNELS == 0, "negative").otherwise("positive").alias("field"), "v")
    out = D.threshold_table(hits, _GRID, "v", (0.5, 1.0), True, max_negative=900.0)
    return out.withColumn("enrichment", F.when(F.col("enrichment") < float("inf"), F.col("enrichment")))


def _ratios(spark: SparkSession, d: str) -> DataFrame:
    snr = F.transform(F.slice("embedding", 1, 12), lambda x: F.round(x.cast("double") + 1.0, 6) * 1.5)
    return table(spark, d, "embeddings").select("vec_id", snr.alias("snr"))


_CODES = ", ".join(f"({i}, '{c}', '{n}')" for i, (c, n) in enumerate(D.ROUND_1.calls))
_DECODED = with_(
    f"lib(o, code, call) AS (VALUES {_CODES})",
    "e AS (SELECT vec_id, list_transform(embedding[1:12], lambda x: round(x::DOUBLE + 1.0::DOUBLE, 6) * 1.5::DOUBLE) AS s FROM embeddings)",
    "x AS (SELECT vec_id, unnest(s) AS v, unnest(range(12)) AS m FROM e)",
    "k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, m) AS k FROM x)",
    "c AS (SELECT vec_id, string_agg(CASE WHEN k <= 6 THEN '1' ELSE '0' END, '' ORDER BY m) AS code, max(v) FILTER (k = 6) AS mn, max(v) FILTER (k = 7) AS nx, count_if(v >= 1.75) AS nb FROM k GROUP BY 1)",
    "m AS (SELECT c.vec_id, c.code, mn, mn - nx AS mg, nb, call, hamming(c.code, lib.code) AS d, row_number() OVER (PARTITION BY c.vec_id ORDER BY hamming(c.code, lib.code), o) AS k FROM c, lib)",
    "f AS (SELECT *, CASE WHEN d = 0 THEN 'exact' WHEN d <= 2 THEN 'tolerant' ELSE 'unmapped' END AS st FROM m WHERE k = 1)",
)


@query(
    "B5_decode",
    _DECODED + f"SELECT vec_id, code AS called_code, CASE WHEN st <> 'unmapped' THEN call END AS matched_barcode, CASE WHEN st <> 'unmapped' THEN call ELSE 'no_barcode' END AS lnp_call, CAST(d AS INT) AS barcode_match_distance, st AS barcode_match_status, {r('mn')} AS min_on_snr, {r('mg')} AS snr_margin, nb > 3 AS promiscuous, mn >= 1.2 AND mg >= 0.01 AND NOT nb > 3 AND st <> 'unmapped' AS accepted FROM f",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return D.decode(_ratios(spark, d), D.ROUND_1, min_on=1.2, min_margin=0.01, max_bright=3).drop("snr")


@query("B3_match_counts", _DECODED + "SELECT st AS barcode_match_status, CAST(d AS INT) AS barcode_match_distance, count(*) AS n FROM f GROUP BY 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    return D.decode(_ratios(spark, d), D.ROUND_1).groupBy("barcode_match_status", "barcode_match_distance").agg(F.count(F.lit(1)).alias("n"))


_SNRS = (1.2, 1.4, 1.5, 1.55)


@query(
    "B6_decode_thresholds",
    _DECODED.rstrip()
    + f""", g AS (SELECT unnest({list(_SNRS)!r}::DOUBLE[]) AS t), q AS (SELECT t, count_if(vec_id % 2 = 0 AND mn >= t) / 2.0::DOUBLE AS n, count_if(vec_id % 2 = 1 AND mn >= t) / 2.0::DOUBLE AS p FROM g, f WHERE st <> 'unmapped' GROUP BY 1)
SELECT t AS threshold, {r("n")} AS neg_matches_per_mpx, {r("p")} AS pos_matches_per_mpx, {r("p / nullif(n, 0)")} AS enrichment, n <= 3 AND p >= 0.5 AS passes_policy, {r("coalesce(p / nullif(n, 0), 0) + CASE WHEN n <= 3 AND p >= 0.5 THEN 1000 ELSE 0 END")} AS selection_score FROM q""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    mapped = D.decode(_ratios(spark, d), D.ROUND_1).where("barcode_match_status <> 'unmapped'")
    hits = mapped.select(F.when(F.col("vec_id") % 2 == 0, "negative").otherwise("positive").alias("field"), "min_on_snr")
    out = D.threshold_table(hits, _SNRS, "min_on_snr", (2.0, 2.0), False)
    return out.withColumn("enrichment", F.when(F.col("enrichment") < float("inf"), F.col("enrichment")))


def _called(spark: SparkSession, d: str) -> DataFrame:
    code = F.lpad(F.bin(F.col("l_partkey") * 37 % 4096), 12, "0")
    spots = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("cell"), code.alias("called_code"))
    return spots.withColumn("barcode_match_status", F.when(D.match(F.col("called_code"), D.ROUND_1)["distance"] <= 2, "tolerant").otherwise("unmapped"))


_BITS = with_(
    f"lib(o, code, call) AS (VALUES {_CODES})",
    "s AS (SELECT l_suppkey AS cell, lpad(bin(l_partkey * 37 % 4096), 12, '0') AS code FROM lineitem)",
    "u AS (SELECT code, min(hamming(u.code, lib.code)) AS d FROM (SELECT DISTINCT code FROM s) u, lib GROUP BY 1)".replace("SELECT code,", "SELECT u.code,"),
    "b AS (SELECT cell, " + ", ".join(f'count_if(s.code[{i + 1}] = \'1\') AS "bit_{m}"' for i, m in enumerate(D.MARKERS_12)) + ", count_if(d <= 2) AS decoded_spots, count(*) AS total_spots FROM s JOIN u USING (code) GROUP BY 1)",
)


@query("B7_bit_counts", _BITS + "SELECT * FROM b")
def _(spark: SparkSession, d: str) -> DataFrame:
    return D.bit_counts(_called(spark, d), D.ROUND_1)


@query(
    "B8_cell_calls",
    _BITS.rstrip()
    + ", f AS (SELECT s_suppkey AS cell, "
    + ", ".join(f'coalesce("bit_{m}", 0) AS "bit_{m}"' for m in D.MARKERS_12)
    + " FROM supplier LEFT JOIN b ON b.cell = s_suppkey), v AS (SELECT cell, "
    + " + ".join(f'"bit_{m}"' for m in D.MARKERS_12)
    + " AS total_barcode_spots, "
    + " || ".join(f"CASE WHEN \"bit_{m}\" >= 1 THEN '1' ELSE '0' END" for m in D.MARKERS_12)
    + """ AS barcode FROM f), w AS (SELECT v.*, call, hamming(v.barcode, lib.code) AS d, row_number() OVER (PARTITION BY cell ORDER BY hamming(v.barcode, lib.code), o) AS k FROM v, lib),
z AS (SELECT *, CASE WHEN total_barcode_spots = 0 THEN 'no_barcode' WHEN d = 0 THEN 'exact' WHEN d <= 2 THEN 'tolerant' ELSE 'ambiguous_mixed' END AS st FROM w WHERE k = 1)
SELECT cell, CAST(total_barcode_spots AS BIGINT) AS total_barcode_spots, barcode, st AS barcode_match_status, CAST(d AS INT) AS barcode_match_distance, st IN ('exact', 'tolerant') AS lnp_positive, CASE WHEN st IN ('exact', 'tolerant') THEN call ELSE 'no_barcode' END AS lnp_call FROM z""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    features = table(spark, d, "supplier").select(F.col("s_suppkey").alias("cell"))
    out = D.cell_calls(features, D.bit_counts(_called(spark, d), D.ROUND_1), D.ROUND_1)
    return out.select("cell", "total_barcode_spots", "barcode", "barcode_match_status", "barcode_match_distance", "lnp_positive", "lnp_call")


@query(
    "N17_assign_spots",
    "WITH c AS (SELECT s_suppkey AS cell, (s_suppkey * 7919) % 601 AS x, (s_suppkey * 104729) % 599 AS y FROM supplier), s AS (SELECT event_id AS spot_id, (event_id * 31) % 601 AS x, (event_id * 17) % 599 AS y FROM events), "
    f"p AS (SELECT spot_id, cell, sqrt(((s.x - c.x) * (s.x - c.x) + (s.y - c.y) * (s.y - c.y))::DOUBLE) AS d FROM s JOIN c ON abs(s.x - c.x) < 25 AND abs(s.y - c.y) < 25), b AS (SELECT * FROM p WHERE d < 25 QUALIFY row_number() OVER (PARTITION BY spot_id ORDER BY d, cell) = 1) SELECT spot_id, cell, {r('d')} AS cell_distance FROM s LEFT JOIN b USING (spot_id)",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    place = lambda k, a, b: {"x": F.expr(f"cast({k} * {a} % 601 as double)"), "y": F.expr(f"cast({k} * {b} % 599 as double)"), "field": F.lit("all")}
    centroids = table(spark, d, "supplier").select(F.col("s_suppkey").alias("cell")).withColumns(place("cell", 7919, 104729))
    spots = table(spark, d, "events").select(F.col("event_id").alias("spot_id")).withColumns(place("spot_id", 31, 17))
    return I.assign_spots(spots, centroids, 25.0, "field").select("spot_id", "cell", "cell_distance")


@query("J2_merge_report", "SELECT CASE WHEN o_custkey IS NULL THEN 'left_only' WHEN c_custkey IS NULL THEN 'right_only' ELSE 'both' END AS _merge, count(*) AS n FROM customer FULL JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return merge_report(table(spark, d, "customer").select(F.col("c_custkey").alias("key")), table(spark, d, "orders").select(F.col("o_custkey").alias("key")), ["key"])


@query("J3_anti_count", "SELECT count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return anti_count(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id"), ["doc_id"])


@query("S13_duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return contracts.duplicates(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("S13_unmatched_keys", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return contracts.unmatched(table(spark, d, "documents"), table(spark, d, "labels"), ["doc_id"])


@query("S13_out_of_domain", with_(CELLS) + "SELECT cell_type, count(*) AS n FROM cells WHERE cell_type NOT IN ('B', 'DC') GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return contracts.out_of_domain(cells(spark, d), "cell_type", ["B", "DC"])


@query("U3_region_mismatch", with_(CELLS) + "SELECT 'S9_reg000' AS lnp_region, 'missing' AS side UNION ALL SELECT 'S2_reg004', 'unexpected'")
def _(spark: SparkSession, d: str) -> DataFrame:
    return contracts.region_mismatch(cells(spark, d), "lnp_region", [*LNP_REGIONS, "S9_reg000"])


@query("S11_manifest")
def _(spark: SparkSession, d: str) -> DataFrame:
    return files.build_manifest(spark, d, "*.parquet")


@query("S12_verify_manifest", "SELECT 'nation.parquet' AS path, 'size mismatch' AS problem")
def _(spark: SparkSession, d: str) -> DataFrame:
    have = files.build_manifest(spark, d, "*.parquet")
    return files.verify_manifest(have.withColumn("size_bytes", F.when(F.col("path") == "nation.parquet", 1).otherwise(F.col("size_bytes"))), have)


@query("A6_value_counts", with_(CELLS) + "SELECT cell_type, count(*) AS n_cells FROM cells GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return value_counts(cells(spark, d), "cell_type")


@query("W8_dense_labels", "SELECT s_suppkey, CAST(dense_rank() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS INT) AS label FROM supplier")
def _(spark: SparkSession, d: str) -> DataFrame:
    return dense_labels(table(spark, d, "supplier"), ["s_nationkey"], "s_suppkey", "label").select("s_suppkey", "label")


@query("W3_top_one", with_(CELLS) + f"SELECT lnp_region, cell_id, {r('Fluc')} AS Fluc FROM cells WHERE Fluc IS NOT NULL QUALIFY row_number() OVER (PARTITION BY lnp_region ORDER BY Fluc DESC, cell_id) = 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return top_one(cells(spark, d), ["lnp_region"], F.desc_nulls_last("Fluc"), F.asc("cell_id")).select("lnp_region", "cell_id", "Fluc")

