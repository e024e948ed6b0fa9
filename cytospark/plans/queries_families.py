"""Queries of image families: images are those of `queries_images`, each with three markers; even ones are negative fields, odd ones positive."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..operators import imaging as I
from ..schemas import Codebook
from ..operators import decode as D
from ..sources import contracts, files
from ..sources.cells import cells, gates, table
from ..sources.scratch import materialize, shared_folder
from ..sources.stacks import read_stacks, write_stacks
from . import expression as E
from . import families as M
from .queries_images import _PIXELS, _SCORED, BY, CHANNELS, HEIGHT, WIDTH, pixels
from .sql import CELLS, r, with_

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    """Registers a query, rounded, with its SQL."""

    def add(f):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return f

    return add


BOOK = Codebook(("m0", "m1", "m2"), (("110", "A"), ("101", "B"), ("011", "C")), 2, 0)
GRID, WEAKEST = (5.0, 20.0, 40.0, 60.0, 80.0), (0.8, 1.0, 1.2, 1.5, 2.0)
CALIBRATED = M.Family(BOOK, width=7, distance=9.0, min_margin=0.0, max_negative=900.0, thresholds=GRID, min_on=WEAKEST)
SINGLE = M.Family(Codebook(("m0",), (("1", "A"),), 1, 0), radius=20.0, max_negative=500.0, thresholds=GRID, min_on=WEAKEST)
FIXED = M.Family(BOOK, sigma=2.0, width=3, distance=2.5, min_margin=0.0, min_on=(0.5,), threshold=2.5, own=(("m1", 4.0),), n_tiles=4, overlap=16)


def stacks(spark: SparkSession, d: str) -> DataFrame:
    """(image, marker, field, i, j, v)."""
    image = F.floor(F.col("fov") / CHANNELS).cast("int")
    px = pixels(spark, d).withColumn("marker", F.format_string("m%d", F.col("fov") % CHANNELS)).withColumn("image", image).drop("fov")
    return materialize(px.withColumn("field", F.when(F.col("image") % 2 == 0, "negative").otherwise("positive")), "pixels")


def bright_cells(px: DataFrame) -> DataFrame:
    """(cell, field, x, y): the bright parts of the channels together."""
    total = px.groupBy("image", "i", "j").agg(F.sum("v").alias("v"))
    name = F.format_string("%d|%d", "image", "label").alias("cell")
    return I.blobs(total, ["image"], WIDTH, 95.0, 2, 400).select(name, F.col("image").cast("string").alias("field"), F.col("j").cast("double").alias("x"), F.col("i").cast("double").alias("y"))


def _finite(table: DataFrame) -> DataFrame:
    return table.withColumn("enrichment", F.when(F.col("enrichment") < float("inf"), F.col("enrichment")))


def _maxima(half: int) -> str:
    return f", mx AS (SELECT a.fov, a.i, a.j, any_value(a.score) AS score FROM sc a JOIN sc b ON a.fov = b.fov AND abs(a.i - b.i) <= {half} AND abs(a.j - b.j) <= {half} WHERE a.score > {GRID[0]} GROUP BY 1, 2, 3 HAVING max(b.score) = any_value(a.score))"


def _area(odd: int) -> str:
    return f"(SELECT count(DISTINCT fov // {CHANNELS}) FILTER (fov // {CHANNELS} % 2 = {odd}) * {HEIGHT * WIDTH} / 1e6::DOUBLE FROM px0)"


def _scores(name: str, hits: str, value: str, sign: str, grid: tuple[float, ...], most: float, by: str, every: str) -> str:
    """Densities and scores of hits with `f` (0 negative, 1 positive), in DuckDB's SQL."""
    by_, on = (f"{by}, ", f"AND h.{by} = e.{by}") if by else ("", "")
    return f""", {name}0 AS (SELECT {"e." + by_ if by else ""}t, count(*) FILTER (h.f = 0 AND {value} {sign} t) AS a, count(*) FILTER (h.f = 1 AND {value} {sign} t) AS b FROM {every} e CROSS JOIN (SELECT unnest({list(grid)!r}::DOUBLE[]) AS t) LEFT JOIN {hits} h ON true {on} GROUP BY ALL),
{name}1 AS (SELECT {by_}t, coalesce(a / nullif({_area(0)}, 0), 0.0) AS n, coalesce(b / nullif({_area(1)}, 0), 0.0) AS p FROM {name}0),
{name} AS (SELECT {by_}t AS threshold, n, p, CASE WHEN n > 0 THEN p / n WHEN p = 0 THEN 0.0 END AS enrichment, n <= {most} AND p >= 0.5 AS passes_policy, coalesce(p / nullif(n, 0), 0) + CASE WHEN n <= {most} AND p >= 0.5 THEN 1000 ELSE 0 END AS score FROM {name}1)"""


_TABLE = f"threshold, {r('n')} AS neg_matches_per_mpx, {r('p')} AS pos_matches_per_mpx, {r('enrichment')} AS enrichment, passes_policy, {r('score')} AS selection_score"
_MARKER_HITS = f", h0 AS (SELECT concat('m', fov % {CHANNELS}) AS marker, fov // {CHANNELS} % 2 AS f, score FROM mx)"


@query(
    "G28_marker_calibration",
    _SCORED.rstrip() + _maxima(3) + _MARKER_HITS + _scores("mk", "h0", "h.score", ">", GRID, 900.0, "marker", "(SELECT unnest(['m0', 'm1', 'm2']) AS marker)") + f" SELECT marker, {_TABLE} FROM mk",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return _finite(M.marker_calibration(stacks(spark, d), ["image"], "marker", "field", CALIBRATED))


# one marker, and maxima that are farther apart than the suppression reaches, so that SQL needs none
_SINGLE = (
    _SCORED.replace("FROM px, kn)", f"FROM px, kn WHERE fov % {CHANNELS} = 0)").replace("WITH ", "WITH RECURSIVE ", 1).rstrip()
    + _maxima(10)
    + ", h0 AS (SELECT 'm0' AS marker, fov // 3 % 2 AS f, score FROM mx)"
    + _scores("mk", "h0", "h.score", ">", GRID, 500.0, "", "(SELECT 1)")
    + """, best AS (SELECT arg_max(threshold, ROW(score, -threshold)) AS t FROM mk),
cand AS (SELECT fov, i, j FROM mx, best WHERE score > t),
ring AS (SELECT c.fov, c.i, c.j, max(v) FILTER (sqrt((p.i - c.i) * (p.i - c.i) + (p.j - c.j) * (p.j - c.j)) <= 1) AS signal, coalesce(median(v) FILTER (sqrt((p.i - c.i) * (p.i - c.i) + (p.j - c.j) * (p.j - c.j)) > 3), 0.0) AS ring
  FROM cand c JOIN px p ON p.fov = c.fov AND abs(p.i - c.i) <= 5 AND abs(p.j - c.j) <= 5 WHERE sqrt((p.i - c.i) * (p.i - c.i) + (p.j - c.j) * (p.j - c.j)) <= 5 GROUP BY 1, 2, 3),
snr AS (SELECT fov // 3 AS image, i, j, fov // 3 % 2 AS f, CASE WHEN ring > 0 THEN signal / ring WHEN signal > 0 THEN 'inf'::DOUBLE ELSE 0.0 END AS snr FROM ring)"""
    + _scores("dk", "snr", "h.snr", ">=", WEAKEST, 500.0, "", "(SELECT 1)")
    + """, cut AS (SELECT arg_max(threshold, ROW(score, -threshold)) AS t FROM dk),
tot AS (SELECT fov // 3 AS image, i, j, sum(v) AS v FROM px GROUP BY 1, 2, 3),
th AS (SELECT image, quantile_cont(v, 0.95) AS t FROM tot GROUP BY 1),
br AS (SELECT tot.image, i, j, v, i * 96 + j AS node FROM tot JOIN th USING (image) WHERE v > t),
ed AS (SELECT a.image, a.node AS u, b.node AS w FROM br a JOIN br b ON a.image = b.image AND abs(a.i - b.i) + abs(a.j - b.j) <= 1),
cc(image, u, w) AS (SELECT image, u, w FROM ed UNION SELECT cc.image, cc.u, ed.w FROM cc JOIN ed ON ed.image = cc.image AND ed.u = cc.w),
rt AS (SELECT image, u AS node, min(w) AS root FROM cc GROUP BY 1, 2),
lb AS (SELECT br.*, dense_rank() OVER (PARTITION BY br.image ORDER BY root) AS label FROM br JOIN rt ON rt.image = br.image AND rt.node = br.node),
cl AS (SELECT concat(image, '|', label) AS cell, image, round_even(sum(j * v) / sum(v), 0) AS x, round_even(sum(i * v) / sum(v), 0) AS y FROM lb GROUP BY image, label HAVING count(*) BETWEEN 2 AND 400),
ok AS (SELECT image, i, j FROM snr, cut WHERE snr >= t AND snr >= 0.05),
nr AS (SELECT ok.image, i, j, arg_min(cell, ROW(sqrt((j - x) * (j - x) + (i - y) * (i - y)), cell)) AS cell FROM ok JOIN cl ON ok.image = cl.image AND sqrt((j - x) * (j - x) + (i - y) * (i - y)) < 20 GROUP BY 1, 2, 3),
nn AS (SELECT cell, count(*) AS n FROM nr GROUP BY 1)
SELECT cell, coalesce(n, 0) AS total_barcode_spots, CASE WHEN n > 0 THEN '1' ELSE '0' END AS barcode, CASE WHEN n > 0 THEN 'exact' ELSE 'no_barcode' END AS barcode_match_status, coalesce(n, 0) > 0 AS lnp_positive, CASE WHEN n > 0 THEN 'A' ELSE 'no_barcode' END AS lnp_call FROM cl LEFT JOIN nn USING (cell)"""
)
_CALLS = ("cell", "total_barcode_spots", "barcode", "barcode_match_status", "lnp_positive", "lnp_call")


@query("G28_single_bit_family", _SINGLE)
def _(spark: SparkSession, d: str) -> DataFrame:
    px = stacks(spark, d)
    return M.calibrated_family(px, bright_cells(px), ["image"], "marker", "field", SINGLE)["cells"].select(*_CALLS)


@query("G28_image_family")
def _(spark: SparkSession, d: str) -> DataFrame:
    px = stacks(spark, d)
    return M.calibrated_family(px, bright_cells(px), ["image"], "marker", "field", CALIBRATED)["cells"].select(*_CALLS)


@query("G28_fixed_family")
def _(spark: SparkSession, d: str) -> DataFrame:
    px = stacks(spark, d)
    return M.fixed_family(px, bright_cells(px), ["image"], "marker", FIXED, HEIGHT, WIDTH)["cells"].select(*_CALLS)


@query(
    "A15_otsu_bins",
    f"""WITH {_PIXELS},
e AS (SELECT fov, min(v) AS lo, max(v) AS hi FROM px GROUP BY 1),
hs AS (SELECT fov, lo + (bin + 0.5) * ((hi - lo) / 256) AS v, CAST(count(*) AS DOUBLE) AS n FROM (SELECT fov, lo, hi, least(255, floor((v - lo) * 256 / (hi - lo))) AS bin FROM px JOIN e USING (fov)) GROUP BY 1, 2),
hw AS (SELECT *, sum(n) OVER o AS w1, sum(n * v) OVER o AS s1, sum(n) OVER (PARTITION BY fov) AS w, sum(n * v) OVER (PARTITION BY fov) AS s FROM hs WINDOW o AS (PARTITION BY fov ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT fov, {r("arg_max(v, ROW(w1 * (w - w1) * (s1 / w1 - (s - s1) / (w - w1)) * (s1 / w1 - (s - s1) / (w - w1)), -v))")} AS threshold FROM hw WHERE w1 < w GROUP BY 1""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return I.otsu(pixels(spark, d), BY, 256)


def _written(spark: SparkSession, d: str) -> str:
    """A folder with a stack for each image."""
    path = f"{shared_folder(spark)}/stacks-{uuid4().hex}"
    named = stacks(spark, d).select(F.format_string("image%d", "image").alias("sample"), "marker", F.format_string("reg00%d", F.col("image") % 4).alias("region"), "i", "j", "v")
    materialize(write_stacks(named, path, BOOK.markers, HEIGHT, WIDTH), "written")
    return path


_IMAGES = f"WITH {_PIXELS}, st AS (SELECT concat('image', fov // {CHANNELS}) AS sample, concat('reg00', fov // {CHANNELS} % 4) AS region, concat('m', fov % {CHANNELS}) AS marker, i, j, v FROM px) "


@query("S6_image_stacks", _IMAGES + f"SELECT sample, region, marker, i, {r('sum(v)')} AS total, count(*) AS n FROM st WHERE region = 'reg000' AND marker IN ('m0', 'm2') GROUP BY ALL")
def _(spark: SparkSession, d: str) -> DataFrame:
    px = read_stacks(spark, _written(spark, d), ["reg000"], ["m0", "m2"], rows=32)
    return px.groupBy("sample", "region", "marker", "i").agg(F.sum("v").alias("total"), F.count(F.lit(1)).alias("n"))


@query("S7_find_images", _IMAGES + "SELECT DISTINCT sample, substr(sample, 6) AS number FROM st")
def _(spark: SparkSession, d: str) -> DataFrame:
    return files.find_images(spark, _written(spark, d), "*.npy", r"^(image([0-9]+))[.]npy$", ["sample", "number"]).drop("path")


@query("S9_parameters", with_(CELLS) + f"SELECT marker, col AS \"column\", round(quantile_cont(v, 0.95), 6) AS threshold, count(v) AS reference_n_cells FROM (SELECT 'Luc' AS marker, 'Fluc' AS col, Fluc AS v FROM cells WHERE lnp_region = 'S2_reg004' UNION ALL SELECT 'OVA', 'OVA', OVA FROM cells WHERE lnp_region = 'S2_reg004') GROUP BY 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = f"{shared_folder(spark)}/parameters-{uuid4().hex}"
    files.write_parameters(gates(cells(spark, d), E.GENES, 0.95).drop("reference_median"), path)
    return spark.read.schema("marker string, `column` string, threshold double, reference_n_cells bigint").json(path)


@query(
    "S14_codebook_violations",
    "SELECT DISTINCT CASE WHEN p_partkey % 50 = 0 THEN c || '0' ELSE c END AS code, 'x' || (p_partkey % 10) AS call FROM (SELECT p_partkey, lpad(bin(p_partkey * 37 % 4096), 12, '0') AS c FROM part) WHERE p_partkey % 50 = 0 OR bit_count(p_partkey * 37 % 4096) <> 6",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    code = F.lpad(F.bin(F.col("p_partkey") * 37 % 4096), 12, "0")
    code = F.when(F.col("p_partkey") % 50 == 0, F.concat(code, F.lit("0"))).otherwise(code)
    codes = table(spark, d, "part").select(code.alias("code"), F.format_string("x%d", F.col("p_partkey") % 10).alias("call")).distinct()
    return contracts.codebook_violations(codes, D.ROUND_1)


@query("S13_write_checked", with_(CELLS) + f"SELECT lnp_region, count(*) AS n, {r('avg(x)')} AS mean_x, (SELECT count(*) FROM cells) AS n_written FROM cells GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    c, path = cells(spark, d), f"{shared_folder(spark)}/cells-{uuid4().hex}"
    found = contracts.write_checked(c, path, {"place": F.col("x").isNotNull() & F.col("y").isNotNull(), "call": F.col("lnp_call").rlike("^LNP_[0-9]{2}$"), "region": F.col("lnp_region").rlike("^S[0-9]_reg[0-9]{3}$")}, 1)
    out = spark.read.schema(c.schema).parquet(path).groupBy("lnp_region").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean_x"))
    return out.withColumn("n_written", F.lit(found["rows"]).cast("bigint"))
