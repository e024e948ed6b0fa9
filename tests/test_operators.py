"""Hand-computed cases: nulls, ties, statistics, images and contracts."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytospark.functions import columns as C
from cytospark.functions import stats as S
from cytospark.operators import cluster, decode, imaging, neighbors, spatial
from cytospark.operators.components import components
from cytospark.schemas import LNP_ORDER, lnp_detail_rows
from cytospark.sources import contracts, files


def line_of_cells(spark):
    rows = [(0, "DC", 0.0), (1, "CD8+ T", 5.0), (2, "CD8+ T", 15.0), (3, "CD8+ T", 40.0), (4, "B", 500.0)]
    return spark.createDataFrame([(i, "r", t, x, 0.0) for i, t, x in rows], "cell_id long, lnp_region string, cell_type string, x double, y double")


def test_detail_swaps_first_two():
    rows = lnp_detail_rows()
    assert [r[1] for r in rows[:3]] == ["LNP_02", "LNP_01", "LNP_03"] and len(rows) == len(LNP_ORDER)
    assert rows[0][3:] == ("SM-102", "DSPC", "SM-102 + DSPC") and rows[9][5] == "ALC-0315 + 18PG"


def test_line_metrics(spark):
    c = line_of_cells(spark)
    dc = c.where("cell_type = 'DC'")
    k = neighbors.multiscale_metrics(dc, c, "CD8+ T", [1, 3], "t").first()
    assert (k.n_t_neighbors_k1, k.n_t_neighbors_k3, k.mean_t_distance_um_k1) == (1, 3, 2.5)
    r = neighbors.radius_metrics(dc, c, "CD8+ T", [10.0, 20.0], "t").first()
    assert (r.n_t_within_r10, r.n_t_within_r20) == (1, 2)
    h = neighbors.hybrid_metrics(dc, c, "CD8+ T", 2, 10.0, "t").first()
    assert (h.n_retained_neighbors, h.n_t_neighbors) == (1, 1)


def test_radius_is_inclusive_and_knn_finds_far_points(spark):
    c = line_of_cells(spark)
    assert spatial.radius_pairs(c.where("cell_id = 0"), c.where("cell_id = 1"), 5.0).count() == 1
    assert spatial.radius_pairs(c.where("cell_id = 0"), c.where("cell_id = 1"), 5.0, strict=True).count() == 0
    ranks = {(r.target_id, r.rank): r.neighbor_id for r in spatial.knn_pairs(c, c, 4).collect()}
    assert len(ranks) == 20 and ranks[4, 1] == 3 and ranks[4, 4] == 0


def test_knn_against_brute_force(spark):
    rng = np.random.default_rng(0)
    xy = np.round(np.concatenate((rng.normal(0, 1, (60, 2)), rng.normal(50, 0.01, (40, 2)), rng.integers(0, 3, (30, 2)))), 2)
    c = spark.createDataFrame([(i, "r", float(a), float(b)) for i, (a, b) in enumerate(xy)], "cell_id long, lnp_region string, x double, y double")
    got = {(r.target_id, r.rank): r.neighbor_id for r in spatial.knn_pairs(c, c, 7).collect()}
    for t in range(len(xy)):
        dx, dy = xy[t, 0] - xy[:, 0], xy[t, 1] - xy[:, 1]
        order = [int(n) for n in sorted(range(len(xy)), key=lambda n: (dx[n] * dx[n] + dy[n] * dy[n], n)) if n != t][:7]
        assert [got[t, k + 1] for k in range(7)] == order


def test_knn_single_cell_and_empty(spark):
    c = line_of_cells(spark)
    assert spatial.knn_pairs(c.limit(1), c.limit(1), 3).count() == 0
    assert spatial.knn_pairs(c.where("false"), c.where("false"), 3).count() == 0


def test_keep_nearest(spark):
    pairs = spark.createDataFrame([("r", "a", 1, 10, 5.0), ("r", "b", 2, 10, 2.0), ("r", "a", 1, 11, 3.0)], "lnp_region string, lnp_call string, target_id long, neighbor_id long, distance double")
    assert {(r.neighbor_id, r.distance) for r in spatial.keep_nearest(pairs).collect()} == {(10, 2.0), (11, 3.0)}


def test_sem_and_gates(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 5.0), ("c", None)], "g string, v double")
    got = {r.g: r.s for r in df.groupBy("g").agg(C.sem("v").alias("s")).collect()}
    assert got["b"] == 0 and got["c"] == 0 and math.isclose(got["a"], 1 / math.sqrt(3))
    q = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 10)], "v double").agg(C.quantile("v", 0.95).alias("q")).first().q
    assert math.isclose(q, 8.8)
    nan = C.nan_to_null(spark.createDataFrame([(float("nan"),), (2.0,)], "v double"))
    assert nan.where(C.above("v", F.lit(1.0))).count() == 1


def test_labels(spark):
    df = spark.createDataFrame([(" epithelial cell",), ("B",)], "t string")
    assert [r[0] for r in df.select(C.pool_cell_type("t")).collect()] == ["Epithelial", "B"]
    key = spark.createDataFrame([("x_registered_y_registered_S1", "reg000")], "s string, r string").select(C.region_key("s", "r")).first()[0]
    assert key == "S1_reg000"


@pytest.mark.parametrize("t, df, side, p", [(2.0, 10, "two-sided", 0.07338803), (2.228139, 10, "two-sided", 0.05), (-1.812461, 10, "less", 0.05), (0.0, 5, "greater", 0.5), (float("inf"), 2, "two-sided", 0.0)])
def test_student(t, df, side, p):
    assert math.isclose(S.t_pvalue(t, df, side), p, abs_tol=1e-6)


def paired(spark, a, b):
    rows = [(f"r{i}", g, float(v)) for g, vs in (("a", a), ("b", b)) for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "lnp_region string, lnp_call string, v double")


def test_paired_t_edges(spark):
    run = lambda a, b: S.paired_t_test(paired(spark, a, b), "lnp_call", ("a", "b"), "v").first()
    constant = run([3, 4, 5], [1, 2, 3])
    assert constant.df == 2 and math.isinf(constant.t) and constant.p_value < 0.05
    assert run([1, 2, 3], [1, 2, 3]).t is None
    one = run([1], [2])
    assert (one.n_regions, one.df, one.t, one.p_value, one.p_text) == (1, None, None, None, "P = NA")


def test_signed_rank(spark):
    got = S.signed_rank_test(paired(spark, [1, 2, 3, 4, 5], [0, 0, 0, 0, 0]), "lnp_call", ("a", "b"), "v").first()
    assert got.w == 0 and math.isclose(got.p_value, 0.0625)


def test_correlations(spark):
    df = spark.createDataFrame([(1.0, 1.0, 7.0), (2.0, 4.0, 7.0), (3.0, 9.0, 7.0)], "x double, y double, c double")
    assert math.isclose(S.spearman(df, "x", "y").first().rho, 1.0)
    assert S.pearson(df, "x", "c").first().r is None


def test_cluster_purity_and_names(spark):
    rows = spark.createDataFrame([(i, [1.0, 0.0] if i < 30 else [0.0, 1.0]) for i in range(60)], "cell_id long, features array<double>")
    centroids, _ = cluster.fit_centroids(rows, 2)
    found = cluster.assign(rows, centroids).select("cell_id", "cluster").collect()
    assert len({r.cluster for r in found if r.cell_id < 30}) == 1 and len({r.cluster for r in found}) == 2
    assert [r.k for r in cluster.elbow(rows, (1, 2, 60)).collect()] == [2]


def test_decode_ties_and_tolerance(spark):
    snr = [1.0] * 12
    row = decode.decode(spark.createDataFrame([(snr,)], "snr array<double>"), decode.ROUND_1).first()
    assert row.called_code == "111111000000" and row.snr_margin == 0
    exact = [2.0 if b == "1" else 1.0 for b in decode.CODES[3]]
    row = decode.decode(spark.createDataFrame([(exact,)], "snr array<double>"), decode.ROUND_1).first()
    assert (row.lnp_call, row.barcode_match_status, row.accepted) == ("LNP_04", "exact", True)


def test_codebooks(spark):
    for book in (decode.FULL_BARCODE, decode.SINGLE_BIT, decode.ROUND_1, decode.ROUND_2):
        assert contracts.codebook_violations(book.frame(spark), book).count() == 0


def test_suppression_is_greedy(spark):
    rng = np.random.default_rng(1)
    points = [(0, int(i), int(j), float(s)) for i, j, s in zip(rng.integers(0, 40, 120), rng.integers(0, 40, 120), rng.permutation(120), strict=True)]
    points = list({(p[1], p[2]): p for p in points}.values())
    kept = []
    for p in sorted(points, key=lambda p: (-p[3], p[1], p[2])):
        if all((p[1] - k[1]) ** 2 + (p[2] - k[2]) ** 2 >= 81 for k in kept):
            kept.append(p)
    got = imaging.suppress(spark.createDataFrame(points, "fov int, i int, j int, score double"), ["fov"], 9.0)
    assert {tuple(r) for r in got.collect()} == set(kept)


def test_tiled_equals_untiled_for_separated_spots(spark):
    v = np.zeros((120, 60))
    for i in (10, 35, 60, 85, 110):
        v[i, 30] = 100.0
    px = spark.createDataFrame([(0, i, j, float(v[i, j])) for i in range(120) for j in range(60)], "fov int, i int, j int, v double")
    whole = imaging.suppress(imaging.log_candidates(px, ["fov"], 1.0, 21, 1.0), ["fov"], 9.0)
    tiled = imaging.detect_tiled(px, ["fov"], 120, 4, 12, 1.0, 21, 1.0, 9.0)
    assert {(r.i, r.j) for r in whole.collect()} == {(r.i, r.j) for r in tiled.collect()} == {(i, 30) for i in (10, 35, 60, 85, 110)}


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (7, 7), (None, 3)], "u long, v long")
    got = {r.u: r.root for r in components(edges).collect()}
    assert got == {i: 0 for i in range(1, 51)} | {101: 100}
    assert components(edges.where("false")).count() == 0


def test_labels_of_images_named_image(spark):
    mask = spark.createDataFrame([(7, 0, 0), (7, 0, 1), (7, 4, 4), (9, 0, 1)], "image int, i int, j int")
    want = [(7, 0, 0, 1), (7, 0, 1, 1), (7, 4, 4, 2), (9, 0, 1, 1)]
    assert sorted(map(tuple, imaging.label_components(mask, ["image"], 8).collect())) == want
    alone = imaging.label_components(mask.where("image = 7").drop("image"), [], 8).collect()
    assert sorted(map(tuple, alone)) == [w[1:] for w in want[:3]]
    assert imaging.label_components(mask.where("false"), ["image"], 8).count() == 0


def test_contracts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    with pytest.raises(contracts.ContractError):
        contracts.enforce(contracts.duplicates(df, ["k"]), "keys repeat")
    with pytest.raises(contracts.ContractError):
        contracts.expect_columns(df, ["k", "z"])
    with pytest.raises(contracts.ContractError):
        contracts.expect_single(df, "v")


def test_manifest(spark, tmp_path):
    for name in ("a.txt", "b.txt", "c.txt"):
        (tmp_path / name).write_text(name)
    good = files.build_manifest(spark, str(tmp_path), "*.txt")
    listed = good.where("path <> 'c.txt'").unionByName(spark.createDataFrame([("d.txt", 1, "0" * 64), ("e.txt", 1, "xyz")], "path string, size_bytes long, sha256 string"))
    changed = listed.withColumn("sha256", F.when(F.col("path") == "b.txt", "1" * 64).otherwise(F.col("sha256"))).withColumn("size_bytes", F.when(F.col("path") == "a.txt", 9).otherwise(F.col("size_bytes")))
    assert {tuple(r) for r in files.verify_manifest(changed, good).collect()} == {("a.txt", "size mismatch"), ("b.txt", "digest mismatch"), ("d.txt", "missing"), ("e.txt", "malformed digest")}


def test_tiles_resume(spark, tmp_path):
    path, tiles = str(tmp_path / "out"), spark.createDataFrame([(0, 0), (0, 1)], "region int, tile int")
    assert files.unfinished(spark, tiles, path, ["region", "tile"]).count() == 2
    files.write_tiles(spark.createDataFrame([(0, 0, 5)], "region int, tile int, n int"), path, ["region", "tile"], tiles.where("tile = 0"))
    assert [r.tile for r in files.unfinished(spark, tiles, path, ["region", "tile"]).collect()] == [1]
    assert files.unfinished(spark, tiles, path, ["region", "tile"], force=True).count() == 2


def test_stream(spark, tmp_path):
    from cytospark.streaming import incremental

    source = str(tmp_path / "in")
    spots = spark.createDataFrame([(1, [2.0 if b == "1" else 1.0 for b in decode.CODES[0]])], "spot_id long, snr array<double>")
    spots.write.parquet(source)
    stream = decode.decode(incremental.read_stream(spark, source, "spot_id long, snr array<double>"), decode.ROUND_1)
    for expected in (1, 2):
        incremental.append(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == expected
        spots.write.mode("append").parquet(source)


def test_dense_grid_is_not_broadcast(spark):
    """A filter on the values makes the join an inner one, whose small-looking side is the grid."""
    from cytospark.operators import imaging as I

    px = spark.range(4000).selectExpr("cast(id % 50 as int) as fov", "cast(id % 96 as int) as i", "cast(id % 95 as int) as j", "cast(id as double) as v").dropDuplicates(["fov", "i", "j"])
    bright = I.dense(px, ["fov"], 96, 96).where("v > 40")
    assert bright.count() == px.where("v > 40").count()
    bright.collect()
    assert "BroadcastHashJoin" not in bright._jdf.queryExecution().executedPlan().toString()


def test_local_snr_against_every_pixel(spark):
    """Absent pixels, null values, places without a pixel, tiles' borders and two channels."""
    import math

    import numpy as np

    from cytospark.operators import imaging as I

    rng = np.random.default_rng(1)
    px = {(c, i, j): (None if rng.random() < 0.02 else float(rng.integers(0, 9))) for c in "ab" for i in range(500, 524) for j in range(30) if rng.random() < (0.7 if c == "a" else 0.1)}
    spots = [(i, j) for i in range(494, 530) for j in range(0, 36)]
    got = I.local_snr(spark.createDataFrame([("x", i, j) for i, j in spots * 2], "f string, i int, j int"), spark.createDataFrame([("x", *k, v) for k, v in px.items()], "f string, c string, i int, j int, v double"), ["f"], channel=["c"])
    assert dict(got.dtypes)["i"] == "int"
    want = {}
    for c in "ab":
        for i, j in spots:
            near = [(math.hypot(a, b), px[c, i + a, j + b]) for a in range(-5, 6) for b in range(-5, 6) if (c, i + a, j + b) in px and math.hypot(a, b) <= 5]
            if near:
                signal = max((v for d, v in near if d <= 1 and v is not None), default=None)
                ring = [v for d, v in near if d > 3 and v is not None]
                ring = float(np.median(ring)) if ring else 0.0
                want[c, i, j] = (None if signal is None else signal / ring) if ring > 0 else math.inf if signal else 0.0
    assert {(r.c, r.i, r.j): r.snr for r in got.collect()} == want


def test_section_makes_no_composition_unasked(spark, small, monkeypatch):
    """Only `composition_around` looks for neighbours' types, and only of the targets."""
    from cytospark.operators import neighbors as N
    from cytospark.plans import queries_sections as Q

    asked = []
    plain = N.neighbor_composition
    monkeypatch.setattr(N, "neighbor_composition", lambda *a, **k: asked.append(k.get("targets")) or plain(*a, **k))
    section = Q._around(spark, small)
    assert not asked
    section.composition_around()
    assert asked == [section.targets]
