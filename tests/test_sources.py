"""Stacks by tiles, digests of large and nested files, contracts in the pass that writes, and k-means with all starts at once."""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytospark.operators import cluster
from cytospark.sources import contracts, files, stacks


@pytest.fixture
def folder(tmp_path):
    """Two samples: 64-bit floats and 16-bit integers."""
    rng = np.random.default_rng(1)
    out = {"a": rng.random((3, 50, 40)), "b": rng.integers(0, 60_000, (2, 30, 20)).astype(np.uint16)}
    for sample, stack in out.items():
        np.save(tmp_path / f"{sample}.npy", stack)
        (tmp_path / f"{sample}.markers.txt").write_text("\n".join(f"m{n}" for n in range(len(stack))))
        (tmp_path / f"{sample}.registration.json").write_text(json.dumps({"region": f"reg_{sample}"}))
    return tmp_path, out


def test_stacks_by_tiles(spark, folder):
    path, images = folder
    for rows in (1024, 7):
        got = stacks.read_stacks(spark, str(path), rows=rows).collect()
        assert len(got) == sum(s.size for s in images.values())
        assert all(r.v == images[r.sample][int(r.marker[1:]), r.i, r.j] and r.region == f"reg_{r.sample}" for r in got)
    every = stacks.read_stacks(spark, f"file:{path}", rows=10)
    some = stacks.read_stacks(spark, str(path), ["reg_a"], ["m1", "m9"], rows=10)
    assert every.rdd.getNumPartitions() == 3 * 5 + 2 * 3 and some.rdd.getNumPartitions() == 5
    assert some.groupBy("sample", "marker").count().collect() == [("a", "m1", 2000)]


def test_filters_reach_the_partitions(spark, folder):
    path, images = folder
    session = spark.newSession()
    session.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    session.dataSource.register(stacks.PushedStacks)
    px = session.read.format("image_stacks_pushed").option("rows", 10).load(str(path))
    some = px.where("region = 'reg_b' AND marker IN ('m0', 'm7') AND i < 5")
    assert some.rdd.getNumPartitions() == 3
    assert {(r.marker, r.i, r.j): r.v for r in some.collect()} == {("m0", a, b): float(images["b"][0, a, b]) for a in range(5) for b in range(20)}


def test_stack_without_its_markers_is_an_error(spark, folder):
    path, _ = folder
    (path / "a.markers.txt").write_text("m0 m1")
    with pytest.raises(Exception, match="2 markers"):
        stacks.read_stacks(spark, str(path)).count()


def test_written_stacks_are_read_again(spark, tmp_path):
    rows = [("s1", "r1", "x", 0, 1, 2.0), ("s1", "r1", "y", 2, 0, 3.5), ("s2", "r2", "x", 1, 1, 4.0), ("s2", "r2", "other", 1, 1, 9.0)]
    px = spark.createDataFrame(rows, "sample string, region string, marker string, i int, j int, v double")
    assert stacks.write_stacks(px, str(tmp_path / "out"), ["x", "y"], 3, 2).count() == 2
    got = stacks.read_stacks(spark, str(tmp_path / "out"))
    assert got.count() == 24 and sorted(map(tuple, got.where("v <> 0").collect())) == rows[:3]


def test_digests_of_nested_and_large_files(spark, tmp_path):
    (tmp_path / "one").mkdir()
    (tmp_path / "two" / "deep").mkdir(parents=True)
    for name, text in (("one/same.txt", "1"), ("two/same.txt", "22"), ("two/deep/same.txt", "")):
        (tmp_path / name).write_text(text)
    with open(tmp_path / "large.txt", "wb") as f:
        f.truncate(2_300_000_000)  # more than one value of a column may have
    zeros, want = bytes(10_000_000), hashlib.sha256()
    for _ in range(230):
        want.update(zeros)
    for path in (str(tmp_path), f"file://{tmp_path}/"):
        got = {r.path: (r.size_bytes, r.sha256) for r in files.build_manifest(spark, path, "*.txt").collect()}
        assert got == {"one/same.txt": (1, hashlib.sha256(b"1").hexdigest()), "two/same.txt": (2, hashlib.sha256(b"22").hexdigest()), "two/deep/same.txt": (0, hashlib.sha256(b"").hexdigest()), "large.txt": (2_300_000_000, want.hexdigest())}


def test_contracts_in_the_pass_that_writes(spark, tmp_path):
    df = spark.range(100).select("id", F.when(F.col("id") != 7, F.col("id") % 3).alias("k"))
    good = {"low": F.col("k") < 3, "order": F.col("id") >= 0}
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    assert contracts.write_checked(df.where("id <> 7"), str(tmp_path / "good"), good, 99) == {"rows": 99, "low": 0, "order": 0}
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) == len(before) + 1  # one job for all of them
    with pytest.raises(contracts.ContractError, match="'low': 1"):
        contracts.write_checked(df, str(tmp_path / "bad"), good)
    with pytest.raises(contracts.ContractError, match="rows"):
        contracts.write_checked(df.where("id < 5"), str(tmp_path / "few"), good, 6)
    assert (tmp_path / "good").exists() and not (tmp_path / "bad").exists() and not (tmp_path / "few").exists()


def plain_kmeans(x, c):
    while True:
        at = ((x[:, None] - c) ** 2).sum(2).argmin(1)
        new = np.array([x[at == n].mean(0) if (at == n).any() else c[n] for n in range(len(c))])
        if ((new - c) ** 2).sum() <= 1e-4 * x.var(0).mean():
            return ((x - c[at]) ** 2).sum()
        c = new


def test_k_means_with_all_starts(spark):
    """The cheapest of the starts, each as plain Lloyd steps from the same centroids give it; fits for several k go together."""
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(m, 0.3, (60, 2)) for m in ((0, 0), (4, 0), (0, 4), (4, 4), (9, 9))])
    rows = spark.createDataFrame([(n, [float(a), float(b)]) for n, (a, b) in enumerate(x)], "cell_id int, features array<double>").repartition(4)
    fits = cluster.fit_many(rows, [2, 5], starts=6)
    sample = np.array([r[0] for r in rows.orderBy(F.xxhash64("features", F.lit(0)), "features").select("features").collect()])
    for k, (centroids, cost) in fits.items():
        costs = [plain_kmeans(x, cluster._first_centroids(sample, k, np.random.default_rng([0, i, k]))) for i in range(6)]
        assert cost == pytest.approx(min(costs)) and len(centroids) == k
        at = cluster.assign(rows, centroids)
        assert at.agg(F.sum("distance2")).first()[0] == pytest.approx(cost)
    assert fits[5][1] < 5 * 60 * 2 * 0.3**2 * 1.3
