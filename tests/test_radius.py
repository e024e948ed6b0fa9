"""Radius joins on crowded buckets, against brute force."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cytospark.operators import spatial


def crowded(n: int = 900) -> pd.DataFrame:
    """Even points, a tight cluster over the corner of four buckets, a pile at one place, a lattice with distances of the radius, and two regions."""
    rng = np.random.default_rng(6)
    xy = rng.random((n, 2)) * 80 - 40
    xy[: n // 3] = rng.normal(0, 0.5, (n // 3, 2))
    xy[n // 3 : n // 2] = 22.0
    xy[n // 2 : 2 * n // 3] = np.round(xy[n // 2 : 2 * n // 3] / 5) * 5
    return pd.DataFrame({"lnp_region": np.where(np.arange(n) % 3 == 0, "a", "b"), "cell_id": np.arange(n), "x": xy[:, 0], "y": xy[:, 1], "kind": np.arange(n) % 7})


@pytest.mark.parametrize("strict", [False, True])
def test_crowded_buckets(spark, monkeypatch, strict):
    monkeypatch.setattr(spatial, "BLOCK", 20, raising=False)
    cells = crowded()
    targets, points = cells[cells.cell_id % 5 < 2], cells[cells.cell_id % 5 > 0]
    both = targets.merge(points, on="lnp_region", suffixes=("", "_n"))
    d = np.sqrt((both.x - both.x_n) ** 2 + (both.y - both.y_n) ** 2)
    near = both[d < 5 if strict else d <= 5]
    want = Counter(zip(near.lnp_region, near.cell_id, near.cell_id_n, near.kind_n, d[near.index]))
    got = spatial.radius_pairs(spark.createDataFrame(targets), spark.createDataFrame(points), 5.0, keep=("kind",), strict=strict).collect()
    assert Counter((r.lnp_region, r.target_id, r.neighbor_id, r.neighbor_kind, r.distance) for r in got) == want
    assert (both[d == 5].size > 0) and len(want) > 20_000


def test_no_task_has_a_crowded_bucket(spark, monkeypatch):
    """All points are in one bucket: its pairs are made in several tasks, of one join each."""
    monkeypatch.setattr(spatial, "BLOCK", 20, raising=False)
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        points = spark.range(400).select(F.col("id").alias("cell_id"), F.lit("r").alias("lnp_region"), (F.col("id") % 20 / 20).alias("x"), (F.col("id") % 7 / 7).alias("y"))
        pairs = spatial.radius_pairs(points, points, 5.0)
        rows = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(rows) == 400 * 400
    assert len(rows) == 4 and max(rows) < 80_000


def test_tasks_follow_the_pairs(spark, monkeypatch):
    """Four times the pairs in the same buckets are made by about four times the tasks, and none has much more."""
    monkeypatch.setattr(spatial, "TASK", 20_000, raising=False)
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = []
        for n in (2000, 4000):
            points = spark.range(n).select(F.col("id").alias("cell_id"), F.expr("concat('r', id % 1)").alias("lnp_region"), (F.col("id") * 37 % 100).cast("double").alias("x"), (F.col("id") * 61 % 97).cast("double").alias("y"))
            pairs = spatial.radius_pairs(points, points, 5.0)
            found.append((pairs.rdd.getNumPartitions(), [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]))
            xy = points.select("x", "y").toPandas().to_numpy()
            assert sum(found[-1][1]) == (((xy[:, None] - xy) ** 2).sum(2) <= 25).sum()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    (few, small), (many, large) = found
    assert few > 4 and many > 3.5 * few
    assert max(large) < 1.5 * max(small) and max(large) < 20_000
