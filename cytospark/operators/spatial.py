"""Exact neighbour joins in the plane within a radius, by bucket equi-joins, and nearest one, by `knn`, which has the k nearest.

What meets in a bucket is bounded: where more than `BLOCK` targets or reference points share one, they are dealt to parts by id, and each part of the targets meets each part of the points.
The number of tasks follows the pairs, which grow with the square of the points, and not the shuffle.

Points are rows with an id, x, y and a group column that neighbours share; coordinates must not be null. Ties are broken by id.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .knn import knn_lists, knn_pairs

#: Targets of a bucket that stay together, and reference points of each of the nine buckets around it.
BLOCK = 4096
#: Pairs of a bucket and the nine around it that a task goes through, about.
TASK = 1 << 25

__all__ = ["keep_nearest", "knn_pairs", "nearest_within", "radius_pairs", "tile_of"]


def _around(bucket: str) -> Column:
    return F.explode(F.sequence(F.col(bucket) - 1, F.col(bucket) + 1))


def _nine(buckets: DataFrame) -> DataFrame:
    """Each row in the nine buckets (bx, by) from which b0 and b1 may be reached."""
    return buckets.withColumn("bx", _around("b0")).withColumn("by", _around("b1")).drop("b0", "b1")


def _counts(left: DataFrame, reference: DataFrame, group: str) -> DataFrame:
    """(group, b0, b1, l, r): targets and reference points of each bucket."""
    sides = left.select(group, F.col("bx").alias("b0"), F.col("by").alias("b1"), F.lit(1).alias("l")).unionByName(reference.select(group, "b0", "b1", F.lit(0).alias("l")))
    return materialize(sides.groupBy(group, "b0", "b1").agg(F.sum("l").alias("l"), F.sum(1 - F.col("l")).alias("r")), "buckets")


def _parts(counts: DataFrame, group: str) -> DataFrame:
    """(group, bx, by, left_parts, right_parts) of crowded buckets: to how many parts their targets and the points around them are dealt."""
    parts = lambda c: F.ceil(F.col(c) / BLOCK).cast("int").alias(c)
    crowded = counts.select(group, "b0", "b1", parts("l"), parts("r")).where("l > 1 or r > 1")
    around = _nine(crowded.withColumns({"own0": F.col("b0"), "own1": F.col("b1")}))
    own = F.max(F.when((F.col("bx") == F.col("own0")) & (F.col("by") == F.col("own1")), F.col("l")))
    most = around.groupBy(group, "bx", "by").agg(F.greatest(own, F.lit(1)).alias("left_parts"), F.greatest(F.max("r"), F.lit(1)).alias("right_parts"))
    return materialize(most, "parts")


def _dealt(points: DataFrame, parts: DataFrame, on: list[str], key: str, side: str, other: str) -> DataFrame:
    """Points with their part on their side, once for each part of the other; buckets that aren't crowded have one part."""
    n = lambda c: F.coalesce(c, F.lit(1))
    out = points.join(parts, on, "left").withColumn(side, F.pmod(F.xxhash64(key), n(side)).cast("int"))
    return out.withColumn(other, F.explode(F.sequence(F.lit(0), n(other) - 1)))


def radius_pairs(targets: DataFrame, reference: DataFrame, radius: float, group: str = "lnp_region", target_id: str = "cell_id", ref_id: str = "cell_id", keep: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """(group, target_id, neighbor_id, distance, neighbor_<keep>) of all pairs within the radius (or, strict, below it)."""
    h = F.lit(float(radius))
    on = [group, "bx", "by"]
    left = targets.select(group, F.col(target_id).alias("target_id"), F.col("x").alias("tx"), F.col("y").alias("ty"), F.floor(F.col("x") / h).alias("bx"), F.floor(F.col("y") / h).alias("by"))
    right = reference.select(group, F.col(ref_id).alias("neighbor_id"), F.col("x").alias("nx"), F.col("y").alias("ny"), *[F.col(c).alias(f"neighbor_{c}") for c in keep], F.floor(F.col("x") / h).alias("b0"), F.floor(F.col("y") / h).alias("b1"))
    counts = _counts(left, right, group)
    most, pairs = counts.agg(F.max(F.greatest("l", "r")), F.sum(F.col("l") * F.col("r").cast("double"))).first()
    right = _nine(right)
    if (most or 0) > BLOCK:
        parts = _parts(counts, group)
        left, right = _dealt(left, parts, on, "target_id", "left_parts", "right_parts"), _dealt(right, parts, on, "neighbor_id", "right_parts", "left_parts")
        right, on = right.toDF(*right.columns), [*on, "left_parts", "right_parts"]
    tasks = ceil(9 * (pairs or 0) / TASK)
    if tasks > targets.sparkSession.sparkContext.defaultParallelism:
        left, right = left.repartition(tasks, *on), right.repartition(tasks, *on)
    pairs = left.join(right, on)
    d2 = (F.col("tx") - F.col("nx")) * (F.col("tx") - F.col("nx")) + (F.col("ty") - F.col("ny")) * (F.col("ty") - F.col("ny"))
    distance = F.sqrt(d2)
    near = distance < radius if strict else distance <= radius
    return pairs.where(near).select(group, "target_id", "neighbor_id", distance.alias("distance"), *[f"neighbor_{c}" for c in keep])


def nearest_within(targets: DataFrame, reference: DataFrame, radius: float, group: str = "lnp_region", target_id: str = "cell_id", ref_id: str = "cell_id") -> DataFrame:
    """(group, target_id, neighbor_id, distance): the nearest reference point below the radius, of equal ones the smallest id. Ids are unique within their group.

    No pairs are listed, which would grow with the square of the points.
    """
    points = lambda df, key: df.select(group, F.col(key).alias("cell_id"), "x", "y")
    lists = knn_lists(points(targets, target_id), points(reference, ref_id), 1, group, exclude_self=False, radius=float(radius))
    best = lists.where(F.size("near") > 0).select(group, "target_id", F.element_at("near", 1).alias("n"))
    return best.select(group, "target_id", "n.neighbor_id", F.sqrt("n.d2").alias("distance")).where(F.col("distance") < radius)


def keep_nearest(pairs: DataFrame, neighbor: str = "neighbor_id") -> DataFrame:
    """Each neighbour with its nearest target only, whatever the group; equal ones by target."""
    return pairs.withColumn("__n", F.row_number().over(W.partitionBy(neighbor).orderBy("distance", "target_id"))).where("__n = 1").drop("__n")


def tile_of(df: DataFrame, size: float) -> DataFrame:
    return df.withColumn("tile_x", F.floor(F.col("x") / size)).withColumn("tile_y", F.floor(F.col("y") / size))
