"""Recurrent neighbourhoods: k-means over compositions, assignment, names, merges and what they are made of."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import percent, ratio
from ..sources.scratch import materialize
from .relational import cross_share, share, top_one

#: Rows among which k-means chooses its first centroids.
SEEDS = 10_000


def to_array(long: DataFrame, key: str, kind: str, value: str, order: Sequence[str]) -> DataFrame:
    """(key, features): the long form as an array in the order of the types, absent ones 0."""
    by_type = long.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(kind, value))).alias("m"))
    return by_type.select(key, F.array(*[F.coalesce(F.try_element_at("m", F.lit(t)), F.lit(0.0)) for t in order]).alias("features"))


def _first_centroids(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ on the sample: each next one with a chance in proportion to its squared distance to those before."""
    chosen = [int(rng.integers(len(sample)))]
    d2 = ((sample - sample[chosen[0]]) ** 2).sum(1)
    while len(chosen) < k:
        total = d2.sum()
        chosen.append(int(rng.choice(len(sample), p=d2 / total)) if total > 0 else int(rng.integers(len(sample))))
        d2 = np.minimum(d2, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def _lloyd(models):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(model, cluster, n, cost, sums) of all models over a task's rows."""
        found: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            column = batch.column("v")
            if not len(column):
                continue
            x = column.flatten().to_numpy().reshape(len(column), -1)
            for m, c in models.value.items():
                d2 = np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 0)
                at = d2.argmin(1)
                n = np.bincount(at, minlength=len(c))
                cost = np.bincount(at, ((x - c[at]) ** 2).sum(1), len(c))
                sums = np.column_stack([np.bincount(at, x[:, d], len(c)) for d in range(x.shape[1])])
                found[m] = [a + b for a, b in zip(found[m], (n, cost, sums), strict=True)] if m in found else [n, cost, sums]
        for m, (n, cost, sums) in found.items():
            k = len(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(k, m, np.int32)), pa.array(np.arange(k, dtype=np.int32)), pa.array(n.astype(np.int64)), pa.array(cost), pa.array(list(sums), pa.list_(pa.float64()))], ["model", "cluster", "n", "cost", "sums"])

    return run


def fit_many(rows: DataFrame, ks: Sequence[int], starts: int = 10, seed: int = 0, features: str = "features", steps: int = 300, tolerance: float = 1e-4) -> dict[int, tuple[list[list[float]], float]]:
    """For each k the centroids of the cheapest of `starts` k-means runs, and their cost.

    All starts of all k go through the rows together: a step is one aggregation, of a row for each centroid and task. Runs leave when their centroids move by less than the tolerance (a part of
    the mean variance). First centroids are chosen by k-means++ among `SEEDS` rows, those of the least hash. There are k rows at least.
    """
    spark = rows.sparkSession
    vectors = materialize(rows.select(F.col(features).cast("array<double>").alias("v")), "vectors")
    sample = np.array([r[0] for r in vectors.orderBy(F.xxhash64("v", F.lit(seed)), "v").limit(SEEDS).collect()])
    models = {(i, k): _first_centroids(sample, k, np.random.default_rng([seed, i, k])) for k in ks for i in range(starts)}
    close = tolerance * float(sample.var(0).mean())
    live, done = list(models), {}
    for step in range(steps):
        sent = spark.sparkContext.broadcast({n: models[m] for n, m in enumerate(live)})
        found = vectors.mapInArrow(_lloyd(sent), "model int, cluster int, n bigint, cost double, sums array<double>")
        sums = [F.sum(F.col("sums")[d]).alias(f"s{d}") for d in range(sample.shape[1])]
        totals: dict[int, list] = {}
        for r in found.groupBy("model", "cluster").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), *sums).collect():
            totals.setdefault(r.model, []).append(r)
        still = []
        for n, m in enumerate(live):
            new, cost = models[m].copy(), 0.0
            for r in totals[n]:
                cost += r.cost
                if r.n:  # a centroid without rows stays where it is
                    new[r.cluster] = np.array(r[4:]) / r.n
            done[m] = (models[m], cost)
            if ((new - models[m]) ** 2).sum() > close and step < steps - 1:
                models[m] = new
                still.append(m)
        live = still
        if not live:
            break
    best = {k: min((done[i, k] for i in range(starts)), key=lambda x: x[1]) for k in ks}
    return {k: ([list(map(float, c)) for c in centroids], float(cost)) for k, (centroids, cost) in best.items()}


def fit_centroids(rows: DataFrame, k: int, seed: int = 0, tries: int = 20, features: str = "features") -> tuple[list[list[float]], float]:
    """The centroids of the cheapest of several k-means runs, and their cost; k rows of doubles."""
    return fit_many(rows, [k], tries, seed, features)[k]


def assign(rows: DataFrame, centroids: Sequence[Sequence[float]], features: str = "features") -> DataFrame:
    """`cluster` (0 up): the nearest centroid, of equally near ones the first, and `distance2`."""
    table = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centroids])
    point = F.col(features).cast("array<double>")
    cost = F.transform(table, lambda c: F.aggregate(F.zip_with(point, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
    rows = rows.withColumn("__cost", cost)
    return rows.withColumn("distance2", F.array_min("__cost")).withColumn("cluster", (F.array_position("__cost", F.col("distance2")) - 1).cast("int")).drop("__cost")


def elbow(rows: DataFrame, ks: Sequence[int], most: int = 250_000, seed: int = 0, key: str = "cell_id") -> DataFrame:
    """(k, inertia, inertia_per_sample, relative_reduction) for each 1 < k < n, on the `most` rows of the least hash: an elbow needs no more."""
    spark = rows.sparkSession
    sample = materialize(rows.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(most), "elbow")
    n = sample.count()
    fits = fit_many(sample, [k for k in ks if 1 < k < n], 10, seed) if any(1 < k < n for k in ks) else {}
    costs = [(k, cost) for k, (_, cost) in fits.items()]
    out = spark.createDataFrame(costs, "k int, inertia double").withColumn("inertia_per_sample", F.col("inertia") / max(n, 1))
    before = F.lag("inertia").over(W.orderBy("k"))
    return out.withColumn("relative_reduction", ratio(before - F.col("inertia"), before))


def sizes(assigned: DataFrame, k: int) -> DataFrame:
    """(cluster, n_cells, pct_cells), empty clusters included."""
    spark = assigned.sparkSession
    grid = spark.range(k).select(F.col("id").cast("int").alias("cluster"))
    counts = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_cells"))
    return share(F.broadcast(grid).join(counts, "cluster", "left").fillna(0, ["n_cells"]), "n_cells", [], "pct_cells")


def cluster_means(assigned: DataFrame, order: Sequence[str], features: str = "features") -> DataFrame:
    """(cluster, type, mean): the mean feature of each cluster, long."""
    wide = assigned.groupBy("cluster").agg(*[F.avg(F.col(features)[i]).alias(f"c{i}") for i in range(len(order))])
    pairs = F.explode(F.array(*[F.struct(F.lit(t).alias("cell_type"), F.col(f"c{i}").alias("mean")) for i, t in enumerate(order)])).alias("p")
    return wide.select("cluster", pairs).select("cluster", "p.cell_type", "p.mean")


def composition_percent(means: DataFrame, by: str = "cluster") -> DataFrame:
    """Means as percent of their cluster's sum."""
    return means.withColumn("pct", percent("mean", F.sum("mean").over(W.partitionBy(by))))


def fold_change(means: DataFrame, background: DataFrame) -> DataFrame:
    """log2(((mean + b) / sum(mean + b)) / b), b the type's share of all cells (cell_type, b)."""
    out = means.join(background, "cell_type").withColumn("__v", F.col("mean") + F.col("b"))
    value = ratio(F.col("__v") / F.sum("__v").over(W.partitionBy("cluster")), F.col("b"))
    return out.select("cluster", "cell_type", F.when(value > 0, F.log2(value)).alias("log2_fold_change"))


def dominant_names(pct: DataFrame) -> DataFrame:
    """(cluster, name): `<type> enriched`, of equal types the first by name."""
    top = top_one(pct, ["cluster"], F.desc_nulls_last("pct"), F.asc("cell_type"))
    return top.select("cluster", F.concat("cell_type", F.lit(" enriched")).alias("name"))


def ranked_names(pct: DataFrame, manual: dict[int, str] | None = None) -> DataFrame:
    """(cluster, name): `N01: A + B-rich` from the two largest types, unless a manual name is given."""
    ranked = pct.withColumn("__n", F.row_number().over(W.partitionBy("cluster").orderBy(F.desc_nulls_last("pct"), "cell_type"))).where("__n <= 2")
    two = ranked.groupBy("cluster").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__n", "cell_type"))), lambda s: s["cell_type"]), " + ").alias("__t"))
    auto = F.concat(F.format_string("N%02d: ", F.col("cluster") + 1), F.col("__t"), F.lit("-rich"))
    given = {k: v for k, v in (manual or {}).items() if v}
    own = F.create_map(*[F.lit(x) for kv in given.items() for x in kv]) if given else None
    return two.select("cluster", (F.coalesce(F.try_element_at(own, F.col("cluster")), auto) if given else auto).alias("name"))


def merge_named(pct: DataFrame, names: DataFrame, weights: DataFrame) -> DataFrame:
    """(name, type, pct): clusters of one name as their average, weighted by cells; 0 if they have none."""
    rows = pct.join(F.broadcast(names), "cluster").join(F.broadcast(weights.select("cluster", "n_cells")), "cluster")
    return rows.groupBy("name", "cell_type").agg(F.coalesce(F.try_divide(F.sum(F.col("pct") * F.col("n_cells")), F.sum("n_cells").cast("double")), F.lit(0.0)).alias("pct"))


def names_by_size(names: DataFrame, weights: DataFrame) -> DataFrame:
    """(name, n_cells, place): larger first, of equal ones the first cluster."""
    total = names.join(weights.select("cluster", "n_cells"), "cluster").groupBy("name").agg(F.sum("n_cells").alias("n_cells"), F.min("cluster").alias("first"))
    return total.select("name", "n_cells", F.row_number().over(W.orderBy(F.desc("n_cells"), "first")).alias("place"))


def tissue_enrichment(named: DataFrame, cells: DataFrame, kind: str = "cell_type") -> DataFrame:
    """(name, type, log2_enrichment) against the type's percent of all cells; minus infinity for a share of zero."""
    tissue = share(cells.groupBy(kind).agg(F.count(F.lit(1)).alias("n")), "n", [], "__tissue").select(kind, "__tissue")
    value = ratio("pct", "__tissue")
    log: Column = F.when(value == 0, F.lit(float("-inf"))).otherwise(F.log2(value))
    return named.join(tissue, kind).select("name", kind, log.alias("log2_enrichment"))


def abundance_difference(cells: DataFrame, label: str = "name") -> DataFrame:
    """(name, pct_negative, pct_positive, difference): how positive and negative cells spread over the names."""
    long = cross_share(cells.where(F.col(label).isNotNull()), label, "lnp_positive")
    wide = long.groupBy(label).agg(*[F.coalesce(F.max(F.when(F.col("lnp_positive") == v, F.col("pct"))), F.lit(0.0)).alias(n) for v, n in ((False, "pct_negative"), (True, "pct_positive"))])
    return wide.withColumn("difference", F.col("pct_positive") - F.col("pct_negative"))
