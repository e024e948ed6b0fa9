"""Ranks and exact quantiles without a task that has all rows of a group.

Ranks come from counts by value, dealt out by range: each part counts its rows, and the parts' offsets are sums over one row a part. Quantiles come from histograms that are refined
only where the wanted rows lie; what is shuffled is a count for each bin and task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import materialize

#: Bins of a histogram, and rows up to which a group's values may be in one buffer.
BINS, SMALL = 1024, 65_536
_LARGEST = 1.7976931348623157e308


def same_keys(by: Sequence[str], a: str, b: str):
    out = F.lit(True)
    for c in by:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def counts_below(df: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """(by, column, n, below, distinct_below): how often each value occurs in its group, how many rows of the group are smaller, and how many other values. Nulls aren't counted."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("n"))
    # a value is in one part, so that ties don't cross borders
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counts = materialize(counts.repartitionByRange(parts, *by, column).withColumn("__part", F.spark_partition_id()), "counts")
    totals = counts.groupBy(*by, "__part").agg(F.sum("n").alias("__n"), F.count(F.lit(1)).alias("__d"))
    before = W.partitionBy(*by).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)  # a row for each part of the group
    start = totals.select(*by, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n0"), F.coalesce(F.sum("__d").over(before), F.lit(0)).alias("__d0"))
    here = W.partitionBy(*by, "__part").orderBy(column).rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("below", F.coalesce(F.sum("n").over(here), F.lit(0))).withColumn("distinct_below", F.coalesce(F.count("n").over(here), F.lit(0)))
    out = counts.alias("a").join(start.alias("b"), same_keys([*by, "__part"], "a", "b"))
    return out.select(*[F.col(f"a.{c}") for c in (*by, column)], "n", (F.col("below") + F.col("__n0")).alias("below"), (F.col("distinct_below") + F.col("__d0")).alias("distinct_below"))


def _joined(df: DataFrame, by: Sequence[str], column: str, more: dict) -> DataFrame:
    counts = materialize(counts_below(df, by, column).select(*by, column, *[e.alias(n) for n, e in more.items()]), "ranks")  # written, so that Spark may split the join with frequent values
    out = df.alias("a").join(counts.alias("b"), same_keys([*by, column], "a", "b"), "left")
    return out.select("a.*", *more)


def average_ranks(df: DataFrame, column: str, alias: str, by: Sequence[str] = ()) -> DataFrame:
    """Ranks from 1 within the group; equal values share the mean of their ranks, nulls have none."""
    return _joined(df, by, column, {alias: F.col("below") + (F.col("n") + 1) / 2})


def dense_ranks(df: DataFrame, column: str, alias: str, by: Sequence[str] = ()) -> DataFrame:
    """Ranks from 1 without gaps within the group; equal values share one, nulls have none."""
    return _joined(df, by, column, {alias: (F.col("distinct_below") + 1).cast("int")})


def quantiles(df: DataFrame, by: Sequence[str], value: str, qs: Sequence[float]) -> DataFrame:
    """(by, n, q0, q1, ...): exact quantiles of the values of each group, between neighbours in proportion; nulls don't count, and groups without values have no row.

    Both neighbours of a quantile are rows with a number in order. An interval is known to hold such a row, with a count of what is below; each round counts the interval's rows by
    `BINS` bins with the least and the largest of each, and goes on with the bin that holds the row, until that has one value. Where no group has more than `SMALL` rows, one aggregation does. Infinite values count as the largest doubles.
    """
    rows = df.select(*by, F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    rows = rows.withColumn("v", F.greatest(F.least("v", F.lit(_LARGEST)), F.lit(-_LARGEST)))
    whole = materialize(rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")), "extent")
    if (whole.agg(F.max("n")).first()[0] or 0) <= SMALL:
        return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.percentile("v", F.lit(float(q))).alias(f"q{i}") for i, q in enumerate(qs)])
    ends = F.explode(F.array(*[F.struct(F.lit(i).alias("q"), F.lit(e).alias("end"), f(F.lit(float(q)) * (F.col("n") - 1)).cast("bigint").alias("at")) for i, q in enumerate(qs) for e, f in enumerate((F.floor, F.ceil))])).alias("w")
    state = materialize(whole.select(*by, "n", "lo", "hi", F.lit(0).cast("bigint").alias("below"), ends).select(*by, "n", "lo", "hi", "below", "w.*"), "quantiles")
    while not (wanted := state.where("lo < hi")).isEmpty():
        intervals = wanted.select(*by, "lo", "hi").distinct()
        inside = rows.alias("a").join(intervals.alias("b"), same_keys(by, "a", "b") & F.col("a.v").between(F.col("b.lo"), F.col("b.hi")))
        # halves, as the width of an interval may be beyond the largest double
        share = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        bins = inside.select(*[F.col(f"a.{c}") for c in by], "lo", "hi", "v", F.least(F.lit(BINS - 1), F.floor(share * BINS)).alias("bin"))
        bins = bins.groupBy(*by, "lo", "hi", "bin").agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("v0"), F.max("v").alias("v1"))
        upto = W.partitionBy(*by, "lo", "hi").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
        bins = bins.withColumn("before", F.coalesce(F.sum("c").over(upto), F.lit(0)))
        hit = wanted.alias("a").join(bins.alias("b"), same_keys([*by, "lo", "hi"], "a", "b"))
        hit = hit.where((F.col("at") >= F.col("below") + F.col("before")) & (F.col("at") < F.col("below") + F.col("before") + F.col("c")))
        hit = hit.select(*[F.col(f"a.{c}") for c in by], "n", F.col("v0").alias("lo"), F.col("v1").alias("hi"), (F.col("below") + F.col("before")).alias("below"), "q", "end", "at")
        state = materialize(hit.unionByName(state.where("lo = hi")), "quantiles")
    pick = lambda i, e: F.max(F.when((F.col("q") == i) & (F.col("end") == e), F.col("lo")))
    out = state.groupBy(*by).agg(F.first("n").alias("n"), *[pick(i, e).alias(f"__{i}_{e}") for i in range(len(qs)) for e in (0, 1)])
    part = lambda q: F.lit(float(q)) * (F.col("n") - 1) - F.floor(F.lit(float(q)) * (F.col("n") - 1))
    return out.select(*by, "n", *[(F.col(f"__{i}_0") + (F.col(f"__{i}_1") - F.col(f"__{i}_0")) * part(q)).alias(f"q{i}") for i, q in enumerate(qs)])


def medians(df: DataFrame, by: Sequence[str], columns: dict[str, object]) -> DataFrame:
    """(by, alias, ...): the median of each named column expression in each group; null where a group has no value of it, no row where it has none at all."""
    named = F.explode(F.array(*[F.struct(F.lit(a).alias("__name"), c.cast("double").alias("__value")) for a, c in columns.items()])).alias("x")
    out = quantiles(df.select(*by, named).select(*by, "x.*"), [*by, "__name"], "__value", [0.5])
    return out.groupBy(*by).agg(*[F.max(F.when(F.col("__name") == a, F.col("q0"))).alias(a) for a in columns])


def joined(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """A left join on columns where nulls are equal; all columns of the left side, and those of the right that aren't keys."""
    out = left.alias("a").join(right.alias("b"), same_keys(by, "a", "b"), "left")
    return out.select("a.*", *[F.col(f"b.{c}") for c in right.columns if c not in by])
