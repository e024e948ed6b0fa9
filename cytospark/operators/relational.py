"""Grids, shares, tops and reshapes over grouped tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import percent


def dimension(spark: SparkSession, name: str, values: Iterable[str]) -> DataFrame:
    """A column of values with `<name>_ordinal`, their place."""
    return spark.createDataFrame(list(enumerate(values)), f"{name}_ordinal int, {name} string")


def complete_grid(counts: DataFrame, keys: Sequence[str], grid: DataFrame, fill: Sequence[str]) -> DataFrame:
    """Each row of the grid of keys with its counts, 0 where there are none. The grid is a dimension."""
    return grid.join(counts, list(keys), "left").fillna(0, list(fill))


def share(df: DataFrame, count: str, by: Sequence[str], alias: str, total: str | None = None) -> DataFrame:
    """The percentage that `count` has of its group's sum; null where that is zero."""
    sums = F.sum(count).over(W.partitionBy(*by)) if by else F.sum(count).over(W.partitionBy())
    if total:
        df, sums = df.withColumn(total, sums), F.col(total)
    return df.withColumn(alias, percent(count, sums))


def top_categories(df: DataFrame, column: str, weight: str | Column, n: int) -> DataFrame:
    """The n values of the largest total weight; equal totals by value."""
    weight = F.col(weight) if isinstance(weight, str) else weight
    return df.groupBy(column).agg(F.sum(weight).alias("__w")).orderBy(F.desc("__w"), column).limit(n).select(column)


def top_one(df: DataFrame, by: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each group."""
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where("__n = 1").drop("__n")


def value_counts(df: DataFrame, column: str, keep_null: bool = False) -> DataFrame:
    """(value, n_cells)."""
    return (df if keep_null else df.where(F.col(column).isNotNull())).groupBy(column).agg(F.count(F.lit(1)).alias("n_cells"))


def pivot_unique(df: DataFrame, index: Sequence[str], column: str, values: Sequence[str], value: str) -> DataFrame:
    """Wide form of unique keys; the columns are given, so that no job looks for them."""
    return df.groupBy(*index).pivot(column, list(values)).agg(F.first(value))


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def cross_share(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """(rows, columns, n, pct): a cross table in percent of each column."""
    counts = df.groupBy(rows, columns).agg(F.count(F.lit(1)).alias("n"))
    return share(counts, "n", [columns], "pct")


def merge_report(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(_merge, n): how many keys are on both sides, or on one."""
    a = left.select(*keys).withColumn("__l", F.lit(True))
    b = right.select(*keys).withColumn("__r", F.lit(True))
    side = F.when(F.col("__l") & F.col("__r"), "both").when(F.col("__l"), "left_only").otherwise("right_only")
    return a.join(b, list(keys), "full_outer").groupBy(side.alias("_merge")).agg(F.count(F.lit(1)).alias("n"))


def anti_count(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(n): rows of `left` without a partner."""
    return left.join(right, list(keys), "left_anti").agg(F.count(F.lit(1)).alias("n"))


def relabel(df: DataFrame, column: str, mapping: dict[str, str], alias: str) -> DataFrame:
    """Values of a small map; others as they are."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]) if mapping else None
    return df.withColumn(alias, F.coalesce(F.try_element_at(pairs, F.col(column)), F.col(column)) if mapping else F.col(column))


def dense_labels(df: DataFrame, by: Sequence[str], label: str, alias: str) -> DataFrame:
    """Labels from 1 in each group, without gaps."""
    return df.withColumn(alias, F.dense_rank().over(W.partitionBy(*by).orderBy(label)))


def union_columns(*frames: DataFrame) -> DataFrame:
    """All rows; columns that a frame lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def set_difference(spark: SparkSession, df: DataFrame, column: str, expected: Iterable[str]) -> DataFrame:
    """(value, side): values that are expected but missing, or there but unexpected."""
    want = dimension(spark, column, expected).select(column)
    have = df.select(column).distinct()
    return want.join(have, column, "left_anti").withColumn("side", F.lit("missing")).unionByName(have.join(want, column, "left_anti").withColumn("side", F.lit("unexpected")))
