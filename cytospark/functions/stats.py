"""Paired tests and correlations: moments and ranks in Spark, p-values by short numerics on the few resulting rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..sources.scratch import materialize
from .columns import ratio
from .order import average_ranks, counts_below, same_keys


def incomplete_beta(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function, by Lentz's continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, c, d = 1e-300, 1.0, 1 / max(1 - (a + b) * x / (a + 1), 1e-300)
    out = d
    for m in range(1, 300):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + num * d or tiny)
            c = 1 + num / c or tiny
            out *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * out


def t_pvalue(t: float | None, df: float | None, side: str) -> float | None:
    """P of Student's t; None where t is missing."""
    if t is None or df is None or math.isnan(t) or df < 1:
        return None
    half = 0.0 if math.isinf(t) else incomplete_beta(df / 2, 0.5, df / (df + t * t)) / 2
    return {"two-sided": 2 * half, "greater": half if t > 0 else 1 - half, "less": half if t < 0 else 1 - half}[side]


def t_p(t: Column, df: Column, side: str = "two-sided") -> Column:
    @pandas_udf("double")
    def p(t: pd.Series, df: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(a) or pd.isna(b) else t_pvalue(float(a), float(b), side) for a, b in zip(t, df, strict=True)], dtype="float64")

    return p(t.cast("double"), df.cast("double"))


def signed_rank_pvalue(w: float, n: int, ties: float, exact: bool) -> float | None:
    """Two-sided P of the smaller rank sum: by all sign patterns if exact, else normal with tie correction."""
    if n < 1:
        return None
    if exact:
        ways = [1] + [0] * (n * (n + 1) // 2)
        for rank in range(1, n + 1):
            for s in range(len(ways) - 1, rank - 1, -1):
                ways[s] += ways[s - rank]
        return min(1.0, 2 * sum(ways[: int(w) + 1]) / 2**n)
    variance = n * (n + 1) * (2 * n + 1) / 24 - ties / 48
    return None if variance <= 0 else math.erfc(abs(w - n * (n + 1) / 4) / math.sqrt(variance) / math.sqrt(2))


def pairs_of(df: DataFrame, by: Sequence[str], unit: str, group: str, groups: tuple[str, str], metric: str) -> DataFrame:
    """(by, unit, a, b): the metric of both groups for each unit that has both."""
    wide = df.where(F.col(group).isin(list(groups))).groupBy(*by, unit).agg(*[F.max(F.when(F.col(group) == g, F.col(metric))).alias(n) for g, n in zip(groups, "ab", strict=True)])
    return wide.dropna(subset=["a", "b"])


def paired_t(df: DataFrame, group: str, groups: tuple[str, str], metric: str, by: Sequence[str] = (), unit: str = "lnp_region") -> DataFrame:
    """(by, n_regions, df, t, mean_a, mean_b) of a - b. Fewer than two units give nulls; a constant difference gives an infinite t, or null for zero."""
    d = F.col("a") - F.col("b")
    out = pairs_of(df, by, unit, group, groups, metric).groupBy(*by).agg(F.count(F.lit(1)).alias("n_regions"), F.avg("a").alias("mean_a"), F.avg("b").alias("mean_b"), F.avg(d).alias("__m"), F.stddev_samp(d).alias("__s"))
    enough = F.col("n_regions") >= 2
    flat = F.when(F.col("__m") > 0, F.lit(float("inf"))).when(F.col("__m") < 0, F.lit(float("-inf")))
    t = F.when(enough & (F.col("__s") > 0), F.try_divide(F.col("__m") * F.sqrt("n_regions"), F.col("__s"))).when(enough, flat)
    return out.select(*by, "n_regions", F.when(enough, F.col("n_regions") - 1).alias("df"), t.alias("t"), "mean_a", "mean_b")


def paired_t_test(df: DataFrame, group: str, groups: tuple[str, str], metric: str, by: Sequence[str] = (), side: str = "two-sided", unit: str = "lnp_region") -> DataFrame:
    out = paired_t(df, group, groups, metric, by, unit)
    return out.withColumn("p_value", t_p(F.col("t"), F.col("df"), side)).withColumn("p_text", p_text("p_value"))


def signed_rank(df: DataFrame, group: str, groups: tuple[str, str], metric: str, by: Sequence[str] = (), unit: str = "lnp_region") -> DataFrame:
    """(by, n, w, ties, has_ties): Wilcoxon's smaller rank sum of a - b, without zeros; tied sizes share their mean rank."""
    d = pairs_of(df, by, unit, group, groups, metric).withColumn("d", F.round(F.col("a") - F.col("b"), 9)).where("d <> 0").withColumn("size", F.abs("d"))
    # differences of one size share a rank, so that sizes are all that has to be ordered
    up = F.sum(F.when(F.col("d") > 0, 1).otherwise(0))
    sides = materialize(d.groupBy(*by, "size").agg(up.alias("up"), F.count(F.lit(1)).alias("tied")), "sizes")
    ranks = counts_below(d, by, "size").withColumn("rank", F.col("below") + (F.col("n") + 1) / 2).select(*by, "size", "rank")
    sides = sides.alias("a").join(ranks.alias("b"), same_keys([*by, "size"], "a", "b")).select("a.*", "b.rank")
    weigh = lambda n: F.sum(n * F.col("rank"))
    out = sides.groupBy(*by).agg(F.coalesce(F.sum("tied"), F.lit(0)).alias("n"), weigh(F.col("up")).alias("up"), weigh(F.col("tied") - F.col("up")).alias("down"), F.sum(((F.col("tied") * F.col("tied") - 1) * F.col("tied")).cast("double")).alias("ties"))
    return out.select(*by, "n", F.least("up", "down").alias("w"), "ties", (F.col("ties") > 0).alias("has_ties"))


def signed_rank_test(df: DataFrame, group: str, groups: tuple[str, str], metric: str, by: Sequence[str] = (), unit: str = "lnp_region") -> DataFrame:
    """With p: exact for up to 50 units without ties, else by the normal approximation."""

    @pandas_udf("double")
    def p(w: pd.Series, n: pd.Series, ties: pd.Series) -> pd.Series:
        return pd.Series([signed_rank_pvalue(float(a), int(b), float(c), c == 0 and b <= 50) for a, b, c in zip(w, n, ties, strict=True)], dtype="float64")

    return signed_rank(df, group, groups, metric, by, unit).withColumn("p_value", p("w", "n", "ties"))


def pearson(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, n, r) from moments; null for a constant column."""
    n, sx, sy = F.count(F.lit(1)).cast("double"), F.sum(x), F.sum(y)
    cov = n * F.sum(F.col(x) * F.col(y)) - sx * sy
    vx, vy = n * F.sum(F.col(x) * F.col(x)) - sx * sx, n * F.sum(F.col(y) * F.col(y)) - sy * sy
    spread = F.when((vx > 1e-12) & (vy > 1e-12), F.sqrt(vx * vy))
    return df.dropna(subset=[x, y]).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.try_divide(cov, spread).alias("r"))


def spearman(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    ranked = average_ranks(average_ranks(df.dropna(subset=[x, y]), x, "__rx", by), y, "__ry", by)
    return pearson(ranked, "__rx", "__ry", by).withColumnRenamed("r", "rho")


def correlation_p(r: Column, n: Column) -> Column:
    """Two-sided P of a correlation by t with n - 2 degrees of freedom."""
    t = F.when(F.abs(r) >= 1, F.lit(float("inf"))).otherwise(r * F.sqrt(ratio(n - 2, 1 - r * r)))
    return t_p(t, n - 2)


def p_text(c: str) -> Column:
    """How a P is printed."""
    p = F.col(c)
    return F.when(p.isNull(), "P = NA").when(p < 1e-4, "P < 0.0001").when(p < 1e-3, F.format_string("P = %.2e", p)).otherwise(F.format_string("P = %.3f", p))
