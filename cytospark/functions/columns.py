"""Column expressions with the null and division rules that the analyses rely on."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Name = str | Column


def col(c: Name) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """NaN as null, so that comparisons are false and aggregates skip it."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns or df.columns if kinds[c] in ("double", "float")})


def coerce_double(c: Name) -> Column:
    """Anything that isn't a number becomes null."""
    value = col(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def above(value: Name, threshold: Name) -> Column:
    """value > threshold; false where either is missing."""
    return F.coalesce(col(value) > col(threshold), F.lit(False))


def ratio(a: Name, b: Name) -> Column:
    """a / b; null where b is zero."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def percent(a: Name, b: Name) -> Column:
    """100 * a / b; null where b is zero."""
    return F.try_divide(col(a).cast("double") * 100.0, col(b).cast("double"))


def sem(c: Name) -> Column:
    """Aggregate: standard error of the mean; 0 for fewer than two values."""
    n = F.count(col(c))
    return F.when(n <= 1, F.lit(0.0)).otherwise(F.stddev_samp(col(c)) / F.sqrt(n))


def quantile(c: Name, q: float) -> Column:
    """Aggregate: exact quantile, linear between ranks; null over nothing."""
    return F.percentile(col(c), F.lit(q))


def log2(c: Name) -> Column:
    """log2; null for values that aren't positive."""
    return F.when(col(c) > 0, F.log2(col(c)))


def region_key(slide: Name, region: Name) -> Column:
    """`S1_reg000` of a slide name that ends in `_registered_S1`, and a region."""
    return F.concat_ws("_", F.regexp_replace(col(slide), "^.*_registered_", ""), col(region))


def pool_cell_type(c: Name) -> Column:
    """All types that contain "epithelial", in any case, as Epithelial; trimmed."""
    trimmed = F.trim(col(c))
    return F.when(F.lower(trimmed).contains("epithelial"), F.lit("Epithelial")).otherwise(trimmed)


def lineage(c: Name) -> Column:
    """B, T, DC or Macrophage by the name's end or content; null for others."""
    c = col(c)
    return (
        F.when(c.endswith("B") | c.contains("B cell"), "B")
        .when(c.endswith("T") | c.contains("T cell"), "T")
        .when(c.contains("DC"), "DC")
        .when(c.contains("Macrophage"), "Macrophage")
    )


def positive_subset(order: Iterable[str], cell_type: str | None = None, gate: Name | None = None) -> Column:
    """Positive cells with a call of `order`, perhaps of one type and past a gate."""
    out = F.col("lnp_positive") & F.col("lnp_call").isin(list(order))
    if cell_type is not None:
        out = out & (F.col("cell_type") == cell_type)
    return out if gate is None else out & col(gate)


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, and no negative zero: sums in another order give the same."""
    return df.select(*[(F.round(F.col(c), places) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
