"""Checks of tables: each gives a DataFrame of violations, empty if the contract holds."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.relational import set_difference
from ..schemas import Codebook


class ContractError(ValueError):
    """A table breaks a contract."""


def enforce(violations: DataFrame, message: str) -> None:
    """Raise with a few of the violations, if there are any."""
    some = violations.limit(5).collect()
    if some:
        raise ContractError(f"{message}: {[tuple(r) for r in some]}")


def expect_columns(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ContractError(f"missing columns: {missing}")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n) of keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unmatched(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys without a row in the other table."""
    return df.select(*keys).join(other.select(*keys), list(keys), "left_anti")


def out_of_domain(df: DataFrame, column: str, allowed: Iterable[str]) -> DataFrame:
    """(value, n) of values that aren't allowed."""
    return df.where(~F.col(column).isin(list(allowed))).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def region_mismatch(df: DataFrame, column: str, expected: Iterable[str]) -> DataFrame:
    return set_difference(df.sparkSession, df, column, expected)


def expect_single(df: DataFrame, column: str) -> None:
    if df.select(column).distinct().limit(2).count() > 1:
        raise ContractError(f"more than one {column}")


def codebook_violations(df: DataFrame, book: Codebook) -> DataFrame:
    """Codes of another length, or with another number of bits on."""
    on = F.length(F.replace(F.col("code"), F.lit("0"), F.lit("")))
    return df.where((F.length("code") != len(book.markers)) | (on != book.on_bits))


def write_checked(df: DataFrame, path: str, conditions: dict[str, Column], least_rows: int = 0) -> dict[str, int]:
    """Write Parquet to a new path and check all conditions in the same pass; (name -> rows that break it), and `rows`.

    A row breaks a condition that isn't true for it, null included. What breaks a contract is an error, and the written files go before it is raised; duplicates and matches with other tables need a shuffle of their
    own and are checked by `duplicates` and `unmatched`.
    """
    seen = Observation()
    metrics = [F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics).write.parquet(path)
    found = {n: int(seen.get[n]) for n in ("rows", *conditions)}
    broken = {n: v for n, v in found.items() if n in conditions and v} | ({"rows": found["rows"]} if found["rows"] < least_rows else {})
    if broken:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        raise ContractError(f"{path}: {broken}")
    return found
