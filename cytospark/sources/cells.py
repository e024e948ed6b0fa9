"""Cells as a table, derived from events, and the cleaning that each analysis begins with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import coerce_double, pool_cell_type
from ..functions.order import quantiles
from ..schemas import LNP_REGIONS, REFERENCE_REGIONS

_TYPES = {"view": "B", "signup": "CD4+ T", "purchase": "CD8+ T", "error": "DC"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cell for each event: place, region, type, call and markers follow from the event's numbers."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    part = F.expr("event_id % 17")
    kind = F.lit("Macrophage")
    for event, name in _TYPES.items():
        kind = F.when(F.col("event_type") == event, name).otherwise(kind)
    region = F.when(part == 16, "S2_reg004").otherwise(F.concat(F.lit("S"), (1 + F.floor(part / 4)).cast("int").cast("string"), F.lit("_reg00"), F.expr("cast(event_id % 17 % 4 as string)")))
    return e.select(
        F.col("event_id").alias("cell_id"),
        region.alias("lnp_region"),
        F.when(part == 16, "reference").otherwise("LNP").alias("condition"),
        kind.alias("cell_type"),
        F.expr("cast(event_id * 7919 % 601 as double) + value / 1000").alias("x"),
        F.expr("cast(event_id * 104729 % 599 as double) + cast(user_id % 97 as double) / 97").alias("y"),
        F.expr("concat('LNP_', lpad(cast(1 + user_id % 10 as string), 2, '0'))").alias("lnp_call"),
        F.expr("event_id % 17 <> 16 and (event_id * 31 + user_id) % 10 < 3").alias("lnp_positive"),
        F.col("value").alias("Fluc"),
        F.expr("value * cast(1 + user_id % 5 as double) / 3").alias("OVA"),
        F.expr("value * cast(1 + event_id % 7 as double) / 4").alias("SIINFEKL"),
        F.expr("cast(event_id * 13 % 101 as double)").alias("CD86"),
    )


def clean_cells(df: DataFrame, markers: tuple[str, ...] = ("Fluc", "OVA"), regions: tuple[str, ...] = LNP_REGIONS + REFERENCE_REGIONS) -> DataFrame:
    """Numbers coerced, missing calls filled, types pooled, and cells without place or outside the regions left out."""
    df = df.withColumns({c: coerce_double(c) for c in ("x", "y", *markers)})
    df = df.withColumns({"lnp_positive": F.coalesce("lnp_positive", F.lit(False)), "lnp_call": F.coalesce("lnp_call", F.lit("no_barcode")), "cell_type": F.coalesce("cell_type", F.lit("Unknown"))})
    df = df.withColumn("cell_type_pooled", pool_cell_type("cell_type"))
    return df.where(F.col("lnp_region").isin(list(regions))).dropna(subset=["x", "y"])


def gates(df: DataFrame, markers: dict[str, str], q: float, regions: tuple[str, ...] = REFERENCE_REGIONS) -> DataFrame:
    """(marker, column, threshold, reference_median, reference_n_cells) from the reference regions; a marker without values has no threshold."""
    reference = df.where(F.col("lnp_region").isin(list(regions)))
    named = F.explode(F.array(*[F.struct(F.lit(m).alias("marker"), F.lit(c).alias("column"), coerce_double(c).alias("value")) for m, c in markers.items()])).alias("m")
    values = reference.select(named).select("m.*")
    counts = values.groupBy("marker", "column").agg(F.count("value").alias("reference_n_cells"))
    found = quantiles(values, ["marker", "column"], "value", [q, 0.5])
    return counts.join(found, ["marker", "column"], "left").select("marker", "column", F.round("q0", 6).alias("threshold"), F.col("q1").alias("reference_median"), "reference_n_cells")


def with_gates(df: DataFrame, table_: DataFrame, markers: dict[str, str]) -> DataFrame:
    """`<marker>_positive` for each gate: above the threshold, false where there is none. The gates are one row."""
    wide = table_.groupBy().pivot("marker", list(markers)).agg(F.first("threshold"))
    df = df.crossJoin(F.broadcast(wide.select(*[F.col(m).alias(f"__{m}") for m in markers])))
    df = df.withColumns({f"{m}_positive": F.coalesce(F.col(c) > F.col(f"__{m}"), F.lit(False)) for m, c in markers.items()})
    return df.drop(*[f"__{m}" for m in markers])
