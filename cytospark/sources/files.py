"""Readers, sinks, manifests of files, and tiles that a later run need not do again."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import union_columns
from .stacks import opened

#: Bytes of a file that are read at once.
BLOCK = 8_000_000


def read_csv(spark: SparkSession, path: str, schema: str, partitions: int | None = None) -> DataFrame:
    """CSV with a header and a declared schema; gzip can't be split, so that `partitions` deals its rows anew."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.repartition(partitions) if partitions else df


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parameters(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def load_batches(batches: dict[str, DataFrame], regions: Sequence[str], key: str = "cell_id") -> DataFrame:
    """All batches by name with their columns united, ids made unique, and only the given regions."""
    named = [df.withColumn("batch", F.lit(name)).withColumn(key, F.concat_ws("__", F.col(key).cast("string"), F.lit(name))) for name, df in batches.items()]
    return union_columns(*named).where(F.col("lnp_region").isin(list(regions)))


def find_images(spark: SparkSession, path: str, glob: str, pattern: str, fields: Sequence[str]) -> DataFrame:
    """(path, fields) of files whose name matches; the fields are the pattern's groups."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.where(name.rlike(pattern)).select("path", *[F.regexp_extract(name, pattern, i + 1).alias(f) for i, f in enumerate(fields)])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for name in batch.column("name").to_pylist():
            digest = hashlib.sha256()
            store, path = opened(name)
            with store.open_input_stream(path) as f:
                while block := f.read(BLOCK):
                    digest.update(block)
            out.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("size_bytes"), pa.array(out, pa.string())], ["path", "size_bytes", "sha256"])


def build_manifest(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, size_bytes, sha256) of the files below a folder, by their path within it.

    Local files are read by tasks in blocks of `BLOCK` bytes, whatever their size; on other file systems a file is one value of Spark's reader, which is under 2 GB and has at least a byte.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()
    if root.startswith("file:"):
        store, top = opened(root)
        found = [(f"file:{f.path}", f.path[len(top.rstrip("/")) + 1 :], f.size) for f in store.get_file_info(arrow_fs.FileSelector(top, recursive=True)) if f.type == arrow_fs.FileType.File and f.base_name[0] not in "._" and fnmatch(f.base_name, glob)]
        names = spark.createDataFrame(found, "name string, path string, size_bytes bigint")
        return names.repartition(max(1, len(found)), "name").mapInArrow(_digests, "path string, size_bytes bigint, sha256 string") if found else names.selectExpr("path", "size_bytes", "'' AS sha256")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    within = F.expr(f"substring(path, {len(root.rstrip('/')) + 2})")
    return files.select(within.alias("path"), F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))


def verify_manifest(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """(path, problem) of entries whose digest isn't well formed, whose file is missing, or whose size or digest differs, in this order."""
    have = files.select("path", F.col("size_bytes").alias("__size"), F.col("sha256").alias("__sha"))
    problem = (
        F.when(~F.coalesce(F.col("sha256").rlike("^[0-9a-f]{64}$"), F.lit(False)), "malformed digest")
        .when(F.col("__size").isNull(), "missing")
        .when(F.col("__size") != F.col("size_bytes"), "size mismatch")
        .when(F.col("__sha") != F.col("sha256"), "digest mismatch")
    )
    return manifest.join(have, "path", "left").select("path", problem.alias("problem")).where("problem IS NOT NULL")


def write_tiles(df: DataFrame, path: str, keys: Sequence[str], done: DataFrame) -> None:
    """Tiles as partitions, each replaced as a whole, and a table of the finished ones, as an empty tile leaves no partition."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(f"{path}/tiles")
    done.select(*keys).distinct().write.mode("append").parquet(f"{path}/done")


def unfinished(spark: SparkSession, tiles: DataFrame, path: str, keys: Sequence[str], force: bool = False) -> DataFrame:
    """Rows of the tiles that an earlier run hasn't finished; all with `force`, or if there was none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/done")
    if force or not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return tiles
    return tiles.join(spark.read.parquet(f"{path}/done").select(*keys).distinct(), list(keys), "left_anti")
