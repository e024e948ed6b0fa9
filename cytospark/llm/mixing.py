"""Mixing sources to target weights by nested hash thresholds, in DataFrame functions only.

Each source has a target number of words. As many whole copies of the source as fit are taken; the rest comes from the
documents whose hash is below a threshold. To find the threshold, words are summed by source and leading bits of the hash;
a running sum over these histograms shows the bucket in which the rest is reached, and only the documents of this bucket are
looked at with the next bits, until a single hash is left. Documents are then filtered by one comparison, without being sorted.

The document whose hash crosses the target is taken if that brings the source nearer to it. Hashes depend on nothing but doc_id and
text, so that reruns agree. Rows equal in both share a hash; if it is the one that crosses the target, as many of them are taken as bring the source nearest.

Nulls and edge cases: a null text has no words; a null source is a source of its own, the last; a source without words has
the target zero; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACE_CLASS, materialize, numbered, restored, table

#: Weights of the sources in order, again and again.
WEIGHTS = (3, 1, 2)
#: Words of the mix by words of the documents, and the most copies of a source.
SHARE, MOST = 1.5, 2
#: Bits of a hash, and bits that one histogram resolves.
HASH_BITS, STEP_BITS = 60, 12


def _hash() -> Column:
    """60 bits of the MD5 of doc_id and text, as a non-negative integer."""
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def _key() -> Column:
    """The source, told from null."""
    return F.concat(F.when(F.col("source").isNull(), "-").otherwise("+"), F.coalesce("source", F.lit("")))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) by (source, size): weights are dealt in the order of the sources, and no target is above MOST times its size.

    Capped sources come first in the order of cap by weight; the level of the others follows from running sums.
    """
    source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.pmod(F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    source = source.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(MOST))
    ordered = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = ordered.rowsBetween(W.unboundedPreceding, -1)
    source = source.withColumn("rank", F.row_number().over(ordered)).withColumn("level", (F.sum("source_size").over(everything) * SHARE - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    free = F.when(F.col("cap") > F.col("level") * F.col("weight"), F.struct("rank", "level"))
    source = source.withColumn("level", F.min(free).over(everything)["level"])
    return source.select("source", "source_size", F.round(F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))), 6).alias("target"))


def _crossing(hist: DataFrame) -> DataFrame:
    """The bucket of each source in which the running sum passes the rest, with its words (before, after), rows and hashes."""
    upto = W.partitionBy("source_key").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    hist = hist.withColumn("after", F.col("start") + F.sum("words").over(upto)).withColumn("before", F.col("after") - F.col("words"))
    return hist.where("before <= rest AND after > rest").select("source_key", "bucket", "before", "after", "rest", "n", "low", "high")


def thresholds(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """(source_key, source_size, target, copies, at, some): whole copies of each source, the hash below which one more copy is taken,
    and how many of the rows with just this hash are taken, too.
    """
    goals = goals.withColumn("copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    goals = goals.withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
    live = goals.where("rest > 0").select("source_key", "rest", F.lit(0.0).alias("start"))
    edge, shift, crossing = sized.where("size > 0").select("source_key", "hash", "size"), HASH_BITS, None
    while shift > 0:
        shift -= STEP_BITS
        hist = edge.groupBy("source_key", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"), F.min("hash").alias("low"), F.max("hash").alias("high"))
        crossing = materialize(_crossing(hist.join(live, "source_key")), "crossing")
        if crossing.where("low < high").isEmpty():
            break
        edge = edge.join(crossing.select("source_key", F.col("bucket").alias("in")), "source_key").where(F.shiftright("hash", shift) == F.col("in")).drop("in")
        edge = materialize(edge, "edge")
        live = crossing.select("source_key", "rest", F.col("before").alias("start"))
    # each boundary is one hash now: rows of one doc_id and text, which have one size
    some = F.floor((F.col("rest") - F.col("before")) * F.col("n") / (F.col("after") - F.col("before")) + 0.5)
    edges = crossing.select("source_key", F.col("low").alias("at"), F.least(some, "n").alias("some"), "n")
    return goals.join(edges, "source_key", "left").select("source_key", "source_size", "target", "copies", "at", F.coalesce("some", F.lit(0)).alias("some"), F.coalesce("n", F.lit(0)).alias("n"))


def mix(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, size, hash, source_key) of each document, and the thresholds of each source."""
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(SPACE_CLASS)).cast("bigint").alias("size")
    sized = documents.select("doc_id", "source", size, _hash().alias("hash"))
    sized = materialize(sized.withColumn("source_key", _key()), "sizes")
    goals = targets(sized).withColumn("source_key", _key())
    return sized, materialize(thresholds(sized, materialize(goals, "targets")), "thresholds")


def _with_copies(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """`rows` (with source_key and hash) and `copies`, how often each is taken.

    Rows without words count as below the boundary or not by their hash alone. Where only some of the rows of a boundary are taken, these rows are equal in
    doc_id and text: they are written out and numbered by task and place in it, and the first so many are taken.
    """
    rows = rows.join(limits.select("source_key", F.col("copies").alias("whole"), "at", "some", "n"), "source_key")
    split = (F.col("hash") == F.col("at")) & (F.col("some") > 0) & (F.col("some") < F.col("n"))
    more = F.when(F.col("hash") < F.col("at"), 1).when((F.col("hash") == F.col("at")) & (F.col("some") > 0), 1).otherwise(0)
    out = rows.withColumn("copies", (F.col("whole") + more).cast("int"))
    if limits.where("some > 0 AND some < n").isEmpty():
        return out.drop("whole", "at", "some", "n")
    tied = materialize(rows.where(split).withColumn("place", F.monotonically_increasing_id()), "tied")
    task = F.shiftright("place", 33)
    counts = tied.groupBy("source_key", task.alias("task")).agg(F.count(F.lit(1)).alias("have"))
    before = F.coalesce(F.sum("have").over(W.partitionBy("source_key").orderBy("task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("source_key", "task", before.alias("before"))
    tied = tied.withColumn("task", task).join(counts, ["source_key", "task"])
    first = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) < F.col("some")
    tied = tied.withColumn("copies", (F.col("whole") + first.cast("int")).cast("int"))
    return out.where(~F.coalesce(split, F.lit(False))).unionByName(tied.select(*out.columns)).drop("whole", "at", "some", "n")


def take(documents: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document."""
    sized, limits = mix(documents)
    out = _with_copies(sized, limits).join(limits.select("source_key", "source_size", "target"), "source_key")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("bigint").alias("taken"))


def copies(documents: DataFrame) -> DataFrame:
    """The documents that the mix takes, all columns, with `copies`: how often each is taken (in place of a column of this name)."""
    names = [c for c in documents.columns if c.lower() != "copies"]
    documents = documents.select(*[F.col("`" + c.replace("`", "``") + "`") for c in names])
    docs = numbered(documents, "doc_id", "text", "source")
    _, limits = mix(docs)
    out = _with_copies(docs.select("*", _key().alias("source_key"), _hash().alias("hash")), limits)
    return restored(out.where("copies > 0"), docs, documents, "copies")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return take(table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h FROM documents),
s0 AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, CAST(source_size AS DOUBLE) * 2 AS cap, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight FROM s0),
s2 AS (SELECT *, row_number() OVER o AS rank, ((SELECT sum(source_size) FROM s0) * 1.5::DOUBLE - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / ((SELECT sum(weight) FROM s1) - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM s1 WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
s3 AS (SELECT source, source_size, round(least(cap, coalesce((SELECT level FROM s2 WHERE cap > level * weight ORDER BY rank LIMIT 1) * weight, cap)), 6) AS target FROM s2),
s4 AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS copies FROM s3),
t AS (SELECT d.*, s4.source_size, s4.target, s4.copies, s4.target - s4.copies * s4.source_size AS rest,
    sum(size) OVER (PARTITION BY d.source ORDER BY h ROWS UNBOUNDED PRECEDING) AS after, size AS own
    FROM d JOIN s4 ON d.source IS NOT DISTINCT FROM s4.source)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(size * (copies + CASE WHEN rest > 0 AND (after <= rest OR after - own <= rest AND after - rest <= rest - (after - own)) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM t
"""
