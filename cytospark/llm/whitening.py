"""Whitening of embeddings with exact integer cross-products from bit planes.

Entries become integers: x = floor(64 c) + 1,000,000. The fit uses each distinct vector once, which is the only shuffle of vectors. A task takes blocks of
distinct vectors, subtracts each dimension's minimum in the block, and packs bit p of dimension i over all rows into words. The sum of products
of two dimensions is the sum over p and q of 2 ** (p + q) times the set bits of (plane p of i) AND (plane q of j); the minima are added back in integers.
Spark adds up the blocks' sums, of which there are d (d + 1) / 2, and these go to the driver. There the scatter is centred as integers, n Sxy - Sx Sy, before
it becomes a matrix of doubles for `eigh`. A last pass without a shuffle projects all rows.

Nulls and edge cases: rows whose vector is null, or has a null or non-finite entry, are left out; a null id stays. Vectors of different lengths are fitted apart, each length by its own
(d ** 2 numbers each go to the driver). Repeated vectors count once in the fit, each row is projected. A component without variance, as of equal vectors, has null for its
whitened value; without any variance `explained` is null. Vectors without entries give no rows. Entries beyond 2 ** 48 count as that. An empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: x = floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: The most components, rows of a block, and the largest |floor(64 c)|.
COMPONENTS, BLOCK, MOST = 16, 8192, 1 << 48
#: A component has variance if its eigenvalue is over this part of the largest.
LEAST = 1e-12


def usable(vector: Column) -> Column:
    """Whether a vector and all its entries are there and finite."""
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))


def integers(vector: Column) -> Column:
    """floor(64 c) of all entries; SHIFT is added where numbers are given out, as covariances don't depend on it."""
    return F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(float(MOST))), F.lit(float(-MOST)))))


def planes_of(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed bit planes of non-negative integers (rows x d): words for each (dimension, bit), dimension first, and the bit of each."""
    bits = max(1, int(shifted.max(initial=0)).bit_length())
    rows = -(-len(shifted) // 64) * 64
    padded = np.zeros((rows, shifted.shape[1]), np.uint64)
    padded[: len(shifted)] = shifted
    columns = np.ascontiguousarray(padded.T)
    planes = [np.packbits((columns >> np.uint64(p) & np.uint64(1)).astype(np.uint8), axis=1).view(np.uint64) for p in range(bits)]
    return np.stack(planes, 1).reshape(-1, rows // 64), np.tile(np.arange(bits), shifted.shape[1])


def scatter(y: np.ndarray) -> np.ndarray:
    """Sums of products of all pairs of columns of integers, exact, as Python's integers."""
    least = y.min(0)
    planes, bit = planes_of((y - least).astype(np.uint64))
    d, bits = y.shape[1], int(bit[-1]) + 1
    small = 2 * bits + len(y).bit_length() < 62
    weight = np.array([1 << p for p in range(bits)], np.int64 if small else object)
    out = np.zeros((d, d), np.int64 if small else object)
    for r, plane in enumerate(planes):
        i = r // bits
        counts = np.bitwise_count(planes[i * bits :] & plane).sum(1, dtype=np.int64).reshape(d - i, bits)
        out[i, i:] += (counts.astype(out.dtype) * weight).sum(1) * weight[r % bits]
    out = out.astype(object)
    out = np.triu(out) + np.triu(out, 1).T
    total, m = (y - least).sum(0).astype(object), least.astype(object)
    return out + np.outer(m, total) + np.outer(total, m) + len(y) * np.outer(m, m)


def _matrices(batch: pa.RecordBatch, limit: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of the column x by length, in blocks, as matrices, with their places in the batch."""
    column = batch.column("x")
    sizes = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy()
    begin = np.cumsum(sizes) - sizes
    for d in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == d)
        for k in range(0, len(rows), limit):
            part = rows[k : k + limit]
            yield flat[begin[part][:, None] + np.arange(d)], part


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, i, j, v) of all vectors of a task: sums of products of dimensions i <= j; dimension d is the constant 1."""
    sums: dict[int, np.ndarray] = defaultdict(int)
    for batch in batches:
        for y, _ in _matrices(batch):
            sums[y.shape[1]] = sums[y.shape[1]] + scatter(np.column_stack((y, np.ones(len(y), np.int64))))
    for d, s in sums.items():
        i, j = np.triu_indices(d + 1)
        columns = [np.full(len(i), d, np.int32), i.astype(np.int32), j.astype(np.int32)]
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array([Decimal(v) for v in s[i, j]], pa.decimal128(38, 0))], ["d", "i", "j", "v"])


def model_of(d: int, sums: dict[tuple[int, int], int]) -> dict:
    """Count, sums, components and their shares from the exact sums of products."""
    n, s = sums[d, d], np.array([sums[i, d] for i in range(d)], object)
    cross = np.array([[sums[min(i, j), max(i, j)] for j in range(d)] for i in range(d)], object)
    v = (n * cross - np.outer(s, s)).astype(float) / float(n) ** 2
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:COMPONENTS], vectors[:, ::-1][:, :COMPONENTS]
    strongest = np.abs(vectors).argmax(0)
    vectors = vectors * np.where(vectors[strongest, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    trace, full = float(np.trace(v)), values > LEAST * max(values[0], 0.0)
    to = np.where(full, vectors / np.sqrt(np.where(full, values, 1.0)), np.nan)
    error = np.abs(to[:, full].T @ v @ to[:, full] - np.eye(full.sum())).max(initial=0.0)
    return {"n": n, "s": s, "to": to, "explained": values / trace if trace > 0 else np.full(len(values), np.nan), "error": float(error)}


def fit(embeddings: DataFrame, vector: str = "embedding") -> dict[int, dict]:
    """A model for each length of vectors."""
    # a vector that a third of the rows have goes once from each task
    distinct = embeddings.where(usable(F.col(vector))).select(integers(F.col(vector)).alias("x")).distinct()
    rows = distinct.mapInArrow(_partials, "d int, i int, j int, v decimal(38,0)").groupBy("d", "i", "j").agg(F.sum("v").alias("v")).collect()
    sums: dict[int, dict] = defaultdict(dict)
    for r in rows:
        sums[r.d][r.i, r.j] = int(r.v)
    return {d: model_of(d, s) for d, s in sums.items()}


def deviations(y: np.ndarray, n: int, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n y - s, and the sum of its squares in each row: exact, in 64-bit integers where they suffice, else in Python's."""
    bound = n * int(np.abs(y).max(initial=0)) + max(map(abs, s.tolist()), default=0)
    fits = bound * bound * max(1, len(s)) < 1 << 63
    diff = n * y.astype(np.int64 if fits else object) - s.astype(np.int64 if fits else object)
    return diff, (diff * diff).sum(1)


def _project(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for y, rows in _matrices(batch, BLOCK // 8):
                m = sent.value[y.shape[1]]
                diff, square = deviations(y, m["n"], m["s"])
                white = (diff / m["n"]).astype(float) @ m["to"]
                k = white.shape[1]
                again = lambda x: np.repeat(x, k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(again(rows))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))),
                        pa.array(np.full(len(y) * k, m["n"], np.int64)),
                        pa.array([Decimal(int(x)) for x in square], pa.decimal128(38, 0)).take(pa.array(again(np.arange(len(y))))),
                        pa.array(white.ravel(), from_pandas=True),
                        pa.array(np.tile(m["explained"], len(y)), from_pandas=True),
                        pa.array(np.full(len(y) * k, m["error"])),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whiten(embeddings: DataFrame, models: dict[int, dict], vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each usable vector and component; deviation is a decimal(38, 0)."""
    rows = embeddings.where(usable(F.col(vector))).select(F.col("vec_id").cast("bigint").alias("vec_id"), integers(F.col(vector)).alias("x"))
    sent = embeddings.sparkSession.sparkContext.broadcast(models)
    return rows.mapInArrow(_project(sent), "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usable vectors on the first 16 components; `deviation` is null where it is beyond 64 bits."""
    embeddings = table(spark, sf_dir, "embeddings")
    out = whiten(embeddings, fit(embeddings))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
