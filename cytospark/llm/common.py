"""Helpers that several text operators share: tables, shared scratch space, blocks of text and rolling hashes."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..sources.scratch import materialize, shared_folder

__all__ = ["materialize"]

#: Bytes of text that a task works on at once; numpy needs about 40 times as much for a moment.
BLOCK_BYTES = 1_000_000

#: The white space that separates words: space and U+0009 to U+000D.
SPACE_CLASS = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder, by a path that any of Spark's file systems can serve."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path of `scratch` through Hadoop's file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def numbered(df: DataFrame, *keep: str) -> DataFrame:
    """The same columns by position: those of `keep` by their names, all others as c0, c1, ...

    Operators that return whole rows work on this, so that no name of the caller's (with dots, or of a column of their own) is in the
    way; `restored` gives the names back.
    """
    return df.toDF(*[c if c in keep else f"c{i}" for i, c in enumerate(df.columns)])


def restored(df: DataFrame, docs: DataFrame, like: DataFrame, *more: str) -> DataFrame:
    """The columns of `docs` (which is `like`, numbered) under their own names again, followed by the columns `more`."""
    return df.select(*docs.columns, *more).toDF(*like.columns, *more)


def text_blocks(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut Arrow batches into slices of about `limit` bytes of text (one row at least), with the texts as UTF-8; null is empty."""
    for batch in batches:
        column = batch.column(text).cast(pa.large_binary())
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start), [t or b"" for t in column.slice(start, stop - start).to_pylist()]
            start = stop


def byte_table(chars: Iterable[int]) -> np.ndarray:
    """A lookup table that is true for the given bytes."""
    table_ = np.zeros(256, bool)
    table_[list(chars)] = True
    return table_


#: Bytes of words by white space; UTF-8's bytes over 127 all belong to words.
NON_SPACE = byte_table(set(range(256)) - {0x20, *range(0x09, 0x0E)})
#: Bytes of words of ASCII letters (lower case), digits and anything beyond ASCII.
ALNUM_LOWER = byte_table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SYMBOLS = np.random.default_rng(20240229).integers(0, 1 << 64, 256, dtype=np.uint64)


class _Powers(dict):
    """Powers by base, kept between blocks; a copy that is sent to a worker starts empty."""

    def __reduce__(self):
        return (_Powers, ())


_powers = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: every bit of the result depends on every bit of x."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept for the next block."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        full = np.full(max(n, 1 << 20), base, np.uint64)
        full[0] = 1
        have = _powers[base] = np.cumprod(full, dtype=np.uint64)
    return have[:n]


class Rolling:
    """Hashes of any spans of a sequence of 64-bit symbols in constant time each, by prefix sums of a polynomial."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * _power(_BASE, n), out=self.prefix[1:])
        self.inverse = _power(_INVERSE, n + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.prefix[ends] - self.prefix[starts]) * self.inverse[starts])


def byte_symbols(blob: np.ndarray) -> np.ndarray:
    return _SYMBOLS[blob]


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one array with a newline after each, and where each starts (and, last, where all end)."""
    blob = np.frombuffer(b"\n".join([*texts, b""]) if texts else b"", np.uint8)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
    return blob, bounds


def words_of(blob: np.ndarray, bounds: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of `blob`, and how many words come before each text (last: all)."""
    inside = is_word[blob].view(np.int8)
    step = np.diff(inside, prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    return starts, ends, np.searchsorted(starts, bounds)
