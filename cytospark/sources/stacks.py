"""Image stacks as a data source: files of channels x rows x columns, read by tiles, with their sidecars.

A sample is `<sample>.npy`, beside it `<sample>.markers.txt`, the channels' names by white space, and `<sample>.registration.json` with its `region`. A partition is a band of rows of one channel; it reads
its own bytes of the file and no others, so that a stack may be as large as it likes. Samples, regions and markers that aren't asked for have no partitions: either by the options `regions` and `markers`, or, with
`image_stacks_pushed`, by the filters of the query (`spark.sql.python.filterPushdown.enabled` must be on for that one).

Files are opened with Arrow's file systems (local ones, or those that it knows by their URI). A stack whose number of channels isn't that of its markers is an error.
"""

from __future__ import annotations

import io
import json
import posixpath
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

_SCHEMA = "sample string, region string, marker string, i int, j int, v double"


def opened(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """Arrow's file system of a path or URI, and the path there."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return arrow_fs.FileSystem.from_uri(path)


@dataclass
class Tile(InputPartition):
    """Rows `first` to `last` of one channel."""

    path: str
    sample: str
    region: str
    marker: str
    offset: int
    kind: str
    width: int
    first: int
    last: int


class StackReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.rows = options["path"], int(options.get("rows", 1024))
        self.wanted: dict[str, set] = {c: set(options[o].split(",")) for c, o in (("region", "regions"), ("marker", "markers")) if options.get(o)}

    def partitions(self) -> Sequence[InputPartition]:
        store, root = opened(self.path)
        tiles = []
        for info in sorted(store.get_file_info(arrow_fs.FileSelector(root)), key=lambda f: f.path):
            if not info.path.endswith(".npy"):
                continue
            base = info.path.removesuffix(".npy")
            sample = posixpath.basename(base)
            with store.open_input_stream(f"{base}.markers.txt") as f:
                markers = f.read().decode().split()
            with store.open_input_stream(f"{base}.registration.json") as f:
                region = json.loads(f.read())["region"]
            with store.open_input_file(info.path) as f:
                head = io.BytesIO(f.read(4096))
            version = np.lib.format.read_magic(head)
            shape, by_column, kind = (np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0)(head)
            if by_column or len(shape) != 3 or shape[0] != len(markers):
                raise ValueError(f"{info.path}: {len(markers)} markers for a stack of shape {shape}")
            for channel, marker in enumerate(markers):
                if all({"sample": sample, "region": region, "marker": marker}[c] in some for c, some in self.wanted.items()):
                    for first in range(0, shape[1], self.rows):
                        offset = head.tell() + (channel * shape[1] + first) * shape[2] * kind.itemsize
                        tiles.append(Tile(info.path, sample, region, marker, offset, kind.str, shape[2], first, min(first + self.rows, shape[1])))
        return tiles

    def read(self, tile: Tile) -> Iterator[pa.RecordBatch]:
        store = opened(self.path)[0]
        size = np.dtype(tile.kind).itemsize * tile.width
        step = max(1, 1_000_000 // max(1, tile.width))
        with store.open_input_file(tile.path) as f:
            for first in range(tile.first, tile.last, step):
                last = min(first + step, tile.last)
                f.seek(tile.offset + (first - tile.first) * size)
                v = np.frombuffer(f.read((last - first) * size), tile.kind).astype(float)
                n = len(v)
                names = [pa.array([x] * n, pa.string()) for x in (tile.sample, tile.region, tile.marker)]
                i, j = np.repeat(np.arange(first, last, dtype=np.int32), tile.width), np.tile(np.arange(tile.width, dtype=np.int32), last - first)
                yield pa.RecordBatch.from_arrays([*names, pa.array(i), pa.array(j), pa.array(v)], ["sample", "region", "marker", "i", "j", "v"])


class PushedReader(StackReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        """Takes equality and lists on the names of samples, regions and markers; Spark does the rest."""
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            column = f.attribute[0] if values is not None and len(f.attribute) == 1 else None
            if column in ("sample", "region", "marker"):
                self.wanted[column] = self.wanted.get(column, values) & values
            else:
                yield f


class ImageStacks(DataSource):
    @classmethod
    def name(cls) -> str:
        return "image_stacks"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return StackReader(dict(self.options))


class PushedStacks(ImageStacks):
    @classmethod
    def name(cls) -> str:
        return "image_stacks_pushed"

    def reader(self, schema) -> DataSourceReader:
        return PushedReader(dict(self.options))


def read_stacks(spark: SparkSession, path: str, regions: Sequence[str] = (), markers: Sequence[str] = (), rows: int = 1024) -> DataFrame:
    """(sample, region, marker, i, j, v) of the pixels of a folder of stacks, of some regions and markers or of all."""
    spark.dataSource.register(ImageStacks)
    reader = spark.read.format("image_stacks").option("rows", rows)
    for name, values in (("regions", regions), ("markers", markers)):
        reader = reader.option(name, ",".join(values)) if values else reader
    return reader.load(path)


def write_stacks(pixels: DataFrame, path: str, markers: Sequence[str], height: int, width: int) -> DataFrame:
    """Writes a stack with sidecars for each sample of (sample, region, marker, i, j, v), and gives (sample, region, n_pixels); a task holds one sample. Absent pixels are 0."""

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        stack = np.zeros((len(markers), height, width))
        stack[part["marker"].map({m: n for n, m in enumerate(markers)}).to_numpy(), part["i"].to_numpy(), part["j"].to_numpy()] = part["v"].to_numpy()
        store, root = opened(path)
        store.create_dir(root)
        data = io.BytesIO()
        np.save(data, stack)
        for end, content in ((".npy", data.getvalue()), (".markers.txt", "\n".join(markers).encode()), (".registration.json", json.dumps({"region": key[1]}).encode())):
            with store.open_output_stream(f"{root}/{key[0]}{end}") as f:
                f.write(content)
        return pd.DataFrame({"sample": [key[0]], "region": [key[1]], "n_pixels": [len(part)]})

    some = pixels.where(F.col("marker").isin(list(markers))).select("sample", "region", "marker", "i", "j", "v")
    return some.groupBy("sample", "region").applyInPandas(run, "sample string, region string, n_pixels bigint")
