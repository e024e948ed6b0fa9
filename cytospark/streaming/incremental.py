"""Row-local operators on Structured Streaming, and tables that grow by micro-batches.

Decoding and gating by fixed thresholds need no state, so that they run on a stream as they do on a table. New cells or spots are
appended batch by batch; the checkpoint makes each batch count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.decode import decode
from ..schemas import Codebook


def read_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 8) -> DataFrame:
    """A folder of Parquet files to which files are added."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def gate_stream(cells: DataFrame, thresholds: dict[str, float], columns: dict[str, str]) -> DataFrame:
    """`<marker>_positive` by thresholds that an earlier run has set."""
    return cells.withColumns({f"{m}_positive": F.coalesce(F.col(columns[m]) > t, F.lit(False)) for m, t in thresholds.items()})


def append(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write all that is there and stop; run again for what has come since."""
    return df.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path).outputMode("append").trigger(availableNow=True).start()
