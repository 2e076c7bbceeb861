"""Shared pieces of the streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def file_stream(spark: SparkSession, path: str, schema: str | StructType, fmt: str = "parquet",
                max_files: int | None = None) -> DataFrame:
    """A file source over a folder, or over one file (or folder) of Parquet.

    The path is written as a pattern, which lets the source take a single file as well.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if path.endswith(".parquet"):
        path = path[:-1] + "[t]"
    return reader.load(path)


def run_available(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query to work off what is there; errors surface."""
    query.awaitTermination()


def overwrite_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch under ``batch_id=N``; a replay overwrites the same place."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(
        f"{path.rstrip('/')}/batch_id={batch_id}")


def newest_per_key(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last version of each key over the batches written by ``overwrite_batch``."""
    df = spark.read.option("basePath", path).parquet(path)
    rest = [n for n in df.columns if n not in keys and n != "batch_id"]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), "batch_id").alias("row"))
        .select(*keys, *[F.col("row")[n].alias(n) for n in rest])
    )
