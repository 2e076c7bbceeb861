"""What the operators share: stored intermediates, byte-bounded batches, held objects."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scrutiny.session import scratch_path

#: Text bytes worked on at once inside a task. Batches of any size are cut to it.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str, **options: str) -> DataFrame:
    """Write to the cluster's shared folder and read back: cuts the lineage, survives executors."""
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.options(**options).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held(key: tuple, make: Callable[[], Any]) -> Any:
    """An object kept for the life of a Python worker (tokenizers, word caches)."""
    home = sys.modules.setdefault("_scrutiny_held", types.ModuleType("_scrutiny_held"))
    kept = home.__dict__.setdefault("kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def give_back() -> None:
    """Return freed memory to the system: a worker that keeps its largest working set for ever
    takes it from the executor's other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


def text_slices(batches: Iterable[pa.RecordBatch], column: str,
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of text, or one longer row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(False)
        start = held_bytes = 0
        for i, n in enumerate(sizes.tolist()):
            if i > start and held_bytes + n > limit:
                yield batch.slice(start, i - start)
                start, held_bytes = i, 0
            held_bytes += n
        if start < batch.num_rows:
            yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts; null counts as the empty text."""
    return pc.fill_null(batch.column(column), "").to_pylist()


def top_rows(frame: DataFrame, keys: list[str], order: list[Column], most: int,
             salts: int = 64) -> DataFrame:
    """The first ``most`` rows of each group with their ``rank``.

    Groups are cut down in parts first (and in each task before that), so a group of any size
    reaches one task as ``salts`` times ``most`` rows at most.
    """
    part = Window.partitionBy(*keys, F.col("_salt")).orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(*order)
    salted = frame.withColumn("_salt", F.pmod(F.xxhash64(*frame.columns), F.lit(salts)))
    fewer = salted.withColumn("_rank", F.row_number().over(part)).where(F.col("_rank") <= most)
    return (fewer.drop("_salt", "_rank").withColumn("rank", F.row_number().over(whole))
            .where(F.col("rank") <= most))


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
