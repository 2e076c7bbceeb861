"""A table kept as a log of batches with a compacted base (merge on read).

``<path>/delta/batch_id=N`` holds what batch N wrote, and nothing else is touched by it.
``<path>/base`` is a committed version that holds the batches up to its high-water mark, put
together. Readers take the base and the later batches. Compaction runs on a schedule of its
own; as long as it does, the number of folders read stays the same however long the stream.

A replayed batch overwrites its own folder; if the base has it already, the folder is beyond
the mark and not read. Compacted folders go one compaction later, so readers that began with
the older base still find them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutiny.sinks.commits import current, folder_names, publish, vacuum
from scrutiny.sinks.tables import delete_path
from scrutiny.streaming.common import overwrite_batch

BATCH = "batch_id"


def _root(path: str, part: str) -> str:
    return f"{path.rstrip('/')}/{part}"


def append(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch; its replay overwrites the same folder."""
    overwrite_batch(df, _root(path, "delta"), batch_id)


def mark(spark: SparkSession, path: str) -> int:
    """The last batch that the base holds (-1: there is no base)."""
    found = current(spark, _root(path, "base"))
    return int(found["mark"]) if found else -1


def batches(spark: SparkSession, path: str) -> list[int]:
    """Batches that have a folder."""
    names = folder_names(spark, _root(path, "delta"))
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch_id="))


def read_log(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """All rows with the batch they came from; ``before`` leaves out that batch and later ones
    (the base never holds the running one, see ``compact_when_due``)."""
    delta = _root(path, "delta")
    base = current(spark, _root(path, "base"))
    from_mark = int(base["mark"]) if base else -1
    live = [b for b in batches(spark, path) if b > from_mark and (before is None or b < before)]
    typed = f"{schema}, {BATCH} bigint"
    parts = []
    if base:
        parts.append(spark.read.schema(typed).parquet(_root(path, f"base/{base['folder']}")))
    if live:
        parts.append(spark.read.schema(typed).option("basePath", delta).parquet(
            *[f"{delta}/{BATCH}={b}" for b in live]))
    if not parts:
        return spark.createDataFrame([], typed)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def compact(spark: SparkSession, path: str, schema: str,
            reduce: Callable[[DataFrame], DataFrame], before: int | None = None) -> int:
    """Put base and batches (those ``before`` one, if given) together into a new base; its
    high-water mark.

    ``reduce`` gets and returns rows with ``batch_id``. A failure before the commit leaves the
    old base and all batches in place.
    """
    old = mark(spark, path)
    known = [b for b in batches(spark, path) if before is None or b < before]
    new = max([old, *known])
    if new == old:
        return old
    publish(reduce(read_log(spark, path, schema, before)), _root(path, "base"), mark=new)
    for b in known:
        if b <= old:
            delete_path(spark, f"{_root(path, 'delta')}/{BATCH}={b}")
    vacuum(spark, _root(path, "base"))
    return new


def compact_when_due(spark: SparkSession, path: str, schema: str, batch_id: int, every: int,
                     reduce: Callable[[DataFrame], DataFrame]) -> None:
    """Compact if more than ``every`` batches have come since the last time.

    Only batches before the running one go in: those are committed for good, so a replay of the
    running one finds a base without it.
    """
    if every and batch_id - 1 - mark(spark, path) >= every:
        compact(spark, path, schema, reduce, batch_id)


def newest(df: DataFrame, keys: list[str]) -> DataFrame:
    """The row of each key from its last batch, with ``batch_id``."""
    rest = [n for n in df.columns if n not in keys]
    row = F.max_by(F.struct(*rest), BATCH)
    return df.groupBy(*keys).agg(row.alias("row")).select(
        *keys, *[F.col("row")[n].alias(n) for n in rest]).select(*df.columns)
