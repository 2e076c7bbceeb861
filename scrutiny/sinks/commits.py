"""Commits that hold on object stores: versioned folders and one small pointer file.

A version of a table is a folder of its own that nobody reads until a pointer names it. The
pointer is created under the next number, never renamed and never overwritten, so a reader
sees the whole old table or the whole new one, and of two writers one fails. What a writer
left behind before its pointer was there is invisible and goes with ``vacuum``.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from scrutiny.sinks.tables import _fs, delete_path


def _commits(path: str) -> str:
    return f"{path.rstrip('/')}/_commits"


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it isn't there."""
    fs, hadoop = _fs(spark, path)
    if not fs.exists(hadoop):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop))


def _pointers(spark: SparkSession, path: str) -> list[int]:
    found = (re.fullmatch(r"(\d{12})\.json", n) for n in folder_names(spark, _commits(path)))
    return [int(m[1]) for m in found if m]


def _pointer(spark: SparkSession, path: str, version: int) -> dict | None:
    """What a pointer says; None if its writer died in the middle."""
    fs, hadoop = _fs(spark, f"{_commits(path)}/{version:012d}.json")
    stream = fs.open(hadoop)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None


def current(spark: SparkSession, path: str) -> dict | None:
    """The newest commit: its version, its folder and the facts it was made with."""
    for version in reversed(_pointers(spark, path)):
        found = _pointer(spark, path, version)
        if found:
            return {**found, "version": version}
    return None


def commit(spark: SparkSession, path: str, folder: str, **facts: object) -> int:
    """Make a complete folder under ``path`` the current version."""
    version = max(_pointers(spark, path), default=0) + 1
    fs, hadoop = _fs(spark, f"{_commits(path)}/{version:012d}.json")
    stream = fs.create(hadoop, False)  # fails if another writer was first
    try:
        stream.write(bytearray(json.dumps({"folder": folder, **facts}).encode()))
    finally:
        stream.close()
    return version


def publish(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), **facts: object) -> int:
    """Write the next version of a table and make it current; its number.

    The plan may read the very table that it replaces: the old version stays where it is.
    """
    folder = f"data-{uuid.uuid4().hex[:12]}"
    (df.write.partitionBy(*partition_by).option("compression", "zstd")
     .parquet(f"{path.rstrip('/')}/{folder}"))
    return commit(df.sparkSession, path, folder, **facts)


def read_current(spark: SparkSession, path: str, schema: object = None) -> DataFrame:
    """The current version of a table."""
    found = current(spark, path)
    if found is None:
        raise FileNotFoundError(f"no committed version under {path}")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{path.rstrip('/')}/{found['folder']}")


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete folders that none of the newest ``keep`` commits names; what was deleted.

    Readers of an older version have until ``keep`` more commits to end. Run it where no
    writer is at work: a folder without a pointer may still be being written.
    """
    versions = _pointers(spark, path)
    named = {(_pointer(spark, path, v) or {}).get("folder") for v in versions[-keep:]}
    gone = [n for n in folder_names(spark, path) if n.startswith("data-") and n not in named]
    for name in gone:
        delete_path(spark, f"{path.rstrip('/')}/{name}")
    for version in versions[:-keep]:
        delete_path(spark, f"{_commits(path)}/{version:012d}.json")
    return gone
