"""Session helpers: settings the jobs expect and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings worth having on every session that runs these jobs. All are public
#: Spark settings; a cluster that already sets them keeps its own values.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
}


def build(master: str | None = None, **settings: str) -> SparkSession:
    """Create (or reuse) a session with the defaults above."""
    builder = SparkSession.builder.appName("scrutiny")
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only in local mode (tests, a laptop), where it may be unset, a temporary folder is made
    and remembered in the session, so that later calls agree on it. On a cluster each
    machine would write to a disk of its own, so there an unset folder is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.scrutiny.workdir", None)
    if not folder:
        master = spark.conf.get("spark.master", "local[*]")
        if not re.match(r"local(\[[^\]]*\])?$", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all of {master} shares")
        folder = tempfile.mkdtemp(prefix="scrutiny-")
        spark.conf.set("spark.scrutiny.workdir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created there yet."""
    return f"{shared_folder(spark)}/scrutiny/{label}-{uuid.uuid4().hex[:12]}"
