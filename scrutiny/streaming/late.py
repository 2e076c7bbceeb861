"""Progress windows and unique snapshots that count late rows too.

A watermark forgets closed windows, and rows that come later vanish. Here every snapshot is
kept in a log by day, windows are computed anew for just those that a batch touches, and
rows later than ``lateness`` behind the newest one seen are noted in a table of their own. A
batch reads the days it touches, nothing else; nothing is held in state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scrutiny.sinks.commits import folder_names
from scrutiny.sinks.tables import path_exists
from scrutiny.streaming import log
from scrutiny.streaming.common import overwrite_batch
from scrutiny.streaming.progress import progress_windows

DAY = "day"
LATE_SECONDS = 3600
SNAPSHOT_DDL = ("idEleccion bigint, snapshot_ts timestamp_ntz, contabilizadas bigint, "
                "totalActas bigint, pct double")
WINDOW_DDL = ("window_start timestamp_ntz, idEleccion bigint, contabilizadas bigint, "
              "totalActas bigint, pct double, n bigint")
NEWEST_DDL = "newest timestamp_ntz"
KEYS = ["window_start", "idEleccion"]


def _days(spark: SparkSession, path: str, days: list[str], batch_id: int) -> DataFrame | None:
    """Stored snapshots of some days from earlier batches."""
    there = set(folder_names(spark, path))
    names = [f"{path}/{DAY}={d}" for d in days if f"{DAY}={d}" in there]
    if not names:
        return None
    rows = spark.read.schema(f"{SNAPSHOT_DDL}, {DAY} string, {log.BATCH} bigint").option(
        "basePath", path).parquet(*names)
    return rows.where(F.col(log.BATCH) < batch_id)


def _newest_before(spark: SparkSession, path: str, batch_id: int, every: int):
    """The newest snapshot time that earlier batches have seen."""
    log.compact_when_due(
        spark, path, NEWEST_DDL, batch_id, every, lambda df: df.agg(
            F.max("newest").alias("newest"), F.max(log.BATCH).alias(log.BATCH)))
    return log.read_log(spark, path, NEWEST_DDL, batch_id).agg(F.max("newest")).first()[0]


def store_batch(batch: DataFrame, batch_id: int, path: str, every: int = 20,
                unique: tuple[str, ...] = ()) -> None:
    """One batch: keep its rows, recompute the windows they touch, note the late ones.

    With ``unique`` a row whose key was stored before (or stands twice in the batch, where the
    smallest row stays) is not stored again. Each output lies under the batch's own
    partition and is written from the batch and from earlier batches only, so a replay
    writes the same. Rows without a time belong to no window and are left out.
    """
    spark = batch.sparkSession
    rows = batch.where(F.col("snapshot_ts").isNotNull()).withColumn(
        "snapshot_ts", F.col("snapshot_ts").cast("timestamp_ntz")).withColumn(
        DAY, F.date_format("snapshot_ts", "yyyy-MM-dd")).persist()
    try:
        days = [r[0] for r in rows.select(DAY).distinct().collect()]  # of one batch: few
        if not days:
            return
        before = _days(spark, f"{path}/snapshots", days, batch_id)
        fresh = rows
        if unique:
            rest = [n for n in rows.columns if n not in unique]
            fresh = rows.groupBy(*unique).agg(F.min(F.struct(*rest)).alias("row")).select(
                *unique, "row.*").select(*rows.columns)
            if before is not None:
                fresh = fresh.join(before.select(*unique).distinct(), list(unique), "left_anti")
        (fresh.withColumn(log.BATCH, F.lit(batch_id).cast("bigint")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(DAY, log.BATCH)
         .option("compression", "zstd").parquet(f"{path}/snapshots"))

        newest = _newest_before(spark, f"{path}/newest", batch_id, every)
        if newest is not None:
            limit = F.lit(newest) - F.expr(f"INTERVAL {LATE_SECONDS} SECONDS")
            overwrite_batch(fresh.where(F.col("snapshot_ts") < limit).drop(DAY), f"{path}/late", batch_id)
        log.append(rows.agg(F.max("snapshot_ts").alias("newest")), f"{path}/newest", batch_id)

        known = fresh.drop(DAY)
        if before is not None:
            known = known.unionByName(before.drop(DAY, log.BATCH))
        start = F.window("snapshot_ts", "15 minutes")["start"]
        touched = fresh.select(start.alias("window_start"), "idEleccion").distinct()
        changed = known.withColumn("window_start", start).join(
            touched, KEYS, "left_semi").drop("window_start")
        log.append(progress_windows(changed), f"{path}/windows", batch_id)
        log.compact_when_due(spark, f"{path}/windows", WINDOW_DDL, batch_id, every,
                             lambda df: log.newest(df, KEYS))
    finally:
        rows.unpersist()


def progress_stream(snapshots: DataFrame, path: str, checkpoint: str, every: int = 20,
                    unique: tuple[str, ...] = ()) -> StreamingQuery:
    """Follow a stream of snapshots, late ones included."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        store_batch(batch, batch_id, path, every, unique)

    return (
        snapshots.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of every window."""
    return log.newest(log.read_log(spark, f"{path}/windows", WINDOW_DDL), KEYS).drop(log.BATCH)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{SNAPSHOT_DDL}, {DAY} string, {log.BATCH} bigint").parquet(
        f"{path}/snapshots").drop(DAY, log.BATCH)


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows that came later than the lateness allows, with the batch that brought them."""
    if not path_exists(spark, f"{path}/late"):
        return spark.createDataFrame([], f"{SNAPSHOT_DDL}, {log.BATCH} bigint")
    return spark.read.schema(f"{SNAPSHOT_DDL}, {log.BATCH} bigint").parquet(f"{path}/late")
