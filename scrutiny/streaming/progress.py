"""Progress series of the count, and the catalogue alert, as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scrutiny.plans.catalogue import monitor
from scrutiny.sources.tables import table_exists
from scrutiny.streaming.common import overwrite_batch

#: Snapshots later than this are dropped.
LATENESS = "1 hour"


def _late_bounded(stream: DataFrame, ts: str) -> DataFrame:
    """With the watermark, which wants a timestamp with time zone."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, LATENESS)


def unique_snapshots(snapshots: DataFrame, ts: str = "snapshot_ts",
                     keys: tuple[str, ...] = ("idEleccion", "snapshot_ts")) -> DataFrame:
    """Repeated snapshots collapse to one while they can still arrive."""
    return _late_bounded(snapshots, ts).dropDuplicatesWithinWatermark(list(keys))


def progress_windows(snapshots: DataFrame, ts: str = "snapshot_ts",
                     every: str = "15 minutes") -> DataFrame:
    """Per quarter of an hour and election: the last snapshot and how many there were.

    Works on a stream and on a table alike.
    """
    values = F.struct("contabilizadas", "totalActas", "pct")
    frame = _late_bounded(snapshots, ts) if snapshots.isStreaming else snapshots
    return (
        frame.groupBy(F.window(ts, every).alias("w"), "idEleccion")
        .agg(F.max_by(values, ts).alias("last"), F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), "idEleccion", "last.contabilizadas",
                "last.totalActas", "last.pct", "n")
    )


def write_updates(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write every batch's changed rows; readers take the newest batch of each key."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        overwrite_batch(batch, path, batch_id)

    return (
        stream.writeStream.outputMode("update").foreachBatch(handle)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream's rows to Parquet files, exactly once."""
    return (
        stream.writeStream.outputMode("append").format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def monitor_stream(entries: DataFrame, previous: DataFrame, path: str,
                   checkpoint: str) -> StreamingQuery:
    """New catalogue entries as they arrive, each with whether it announces results.

    An address counts once: not again in its batch, and not if an earlier batch reported it,
    so what is written is the saved catalogue that later deliveries are compared with.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        order = [n for n in batch.columns if n != "url"]
        first = batch.groupBy("url").agg(F.min(F.struct(*order)).alias("row"))
        new = monitor(first.select("row.*", "url").select(*batch.columns), previous)
        if table_exists(spark, path):
            before = spark.read.parquet(path).where(F.col("batch_id") < batch_id)
            new = new.join(before.select("url").distinct(), "url", "left_anti")
        overwrite_batch(new, path, batch_id)

    return (
        entries.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
