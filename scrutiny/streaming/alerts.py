"""New catalogue entries as they arrive, against a log of known addresses that is compacted.

What is known is one narrow table: the addresses of the first catalogue and of every entry
reported since, a batch of the log each and a compacted base. A batch reads base and log
(a bounded number of folders) and writes its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scrutiny.plans.catalogue import monitor
from scrutiny.sinks.tables import path_exists
from scrutiny.streaming import log
from scrutiny.streaming.common import overwrite_batch

KNOWN_DDL = "url string"


def _distinct(rows: DataFrame) -> DataFrame:
    return rows.groupBy("url").agg(F.min(log.BATCH).alias(log.BATCH))


def alert_batch(batch: DataFrame, batch_id: int, path: str, previous: DataFrame,
                every: int = 20) -> None:
    """Report the entries of a batch whose address is new; an address counts once.

    Of several entries with one address the smallest row is reported; entries without an
    address can't be told apart and are left out.
    """
    spark = batch.sparkSession
    order = [n for n in batch.columns if n != "url"]
    first = (batch.where(F.col("url").isNotNull()).groupBy("url")
             .agg(F.min(F.struct(*order)).alias("row"))
             .select("row.*", "url").select(*batch.columns))
    known = log.read_log(spark, f"{path}/known", KNOWN_DDL, before=batch_id)
    new = monitor(first.join(known.select("url").distinct(), "url", "left_anti").select(*batch.columns),
                  previous).persist()
    try:
        overwrite_batch(new, f"{path}/alerts", batch_id)
        log.append(new.select("url"), f"{path}/known", batch_id)
    finally:
        new.unpersist()
    log.compact_when_due(spark, f"{path}/known", KNOWN_DDL, batch_id, every, _distinct)


def alert_stream(entries: DataFrame, previous: DataFrame, path: str, checkpoint: str,
                 every: int = 20) -> StreamingQuery:
    """Follow a stream of catalogue entries."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        alert_batch(batch, batch_id, path, previous, every)

    return (
        entries.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def read_alerts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All entries reported so far, with whether their title announces results."""
    if not path_exists(spark, f"{path}/alerts"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/alerts").drop(log.BATCH)
