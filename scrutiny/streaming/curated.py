"""A curated table that follows the fact stream: the last run wins, continuously."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scrutiny.operators.versions import keep_runs, latest_runs
from scrutiny.sinks.tables import delete_path, path_exists

BUCKET = "bucket"


def merge_batch(batch: DataFrame, batch_id: int, path: str, key: str = "idActa",
                buckets: int = 64) -> None:
    """Merge new facts into the curated table, rewriting only the buckets they touch.

    The table is laid out by a hash of the key; all rows of each key's newest run are
    kept. The merged buckets are complete in a staging folder (marked by its success
    file) before they replace the old ones: a batch replayed after a failure goes on from
    the staged files, so it is never merged twice and never reads a half-replaced table.
    The staging of the batch before is dropped, as that batch is committed by now.
    """
    spark = batch.sparkSession
    stages = f"{path.rstrip('/')}.staging"
    staging = f"{stages}/batch_id={batch_id}"
    delete_path(spark, f"{stages}/batch_id={batch_id - 1}")
    if not path_exists(spark, f"{staging}/_SUCCESS"):
        incoming = batch.withColumn(
            BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).persist()
        try:
            merged = incoming
            if path_exists(spark, path):
                touched = [r[0] for r in incoming.select(BUCKET).distinct().collect()]
                current = spark.read.schema(incoming.schema).parquet(path).filter(
                    F.col(BUCKET).isin(*touched))
                merged = current.unionByName(incoming)
            keep_runs(merged, latest_runs(merged, key), key).write.mode("overwrite").partitionBy(
                BUCKET).option("compression", "zstd").parquet(staging)
        finally:
            incoming.unpersist()
    ready = spark.read.parquet(staging)
    ready.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        BUCKET).option("compression", "zstd").parquet(path)


def curated_stream(facts: DataFrame, path: str, checkpoint: str, key: str = "idActa",
                   buckets: int = 64) -> StreamingQuery:
    """Keep a curated table up to date from a stream of run-versioned facts."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, path, key, buckets)

    return (
        facts.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)
