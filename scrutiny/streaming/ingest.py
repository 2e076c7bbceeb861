"""Incremental ingest of landed documents into the run-versioned fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scrutiny.plans.ingest import flatten_documents, outcomes, run_ledger
from scrutiny.sinks.tables import delete_path, path_exists, write_run
from scrutiny.sources.documents import REQUEST_DDL, parse_documents
from scrutiny.streaming.common import file_stream, overwrite_batch

#: What lands: the request's columns and the answer as text, one JSON object per line.
LANDED_DDL = REQUEST_DDL + ", body string"


#: The completion ledger: what became of each acta in a batch.
DONE_DDL = "req_acta_id bigint, outcome string, run_ts_ms bigint, batch_id bigint"


def best_documents(parsed: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """Each acta of a batch once: a readable document before an unreadable one, then the newest.

    Ties go to the larger text. Documents without the acta they answer have no key to be done
    under and stay as they are. ``done`` (``req_acta_id, outcome``) leaves out what the run no
    longer needs: an acta is done once a document of it could be read; an unreadable answer keeps
    only further unreadable ones out. Its rows meet the documents in the same shuffle.
    """
    rest = [n for n in parsed.columns if n not in ("parsed", "body")]
    # The text is part of the order; it travels once.
    at = F.coalesce("snapshot_ts_ms", F.lit(0)).alias("_at")
    rows = parsed.select(
        "req_acta_id",
        F.when(F.col("req_acta_id").isNull(), F.monotonically_increasing_id()).alias("_keyless"),
        F.struct("parsed", at, "body", *rest).alias("_doc"))
    if done is not None:
        rows = rows.unionByName(
            done.select("req_acta_id", (F.col("outcome") != "failed").alias("_read")),
            allowMissingColumns=True)
    else:
        rows = rows.withColumn("_read", F.lit(None).cast("boolean"))
    best = rows.groupBy("req_acta_id", "_keyless").agg(
        F.max("_doc").alias("_doc"), F.bool_or("_read").alias("_read"))
    needed = F.col("_read").isNull() | (~F.col("_read") & F.col("_doc.parsed"))
    return best.where(F.col("_doc").isNotNull() & needed).select(
        *[F.col("_doc")[n].alias(n) for n in parsed.columns])


def completed(spark: SparkSession, base: str, run_ts_ms: int,
              before_batch: int | None = None) -> DataFrame:
    """What a run has recorded: ``req_acta_id, outcome, run_ts_ms, batch_id``.

    The ledger is partitioned by run, so this reads one run, however many there were. Rows of
    the batch itself (written before a failure) and of later ones can be left out.
    """
    path = f"{base.rstrip('/')}/_done"
    if not path_exists(spark, f"{path}/run_ts_ms={run_ts_ms}"):
        return spark.createDataFrame([], DONE_DDL)
    rows = spark.read.schema(DONE_DDL).parquet(path).where(F.col("run_ts_ms") == run_ts_ms)
    return rows if before_batch is None else rows.where(F.col("batch_id") < before_batch)


def run_outcomes(spark: SparkSession, base: str, run_ts_ms: int) -> DataFrame:
    """The final outcome of every acta of a run: a later good answer replaces a failure."""
    rank = F.when(F.col("outcome") == "failed", 0).otherwise(1)
    return (completed(spark, base, run_ts_ms).groupBy("req_acta_id")
            .agg(F.max_by("outcome", F.struct(rank, "batch_id")).alias("outcome")))


def run_accounting(spark: SparkSession, base: str, run_ts_ms: int) -> DataFrame:
    """``ok, empty, failed`` actas of a run, each acta counted once."""
    return run_outcomes(spark, base, run_ts_ms).agg(
        *[F.count_if(F.col("outcome") == x).alias(x) for x in ("ok", "empty", "failed")])


def ingest_batch(batch: DataFrame, batch_id: int, base: str, run_ts_ms: int,
                 expected: int = 0) -> None:
    """One micro-batch of parsed documents: five fact tables, the quarantine, the ledgers.

    Every output lies under the batch's own partition, so a batch that is replayed after a
    failure replaces what it had written. What is done is known from the run's completion
    ledger, which the batch writes last: the stream itself holds no state. The documents are
    staged as nested Parquet (the text of unreadable ones only), of which each table reads
    its own columns; the staging goes with the batch.
    """
    spark = batch.sparkSession
    best = best_documents(batch, completed(spark, base, run_ts_ms, batch_id) if batch_id else None)
    staging = f"{base}/_staged/run_ts_ms={run_ts_ms}/batch_id={batch_id}"
    try:
        best.withColumn("body", F.when(~F.col("parsed"), F.col("body"))).write.mode(
            "overwrite").option("compression", "zstd").parquet(staging)
        batch = spark.read.schema(best.schema).parquet(staging)
        good = batch.filter("parsed")
        write_run(flatten_documents(good), base, run_ts_ms, batch_id)
        overwrite_batch(
            batch.filter(~F.col("parsed")).select("req_acta_id", "snapshot_ts_ms", "body"),
            f"{base}/_quarantine/run_ts_ms={run_ts_ms}", batch_id)
        run_ledger(batch, run_ts_ms, batch_id, expected).write.mode("overwrite").json(
            f"{base}/_ledger/run={run_ts_ms}/batch={batch_id}")
        overwrite_batch(
            outcomes(batch).where(F.col("req_acta_id").isNotNull()).select("req_acta_id", "outcome"),
            f"{base}/_done/run_ts_ms={run_ts_ms}", batch_id)
    finally:
        delete_path(spark, staging)


def ingest_stream(spark: SparkSession, landed: str, base: str, checkpoint: str, run_ts_ms: int,
                  expected: int = 0, max_files: int = 500,
                  volatile: DataFrame | None = None) -> StreamingQuery:
    """Work off the landed files in bounded batches; a restart resumes where it stopped.

    The same checkpoint serves run after run: a later run (another ``run_ts_ms``) takes the
    files landed since, and its documents become the newer version of actas that an earlier
    run has. ``volatile`` (``idActa``) limits a refresh to actas that can still change.
    """
    source = file_stream(spark, landed, LANDED_DDL, "json", max_files)

    def handle(batch: DataFrame, batch_id: int) -> None:
        wanted = batch if volatile is None else refresh_stream(batch, volatile)
        ingest_batch(parse_documents(wanted), batch_id, base, run_ts_ms, expected)

    return (
        source.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def refresh_stream(landed: DataFrame, volatile: DataFrame) -> DataFrame:
    """Documents of actas that can still change; terminal actas keep their version.

    The keys grow with the actas, and a compressed file says little about their number: they
    are never broadcast. A stream of single documents meets them the same way.
    """
    keys = volatile.select(F.col("idActa").alias("req_acta_id")).distinct()
    return landed.join(keys.hint("merge"), "req_acta_id", "left_semi")
