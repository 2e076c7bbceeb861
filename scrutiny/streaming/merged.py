"""The last run of every key, continuously, by merge on read.

Facts are appended as they come; next to them a narrow log holds the newest run of each key of
each batch. A reader reduces that log to the winners and keeps the facts of the winning runs
by a left-semi join. Compaction drops the facts that lost. A batch of one key writes one small
file to each log, whatever the size of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scrutiny.operators.versions import keep_runs, latest_runs
from scrutiny.streaming import log

RUN = "run_ts_ms"
#: Batches between two compactions.
EVERY = 20


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def append_facts(batch: DataFrame, batch_id: int, path: str, key: str = "idActa") -> None:
    """Add a batch of run-versioned facts; rows without a key or a run are not versions."""
    batch = batch.where(F.col(key).isNotNull() & F.col(RUN).isNotNull()).persist()
    try:
        log.append(batch, f"{path}/facts", batch_id)
        log.append(latest_runs(batch, key), f"{path}/winners", batch_id)
    finally:
        batch.unpersist()


def winners(spark: SparkSession, path: str, key_type: str, key: str = "idActa") -> DataFrame:
    """The newest run of every key; reads the narrow log only."""
    return latest_runs(log.read_log(spark, f"{path}/winners", f"`{key}` {key_type}, {RUN} bigint"), key)


def read_merged(spark: SparkSession, path: str, schema: str, key: str = "idActa") -> DataFrame:
    """All facts of the newest run of every key."""
    facts = log.read_log(spark, f"{path}/facts", schema)
    kind = facts.schema[key].dataType.simpleString()
    return keep_runs(facts, winners(spark, path, kind, key), key).drop(log.BATCH)


def compact(spark: SparkSession, path: str, schema: str, key: str = "idActa") -> None:
    """Drop the facts that lost and put the batches together.

    The facts go first: a failure in between leaves winners that are only spread over more
    files. A winner never points to facts that are gone, because winners only grow.
    """
    facts = log.read_log(spark, f"{path}/facts", schema)
    kind = facts.schema[key].dataType.simpleString()
    best = winners(spark, path, kind, key)
    log.compact(spark, f"{path}/facts", schema, lambda rows: keep_runs(rows, best, key))
    log.compact(
        spark, f"{path}/winners", f"`{key}` {kind}, {RUN} bigint",
        lambda rows: rows.groupBy(key).agg(F.max(RUN).alias(RUN), F.max(log.BATCH).alias(log.BATCH)))


def merged_stream(facts: DataFrame, path: str, checkpoint: str, key: str = "idActa",
                  every: int = EVERY) -> StreamingQuery:
    """Follow a stream of run-versioned facts; compacts every so many batches (0: never)."""
    schema = _ddl(facts)

    def handle(batch: DataFrame, batch_id: int) -> None:
        append_facts(batch, batch_id, path, key)
        if every and batch_id - log.mark(batch.sparkSession, f"{path}/facts") >= every:
            compact(batch.sparkSession, path, schema, key)

    return (
        facts.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
