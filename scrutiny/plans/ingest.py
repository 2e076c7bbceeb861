"""Documents to fact tables, task universes, refresh sets, run accounting."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrutiny import contracts as c
from scrutiny.functions.scalars import (
    file_id_is_valid,
    first_candidate,
    is_special_row,
    lima_iso,
    shard_of,
    sharded_path,
)
from scrutiny.operators.contract_checks import conform
from scrutiny.operators.filters import in_states
from scrutiny.operators.keys import first_tasks, in_shard, pending, station_tasks
from scrutiny.operators.ranking import share_of_all
from scrutiny.sinks.tables import write_run
from scrutiny.sources.documents import stage_documents


def _document_id() -> Column:
    """The document's own id, or the requested one where it is null or zero."""
    return F.coalesce(F.nullif(F.col("id"), F.lit(0)), F.col("req_acta_id"))


def _header_fields() -> list[str]:
    """Plain fields of the document; the arrays become tables of their own."""
    return [f.name for f in c.schema(c.DOCUMENT_DDL).fields
            if not isinstance(f.dataType, T.ArrayType)]


def _key() -> list[Column]:
    return [
        F.col("_acta").alias("idActa"),
        F.col("idEleccion"),
        F.col("req_ubigeo").alias("ubigeoDistrito"),
        F.col("snapshot_ts_ms"),
        lima_iso("snapshot_ts_ms").alias("snapshot_lima_iso"),
    ]


def flatten_documents(documents: DataFrame) -> dict[str, DataFrame]:
    """Nested documents to the five fact tables.

    Documents without a station code stand for stations that do not exist and give no
    rows. Children take the acta's id, election, place and stamps. Positions inside
    arrays become columns starting at zero.
    """
    docs = documents.filter(F.col("codigoMesa").isNotNull()).withColumn("_acta", _document_id())

    header = docs.select(
        *_header_fields(),
        F.col("_acta").alias("idActa"),
        F.col("req_id_mesa").alias("idMesaRef"),
        F.col("req_ubigeo").alias("ubigeoDistrito"),
        "snapshot_ts_ms",
        lima_iso("snapshot_ts_ms").alias("snapshot_lima_iso"),
    )

    rows = docs.select(*_key(), F.explode("detalle").alias("d"))
    description = F.coalesce(F.col("d.descripcion"), F.lit(""))
    votes = rows.select(
        "*",
        description.alias("descripcion"),
        is_special_row(description).alias("es_especial"),
        "d.ccodigo", "d.nposicion", "d.nvotos", "d.nagrupacionPolitica",
        "d.nporcentajeVotosValidos", "d.nporcentajeVotosEmitidos", "d.estado", "d.grafico",
        "d.cargo", "d.sexo", "d.totalCandidatos",
        *first_candidate("d.candidato"),
    )

    candidates = rows.select(
        "*", F.col("d.ccodigo").alias("partido_ccodigo"),
        F.posexplode("d.candidato").alias("candidato_idx", "p"),
    ).select("*", "p.*")

    timeline = docs.select(
        *_key(), F.posexplode("lineaTiempo").alias("evento_idx", "e")
    ).select("*", "e.*")

    files = docs.select(*_key(), F.explode("archivos").alias("a")).select(
        "*", F.col("a.id").alias("archivoId"), "a.tipo", "a.nombre", "a.descripcion",
        "a.daudFechaCreacion",
    )
    return {
        "actas_cabecera": conform(header, "actas_cabecera"),
        "actas_votos": conform(votes, "actas_votos"),
        "actas_linea_tiempo": conform(timeline, "actas_linea_tiempo"),
        "actas_archivos": conform(files, "actas_archivos"),
        "actas_candidatos": conform(candidates, "actas_candidatos"),
    }


def ingest_run(landed: DataFrame, base: str, run_ts_ms: int, expected: int = 0) -> DataFrame:
    """Landed documents of a run to the five fact tables; its ledger row.

    The documents are parsed once, into nested Parquet under ``base/_parsed``; the five tables,
    the quarantine and the ledger are read from there. A rerun overwrites all it wrote.
    """
    base = base.rstrip("/")
    documents = stage_documents(landed, f"{base}/_parsed/run_ts_ms={run_ts_ms}")
    write_run(flatten_documents(documents.filter("parsed")), base, run_ts_ms)
    documents.filter(~F.col("parsed")).select("req_acta_id", "snapshot_ts_ms", "body").write.mode(
        "overwrite").option("compression", "zstd").parquet(f"{base}/_quarantine/run_ts_ms={run_ts_ms}")
    ledger = run_ledger(documents, run_ts_ms, 0, expected)
    ledger.write.mode("overwrite").json(f"{base}/_ledger/run={run_ts_ms}/batch=0")
    return ledger


def task_universe(
    stations: DataFrame,
    elections: Iterable[int] = c.ELECTIONS,
    shard: tuple[int, int] | None = None,
    done: DataFrame | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Tasks of an ingest run: shard of the stations, times elections, minus done ones."""
    if shard is not None:
        stations = in_shard(stations, "idMesa", *shard)
    tasks = station_tasks(stations, elections)
    if limit is not None:
        tasks = first_tasks(tasks, limit)
    return pending(tasks, done) if done is not None else tasks


def volatile_tasks(header: DataFrame, states: Iterable[str] = c.VOLATILE_STATES) -> DataFrame:
    """Tasks for the actas whose state can still change."""
    return in_states(header, states).select("idActa", "idMesaRef", "ubigeoDistrito", "idEleccion")


def state_distribution(header: DataFrame) -> DataFrame:
    """Actas and share per state, most frequent first."""
    counts = header.groupBy("codigoEstadoActa").agg(F.count(F.lit(1)).alias("n"))
    return share_of_all(counts, "n", "pct").orderBy(
        F.col("n").desc(), F.col("codigoEstadoActa").asc_nulls_first()
    )


def file_targets(
    header: DataFrame,
    files: DataFrame,
    states: Iterable[str] = (c.STATE_COUNTED,),
    kinds: Iterable[int] | None = None,
    shard: tuple[int, int] | None = None,
    limit: int | None = None,
    root: str = "pdfs",
) -> DataFrame:
    """Distinct files to fetch for actas in given states, with validity and target path."""
    if kinds:
        files = files.filter(F.col("tipo").isin(*kinds))
    ids = (
        files.filter(F.col("archivoId").isNotNull())
        .join(in_states(header, states).select("idActa").distinct(), "idActa", "left_semi")
        .select("archivoId").distinct()
    )
    if limit is not None:
        ids = first_tasks(ids, limit, ["archivoId"])
    if shard is not None:
        ids = in_shard(ids, "archivoId", *shard)
    return ids.select(
        "archivoId",
        file_id_is_valid("archivoId").alias("valid"),
        sharded_path(root, "archivoId").alias("path"),
    )


def shard_sizes(df: DataFrame, key: str, shards: int) -> DataFrame:
    """Keys per shard: together they are the whole universe."""
    return df.groupBy(shard_of(key, shards).alias("shard")).agg(F.count(F.lit(1)).alias("n"))


def outcomes(documents: DataFrame) -> DataFrame:
    """ok, empty (no such station) or failed (no readable answer) per document."""
    return documents.withColumn(
        "outcome",
        F.when(~F.col("parsed"), F.lit("failed"))
        .when(F.col("codigoMesa").isNull(), F.lit("empty"))
        .otherwise(F.lit("ok")),
    )


def run_ledger(documents: DataFrame, run_ts_ms: int | Column, batch_id: int,
               expected: int | Column) -> DataFrame:
    """One ledger row for a batch: expected, ok, empty and failed documents."""
    def lit(value: int | Column) -> Column:
        return value if isinstance(value, Column) else F.lit(value).cast("bigint")

    counts = outcomes(documents).agg(
        *[F.count_if(F.col("outcome") == x).alias(x) for x in ("ok", "empty", "failed")]
    )
    return counts.select(
        lit(run_ts_ms).alias("run_ts_ms"), lit(batch_id).alias("batch_id"),
        lit(expected).alias("expected"), "ok", "empty", "failed",
    )


def run_progress(ledger: DataFrame) -> DataFrame:
    """Completed, expected and percentage per run; failed documents are not complete."""
    done = F.sum(F.col("ok") + F.col("empty"))
    return ledger.groupBy("run_ts_ms").agg(
        F.coalesce(done, F.lit(0)).alias("completed"),
        F.coalesce(F.max("expected"), F.lit(0)).alias("expected"),
    ).select(
        "run_ts_ms", lima_iso("run_ts_ms").alias("started_iso"), "completed", "expected",
        F.when(F.col("expected") > 0, F.col("completed") * F.lit(100.0) / F.col("expected"))
        .otherwise(F.lit(0.0)).alias("pct"),
    )
