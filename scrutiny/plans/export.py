"""Exports with filters, release views, completeness and checksums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutiny import contracts as c
from scrutiny.functions.aggregates import distinct_values, total
from scrutiny.operators.filters import apply_selection
from scrutiny.operators.unions import union_all
from scrutiny.sinks.commits import current
from scrutiny.sinks.tables import path_exists

_CONTEXT = (
    "idActa", "codigoMesa", "nombreLocalVotacion", "totalElectoresHabiles",
    "totalVotosEmitidos", "totalVotosValidos", "totalAsistentes",
    "porcentajeParticipacionCiudadana", "codigoEstadoActa", "ubigeoDepartamento",
    "ubigeoProvincia", "nombreDistrito", "idAmbitoGeografico", "idDistritoElectoral",
)
# Columns of the exports, in their order.
LONG_COLUMNS = (
    "idActa", "codigoMesa", "idEleccion", "idDistritoElectoral", "idAmbitoGeografico",
    "ubigeoDepartamento", "ubigeoProvincia", "ubigeoDistrito", "nombreDistrito",
    "nombreLocalVotacion", "codigoEstadoActa", "totalElectoresHabiles",
    "totalVotosEmitidos", "totalVotosValidos", "totalAsistentes",
    "porcentajeParticipacionCiudadana", "partido", "ccodigo", "es_especial", "nvotos",
    "nporcentajeVotosValidos", "nporcentajeVotosEmitidos",
)
SUMMARY_KEYS = (
    "idEleccion", "idDistritoElectoral", "ubigeoDepartamento", "ubigeoProvincia",
    "ubigeoDistrito", "nombreDistrito", "partido", "ccodigo", "es_especial",
)
#: Votes that one task of the summary joins and adds up.
ROWS_PER_TASK = 250_000


def export_long(votes: DataFrame, header: DataFrame,
                filters: Sequence[Column] = ()) -> DataFrame:
    """One row per acta and party with the acta's context, 22 columns.

    Filters are stated after the join; those on one side's columns reach that side's
    scan.
    """
    joined = votes.withColumnRenamed("descripcion", "partido").join(
        header.select(*_CONTEXT), "idActa", "inner")
    return apply_selection(joined, list(filters)).select(*LONG_COLUMNS)


def export_district_summary(votes: DataFrame, header: DataFrame,
                            filters: Sequence[Column] = (), clustered: bool = False) -> DataFrame:
    """Sums per place, election and party; strongest first within a place.

    A task of the join holds its rows, nine wide keys and the acta, in sorts and maps: many times
    the bytes it reads, by which adaptive execution would put tasks together. So the votes are
    counted, and both sides are dealt by acta to tasks of ``ROWS_PER_TASK`` votes. Tables that are
    ``clustered`` by acta need neither count nor shuffle: their buckets are the tasks.
    """
    if not clustered:
        cores = votes.sparkSession.sparkContext.defaultParallelism
        tasks = max(cores, 2, -(-votes.count() // ROWS_PER_TASK))
        votes, header = votes.repartition(tasks, "idActa"), header.repartition(tasks, "idActa")
    return (
        export_long(votes, header, filters)
        .groupBy(*SUMMARY_KEYS)
        .agg(
            total("nvotos").alias("nvotos"),
            total("totalElectoresHabiles").alias("padron_distrito"),
            total("totalVotosEmitidos").alias("emitidos_distrito"),
            total("totalVotosValidos").alias("validos_distrito"),
            distinct_values("idActa").alias("actas"),
        )
        .orderBy("idEleccion", "ubigeoDistrito", F.abs("nvotos").desc(), "ccodigo", "partido")
    )


def export_header(header: DataFrame, filters: Sequence[Column] = ()) -> DataFrame:
    return apply_selection(header, list(filters))


def presidential_by_place(tidy: DataFrame) -> DataFrame:
    """Presidential votes per place and party."""
    return (
        tidy.filter(F.col("idEleccion") == c.ELECTION_PRESIDENT)
        .groupBy("idDistritoElectoral", "ubigeoDepartamento", "ubigeoDistrito",
                 "nombreDistrito", "partido", "ccodigo", "es_especial")
        .agg(total("nvotos").alias("nvotos"))
        .orderBy("idDistritoElectoral", "ubigeoDistrito", F.col("nvotos").desc(), "ccodigo")
    )


def national_totals(tidy: DataFrame) -> DataFrame:
    """Votes per election and party."""
    return (
        tidy.groupBy("idEleccion", "partido", "ccodigo", "es_especial")
        .agg(total("nvotos").alias("nvotos"))
        .orderBy("idEleccion", F.col("nvotos").desc(), "ccodigo")
    )


# --- release package ----------------------------------------------------------


class IncompleteRelease(RuntimeError):
    """Required tables are missing."""


def release_plan(spark: SparkSession, base: str) -> DataFrame:
    """Every table of the package: layer, name, target, required, present."""
    rows = []
    for layer, name, required in c.RELEASE_TABLES:
        prefix = "" if layer == "curated" else f"{layer}_"
        rows.append((layer, name, prefix + name, required,
                     path_exists(spark, f"{base.rstrip('/')}/{layer}/{name}")))
    return spark.createDataFrame(
        rows, "layer string, name string, target string, required boolean, present boolean")


def missing_required(plan: DataFrame) -> DataFrame:
    return plan.filter(F.col("required") & ~F.col("present"))


def assemble_release(spark: SparkSession, base: str, target: str) -> list[str]:
    """Copy the present tables under their release names; refuse if one is missing."""
    plan = release_plan(spark, base).collect()
    gone = [f"{r['layer']}/{r['name']}" for r in plan if r["required"] and not r["present"]]
    if gone:
        raise IncompleteRelease("required tables missing: " + ", ".join(gone))
    written = []
    for row in plan:
        if row["present"]:
            path = f"{target.rstrip('/')}/{row['target']}"
            source = f"{base.rstrip('/')}/{row['layer']}/{row['name']}"
            version = current(spark, source)
            spark.read.parquet(f"{source}/{version['folder']}" if version else source).write.mode(
                "overwrite").option("compression", "zstd").parquet(path)
            written.append(path)
    return written


def release_contents(spark: SparkSession, base: str, target: str) -> DataFrame:
    """Assemble the package and count what each released table holds: ``target, rows``.

    A table is copied from one version: the one its pointer names, or its folder. There is a
    constant number of tables; their rows are read and written by Spark.
    """
    tables = [
        spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(path.rsplit("/", 1)[-1]).alias("target"), "rows")
        for path in assemble_release(spark, base, target)
    ]
    return union_all(tables)


def checksum_manifest(manifest: DataFrame, own_name: str = "CHECKSUMS.txt") -> DataFrame:
    """Digest and relative path of every file but the manifest itself, by path."""
    name = F.substring_index("rel_path", "/", -1)
    return manifest.filter(name != own_name).select("sha256", "rel_path").orderBy("rel_path")


def package_summary(manifest: DataFrame) -> DataFrame:
    """Files, bytes and megabytes per top folder (``.`` for the root) and in total."""
    parts = F.split("rel_path", "/")
    folder = F.when(F.size(parts) > 1, parts[0]).otherwise(F.lit("."))
    per_folder = manifest.groupBy(folder.alias("folder")).agg(
        F.count(F.lit(1)).alias("files"), total("bytes").alias("bytes"))
    whole = per_folder.agg(total("files").alias("files"), total("bytes").alias("bytes")).select(
        F.lit("total").alias("folder"), "files", "bytes")
    return union_all([per_folder, whole]).withColumn(
        "mb", F.round(F.col("bytes") / F.lit(1_000_000.0), 2))

