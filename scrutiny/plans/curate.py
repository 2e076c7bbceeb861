"""Curation: last run wins, enrichment with geography, tidy votes, station universe."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutiny import contracts as c
from scrutiny.functions.scalars import electoral_district
from scrutiny.operators.filters import drop_legacy, drop_run_columns, in_scopes
from scrutiny.operators.versions import first_per_key, keep_runs, latest_runs
from scrutiny.session import scratch_path
from scrutiny.sinks.clustered import BUCKETS, write_clustered
from scrutiny.sinks.tables import delete_path, replace_table, write_table
from scrutiny.sources.tables import read_facts, read_relaxed, table_exists

CHILD_TABLES = ("actas_votos", "actas_linea_tiempo", "actas_archivos", "actas_candidatos")


def curate_header(facts: DataFrame) -> DataFrame:
    """All rows of each acta's newest run, without partition and legacy columns."""
    facts = drop_legacy(facts)
    return drop_run_columns(keep_runs(facts, latest_runs(facts)))


def curate_child(facts: DataFrame, winners: DataFrame) -> DataFrame:
    """Rows of the run that won for the *header*.

    An acta whose newest run has no detail keeps none of its older detail.
    """
    return drop_run_columns(keep_runs(facts, winners))


def enrich_header(header: DataFrame, stations: DataFrame) -> DataFrame:
    """Add scope, department, province, district name and electoral district.

    Running it again replaces the columns. The row count cannot change: the station
    table is reduced to one row per key, and a header row that meets a key with several
    stations fails the job.
    """
    header = header.drop(*c.ENRICH_COLUMNS)
    dims = (
        stations.groupBy(F.col("idMesa").alias("idMesaRef"), "ubigeoDistrito")
        .agg(
            F.count(F.lit(1)).alias("_stations"),
            *[
                F.max(name).alias(name)
                for name in ("idAmbitoGeografico", "ubigeoDepartamento", "ubigeoProvincia",
                             "nombreDistrito")
            ],
        )
    )
    unique = F.when(
        F.col("_stations") > 1,
        F.raise_error(F.concat(F.lit("several stations with id "),
                               F.col("idMesaRef").cast("string"))).cast("boolean"),
    ).otherwise(F.lit(True))
    return (
        header.join(dims, ["idMesaRef", "ubigeoDistrito"], "left")
        .filter(unique)
        .select(
            *header.columns,
            "idAmbitoGeografico", "ubigeoDepartamento", "ubigeoProvincia", "nombreDistrito",
            electoral_district("ubigeoDepartamento", "ubigeoProvincia", "idAmbitoGeografico")
            .alias("idDistritoElectoral"),
        )
    )


def enrichment_nulls(header: DataFrame) -> DataFrame:
    """One row: rows, rows without scope, rows without electoral district."""
    return header.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("idAmbitoGeografico").isNull()).alias("scope_nulls"),
        F.count_if(F.col("idDistritoElectoral").isNull()).alias("district_nulls"),
    )


def enrichment_distribution(header: DataFrame) -> DataFrame:
    return header.groupBy("idDistritoElectoral").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.col("idDistritoElectoral").asc_nulls_first()
    )


def tidy_votes(votes: DataFrame, header: DataFrame) -> DataFrame:
    """Votes with the context of their acta, 17 columns, one row per acta and party."""
    context = header.select(
        "idActa", "codigoMesa", "idAmbitoGeografico", "idDistritoElectoral",
        "ubigeoDepartamento", "ubigeoProvincia", "nombreDistrito", "codigoEstadoActa",
        "totalVotosEmitidos", "totalVotosValidos", "totalElectoresHabiles",
    )
    return votes.join(context, "idActa", "inner").select(
        "idActa", "codigoMesa", "idEleccion", "idAmbitoGeografico", "idDistritoElectoral",
        "ubigeoDepartamento", "ubigeoProvincia", "ubigeoDistrito", "nombreDistrito",
        "codigoEstadoActa", F.col("descripcion").alias("partido"), "ccodigo", "es_especial",
        "nvotos", "totalVotosEmitidos", "totalVotosValidos", "totalElectoresHabiles",
    )


def coherence(header: DataFrame, votes: DataFrame) -> DataFrame:
    """One row: header rows, vote rows, actas with votes, headers without votes."""
    per_acta = votes.groupBy("idActa").agg(F.count(F.lit(1)).alias("n"))
    stats = per_acta.agg(
        F.struct(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                 F.count(F.lit(1)).alias("actas")).alias("s")
    )
    return (
        header.agg(F.count(F.lit(1)).alias("header_rows"))
        .withColumn("s", stats.scalar())
        .select(
            "header_rows",
            F.col("s.rows").alias("vote_rows"),
            F.col("s.actas").alias("actas_with_votes"),
            (F.col("header_rows") - F.col("s.actas")).alias("headers_without_votes"),
        )
    )


def trigger_venues(venues: DataFrame, scopes: Iterable[int] = (1, 2)) -> DataFrame:
    """The first venue of each district in code order, with its scope."""
    return in_scopes(venues, scopes).groupBy("ubigeoDistrito").agg(
        F.min("codigoLocalVotacion").alias("codigoLocalGatillo"),
        F.min_by("idAmbitoGeografico",
                 F.struct("codigoLocalVotacion", "idAmbitoGeografico")).alias("idAmbitoGeografico"),
    )


def districts_to_visit(venues: DataFrame, districts: DataFrame,
                       scopes: Iterable[int] = (1, 2)) -> DataFrame:
    """Trigger venues with the names and parents of their districts."""
    places = in_scopes(districts, scopes).select(
        F.col("ubigeo").alias("_place"), "ubigeoProvincia", "ubigeoDepartamento",
        F.col("nombre").alias("nombreDistrito"),
    )
    triggers = trigger_venues(venues, scopes)
    return triggers.join(places, F.col("ubigeoDistrito") == F.col("_place"), "inner").drop("_place")


def station_universe(listing: DataFrame, venues: DataFrame, districts: DataFrame,
                     scopes: Iterable[int] = (1, 2)) -> DataFrame:
    """Listed stations with district names and parents, one row per station and place.

    ``listing`` holds ``idMesa``, ``codigoMesa`` and the ``ubigeoDistrito`` it was
    listed under. Repeated listings keep the first in order of station code.
    """
    listed = first_per_key(
        listing.select("idMesa", "codigoMesa", "ubigeoDistrito"),
        ["idMesa", "ubigeoDistrito"], ["codigoMesa"],
    )
    places = districts_to_visit(venues, districts, scopes).drop("codigoLocalGatillo")
    return listed.join(places, "ubigeoDistrito", "inner").select(
        "idMesa", "codigoMesa", "ubigeoDistrito", "ubigeoProvincia", "ubigeoDepartamento",
        "nombreDistrito", "idAmbitoGeografico",
    )


def build_curated(spark: SparkSession, facts: str, curated: str,
                  stations: DataFrame | None = None, relaxed: bool = True) -> Mapping[str, str]:
    """The whole curation: header and children, enrichment, tidy votes.

    The winners (one row per acta) are written once to the shared folder and read by
    every child table, so the header facts are reduced a single time and a lost
    executor costs no recomputation of them. They are deleted at the end.

    ``relaxed`` keeps columns beyond the contract and reads files whose types drifted apart;
    without it only the contract's columns are scanned, for facts known to meet it.
    """
    def facts_of(table: str) -> DataFrame:
        base = f"{facts}/{table}"
        return read_relaxed(spark, base, table) if relaxed else read_facts(spark, base, table)

    header_facts = drop_legacy(facts_of("actas_cabecera"))
    winners_path = scratch_path(spark, "winners")
    write_table(latest_runs(header_facts), winners_path)
    winners = spark.read.parquet(winners_path)

    out = {"actas_cabecera": f"{curated}/actas_cabecera"}
    header = drop_run_columns(keep_runs(header_facts, winners))
    if stations is not None:
        header = enrich_header(header, stations)
    replace_table(header, out["actas_cabecera"])
    for table in CHILD_TABLES:
        if table != "actas_votos" and not table_exists(spark, f"{facts}/{table}"):
            continue
        out[table] = f"{curated}/{table}"
        replace_table(curate_child(facts_of(table), winners), out[table])
    if stations is not None:
        out["actas_votos_tidy"] = f"{curated}/actas_votos_tidy"
        replace_table(
            tidy_votes(spark.read.parquet(out["actas_votos"]),
                       spark.read.parquet(out["actas_cabecera"])),
            out["actas_votos_tidy"],
        )
    delete_path(spark, winners_path)
    return out


def build_clustered(spark: SparkSession, facts: str, curated: str, stations: DataFrame,
                    database: str = "default", buckets: int = BUCKETS) -> Mapping[str, str]:
    """The curation with header, children and tidy votes clustered by acta; the tables' names.

    Header and children have the same buckets, so the tidy votes (and any later join or count
    by acta) are made bucket by bucket: the votes are shuffled once, when their bucketed table is
    written. Facts are scanned by their contract.
    """
    header_facts = drop_legacy(read_facts(spark, f"{facts}/actas_cabecera", "actas_cabecera"))
    winners_path = scratch_path(spark, "winners")
    write_table(latest_runs(header_facts), winners_path)
    winners = spark.read.parquet(winners_path)

    def write(df: DataFrame, table: str) -> DataFrame:
        return write_clustered(df, f"{database}.{table}", f"{curated}/{table}", "idActa", buckets)

    header = write(
        enrich_header(drop_run_columns(keep_runs(header_facts, winners)), stations), "actas_cabecera")
    written = ["actas_cabecera"]
    for table in CHILD_TABLES:
        if table == "actas_votos" or table_exists(spark, f"{facts}/{table}"):
            write(curate_child(read_facts(spark, f"{facts}/{table}", table), winners), table)
            written.append(table)
    tidy = tidy_votes(spark.table(f"{database}.actas_votos"), header)
    tidy.write.mode("overwrite").option("compression", "zstd").parquet(f"{curated}/actas_votos_tidy")
    delete_path(spark, winners_path)
    return {**{t: f"{database}.{t}" for t in written}, "actas_votos_tidy": f"{curated}/actas_votos_tidy"}
