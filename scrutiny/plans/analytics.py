"""Results and turnout: totals, shares, winners, abroad, progress."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutiny import contracts as c
from scrutiny.functions.aggregates import distinct_values, total
from scrutiny.functions.scalars import clipped_pct, lima_iso
from scrutiny.operators.keys import only_in
from scrutiny.operators.ranking import (
    share_of_all,
    share_of_group,
    top,
    top_per_group,
    winners,
)
from scrutiny.operators.unions import union_all
from scrutiny.operators.versions import last_snapshots

def _presidential(df: DataFrame) -> DataFrame:
    return df.filter(F.col("idEleccion") == c.ELECTION_PRESIDENT)


def _counted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("codigoEstadoActa") == c.STATE_COUNTED)


def _parties(votes: DataFrame) -> DataFrame:
    return votes.filter(~F.col("es_especial"))


def _pct(part: str, whole: str, digits: int | None = None) -> Column:
    value = F.try_divide(F.col(part) * F.lit(100.0), F.col(whole))
    return value if digits is None else F.round(value, digits)


# --- executive figures --------------------------------------------------------


def executive_totals(header: DataFrame) -> DataFrame:
    """One row: actas, distinct stations, distinct elections."""
    return header.agg(
        F.count(F.lit(1)).alias("actas"),
        distinct_values("codigoMesa").alias("mesas"),
        distinct_values("idEleccion").alias("elecciones"),
    )


def states_with_share(header: DataFrame) -> DataFrame:
    counts = header.groupBy("codigoEstadoActa").agg(F.count(F.lit(1)).alias("n"))
    return share_of_all(counts, "n", "pct").orderBy(F.col("n").desc(), "codigoEstadoActa")


def actas_by_election(header: DataFrame) -> DataFrame:
    return header.groupBy("idEleccion").agg(F.count(F.lit(1)).alias("n")).orderBy("idEleccion")


def roll_by_scope(header: DataFrame) -> DataFrame:
    """Presidential actas and voters on the roll, at home and abroad."""
    return _presidential(header).groupBy("idAmbitoGeografico").agg(
        F.count(F.lit(1)).alias("actas"), total("totalElectoresHabiles").alias("electores")
    )


# --- parties ------------------------------------------------------------------


def party_totals(votes: DataFrame) -> DataFrame:
    """Votes of each party per election with its share of the election's party votes."""
    totals = (
        _parties(votes).groupBy("idEleccion", "nagrupacionPolitica", "descripcion")
        .agg(total("nvotos").alias("total_votos"))
    )
    return share_of_group(totals, ["idEleccion"], "total_votos", "sum_eleccion", "pct")


def top_parties(votes: DataFrame, k: int = 10) -> DataFrame:
    return top_per_group(
        party_totals(votes), ["idEleccion"],
        [F.col("total_votos").desc(), F.col("descripcion").asc(),
         F.col("nagrupacionPolitica").asc()], k,
    )


def national_top(votes: DataFrame, k: int = 10) -> DataFrame:
    """Strongest presidential parties and their share among themselves."""
    totals = _parties(_presidential(votes)).groupBy(F.col("descripcion").alias("partido")).agg(
        total("nvotos").alias("nvotos")
    )
    best = top(totals, [F.col("nvotos").desc(), F.col("partido").asc()], k)
    whole = best.select(F.sum("nvotos").alias("s"))
    return best.withColumn(
        "pct_top10", F.round(F.try_divide(F.col("nvotos") * F.lit(100.0), whole.scalar()), 2)
    )


def special_rows_ranking(votes: DataFrame) -> DataFrame:
    return (
        _presidential(votes).filter("es_especial").groupBy(F.col("descripcion").alias("partido"))
        .agg(total("nvotos").alias("nvotos"))
        .orderBy(F.col("nvotos").desc(), "partido")
    )


def party_totals_by_district(votes: DataFrame, header: DataFrame,
                             election: int = c.ELECTION_DEPUTIES) -> DataFrame:
    """Votes per electoral district and party in one election."""
    chosen = F.col("idEleccion") == election
    return (
        _parties(votes).filter(chosen)
        .join(header.filter(chosen).select("idActa", "idDistritoElectoral"), "idActa", "inner")
        .groupBy("idDistritoElectoral", "nagrupacionPolitica", "descripcion")
        .agg(total("nvotos").alias("total_votos"))
    )


def district_winners(votes: DataFrame, header: DataFrame,
                     election: int = c.ELECTION_DEPUTIES) -> DataFrame:
    totals = party_totals_by_district(votes, header, election)
    return winners(totals, ["idDistritoElectoral"], "total_votos", "descripcion")


def top_by_scope(votes: DataFrame, header: DataFrame, k: int = 5) -> DataFrame:
    """Strongest presidential parties at home and abroad."""
    totals = (
        _parties(_presidential(votes))
        .join(header.select("idActa", "idAmbitoGeografico"), "idActa", "inner")
        .groupBy("idAmbitoGeografico", F.col("descripcion").alias("partido"))
        .agg(total("nvotos").alias("nvotos"))
    )
    return top_per_group(totals, ["idAmbitoGeografico"],
                         [F.col("nvotos").desc(), F.col("partido").asc()], k)


# --- turnout ------------------------------------------------------------------


def turnout_by_department(header: DataFrame) -> DataFrame:
    """Turnout of counted presidential actas per department, highest first."""
    return (
        _counted(_presidential(header))
        .groupBy(F.substring("ubigeoDistrito", 1, 2).alias("depto_code"))
        .agg(
            total("totalElectoresHabiles").alias("hab"),
            total("totalVotosEmitidos").alias("emit"),
            F.count(F.lit(1)).alias("n_actas"),
        )
        .withColumn("pct_participacion", _pct("emit", "hab"))
        .orderBy(F.col("pct_participacion").desc_nulls_first(), "depto_code")
    )


def turnout_by_district(header: DataFrame) -> DataFrame:
    """Turnout per electoral district, rounded, highest first."""
    return (
        _counted(_presidential(header)).groupBy("idDistritoElectoral")
        .agg(total("totalElectoresHabiles").alias("habiles"),
             total("totalVotosEmitidos").alias("emitidos"))
        .withColumn("participacion_pct", _pct("emitidos", "habiles", 2))
        .orderBy(F.col("participacion_pct").desc_nulls_first(), "idDistritoElectoral")
    )


def turnout_against_roll(header: DataFrame, roll: DataFrame) -> DataFrame:
    """Per place at home: turnout against the voter roll and the stations' own roll."""
    places = _counted(_presidential(header)).groupBy("ubigeoDistrito").agg(
        total("totalElectoresHabiles").alias("habiles_mesas"),
        total("totalVotosEmitidos").alias("emitidos"),
    )
    home = roll.filter(F.col("residencia") == "Nacional").select(
        F.col("ubigeo_reniec").alias("ubigeoDistrito"), "total_electores"
    )
    return places.join(home, "ubigeoDistrito", "inner").withColumns({
        "participacion_vs_padron_pct": _pct("emitidos", "total_electores", 2),
        "participacion_vs_habiles_pct": _pct("emitidos", "habiles_mesas", 2),
    })


def highest_turnout(header: DataFrame, roll: DataFrame, k: int = 10) -> DataFrame:
    return top(turnout_against_roll(header, roll),
               [F.col("participacion_vs_padron_pct").desc(), F.col("ubigeoDistrito").asc()], k)


def lowest_turnout(header: DataFrame, roll: DataFrame, k: int = 10) -> DataFrame:
    return top(turnout_against_roll(header, roll),
               [F.col("participacion_vs_habiles_pct").asc(), F.col("ubigeoDistrito").asc()], k)


# --- abroad -------------------------------------------------------------------


def _abroad(header: DataFrame) -> DataFrame:
    return header.filter(F.col("idAmbitoGeografico") == c.SCOPE_ABROAD)


def abroad_totals(header: DataFrame) -> DataFrame:
    return _abroad(header).agg(
        distinct_values("codigoMesa").alias("mesas"), F.count(F.lit(1)).alias("actas")
    )


def abroad_cities(header: DataFrame, k: int = 10) -> DataFrame:
    counts = _abroad(header).groupBy("ubigeoDistrito", "ubigeoNivel03").agg(
        F.count(F.lit(1)).alias("n"))
    return top(counts, [F.col("n").desc(), F.col("ubigeoDistrito").asc(),
                        F.col("ubigeoNivel03").asc()], k)


def abroad_parties(header: DataFrame, votes: DataFrame, k: int = 5) -> DataFrame:
    """Strongest presidential parties abroad; the actas' ids never leave the cluster."""
    rows = only_in(_parties(_presidential(votes)), _presidential(_abroad(header)), "idActa")
    totals = rows.groupBy("descripcion").agg(total("nvotos").alias("total"))
    return top(totals, [F.col("total").desc(), F.col("descripcion").asc()], k)


def abroad_states(header: DataFrame) -> DataFrame:
    counts = _abroad(header).groupBy("codigoEstadoActa").agg(F.count(F.lit(1)).alias("actas"))
    return share_of_all(counts, "actas", "pct").withColumn("pct", F.round("pct", 2)).orderBy(
        F.col("actas").desc(), "codigoEstadoActa")


def abroad_by_election(header: DataFrame) -> DataFrame:
    return _abroad(header).groupBy("idEleccion").agg(F.count(F.lit(1)).alias("actas"))


def abroad_regions(header: DataFrame, k: int = 10) -> DataFrame:
    """Regions abroad with most voters on the stations' rolls."""
    regions = _presidential(_abroad(header)).groupBy("ubigeoDepartamento").agg(
        total("totalElectoresHabiles").alias("habiles"), F.count(F.lit(1)).alias("mesas"))
    return top(regions, [F.col("habiles").desc(), F.col("ubigeoDepartamento").asc()], k)


def roll_by_country(roll: DataFrame, k: int = 10) -> DataFrame:
    rows = roll.filter(F.col("residencia") == "Extranjero").select(
        "pais_nombre", "total_electores", "hombres", "mujeres")
    return top(rows, [F.col("total_electores").desc(), F.col("pais_nombre").asc()], k)


def installation_rate(header: DataFrame) -> DataFrame:
    """Stations abroad, those with a counted presidential acta, and their share.

    Both counts come from one pass: stations are first reduced to one row each.
    """
    stations = _presidential(_abroad(header)).groupBy("idMesaRef").agg(
        F.max(F.when(F.col("codigoEstadoActa") == c.STATE_COUNTED, F.lit(1)).otherwise(F.lit(0)))
        .alias("counted"))
    return stations.agg(
        F.count(F.lit(1)).alias("mesas"), total("counted").alias("mesas_c")
    ).withColumn("tasa_pct", _pct("mesas_c", "mesas", 2))


# --- coverage and progress ----------------------------------------------------


def coverage(tables: Mapping[str, DataFrame], universe: int = c.ACTA_UNIVERSE) -> DataFrame:
    """Per table: rows, distinct actas and their share of the expected universe."""
    parts = []
    for name, df in tables.items():
        per_acta = df.groupBy("idActa").agg(F.count(F.lit(1)).alias("n"))
        parts.append(per_acta.agg(
            total("n").alias("filas"), F.count(F.lit(1)).alias("actas")
        ).select(F.lit(name).alias("tabla"), "filas", "actas"))
    return union_all(parts).withColumn(
        "cobertura_pct", F.col("actas") * F.lit(100.0) / F.lit(universe))


def files_on_disk(manifest: DataFrame, suffix: str = ".pdf") -> DataFrame:
    return manifest.filter(F.col("rel_path").endswith(suffix)).agg(
        F.count(F.lit(1)).alias("files_on_disk"))


def actas_by_electoral_district(header: DataFrame) -> DataFrame:
    """Presidential actas per electoral district and the length of their bar."""
    counts = _presidential(header).groupBy("idDistritoElectoral").agg(
        F.count(F.lit(1)).alias("n"))
    largest = counts.select(F.max("n").alias("m"))
    return counts.withColumn(
        "bar_pct", clipped_pct(F.col("n") * F.lit(100.0) / largest.scalar(), 1)
    ).orderBy(F.col("idDistritoElectoral").asc_nulls_first())


def progress_series(totals: DataFrame, n: int = 48, shown: int | None = None) -> DataFrame:
    """The newest presidential snapshots in time order."""
    rows = _presidential(totals).select(
        "snapshot_ts_ms", "contabilizadas", "totalActas",
        F.col("actasContabilizadas").alias("pct_contabilizadas"))
    return last_snapshots(rows, n if shown is None else min(n, shown)).withColumn(
        "iso", lima_iso("snapshot_ts_ms"))
