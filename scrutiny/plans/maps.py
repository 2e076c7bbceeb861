"""Results and turnout per place at three levels, joined to map features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutiny import contracts as c
from scrutiny.functions.aggregates import total
from scrutiny.functions.scalars import party_color, turnout_class
from scrutiny.operators.ranking import share_of_group, winners
from scrutiny.operators.rollups import by_place, up_from_district

# Fixed value: name shown where nothing is known about a place.
NO_DATA = "s/d"


def _home_presidential() -> Column:
    return (F.col("idEleccion") == c.ELECTION_PRESIDENT) & (
        F.col("idAmbitoGeografico") == c.SCOPE_HOME)


def party_totals_by_place(header: DataFrame, votes: DataFrame) -> DataFrame:
    """Presidential votes at home per level, place and party.

    Votes are added up per district and party once; provinces and departments are made
    from that small result.
    """
    actas = header.filter(_home_presidential()).select(
        "idActa", F.col("ubigeoDistrito").alias("_place"))
    district = (
        votes.filter(~F.col("es_especial") & (F.col("idEleccion") == c.ELECTION_PRESIDENT))
        .select("idActa", "descripcion", "nvotos")
        .join(actas, "idActa", "inner")
        .groupBy("_place", "descripcion").agg(total("nvotos").alias("votos"))
    )
    return up_from_district(district, ["votos"], ["descripcion"], "_place")


def winners_by_place(header: DataFrame, votes: DataFrame) -> DataFrame:
    """Winner of every department, province and district: votes, share, place total."""
    totals = share_of_group(party_totals_by_place(header, votes), ["level", "place"],
                            "votos", "total_key", "pct")
    return winners(totals, ["level", "place"], "votos", "descripcion").select(
        "level", "place", F.col("descripcion").alias("partido"), "votos",
        F.round("pct", 2).alias("pct"), "total_key",
    )


def turnout_by_place(header: DataFrame) -> DataFrame:
    """Turnout of counted presidential actas at home, per level and place."""
    rows = header.filter(_home_presidential() & (F.col("codigoEstadoActa") == c.STATE_COUNTED))
    sums = by_place(rows, {
        "hab": F.col("totalElectoresHabiles"), "emit": F.col("totalVotosEmitidos"),
        "n_actas": F.lit(1),
    })
    return sums.withColumn(
        "pct", F.round(F.try_divide(F.col("emit") * F.lit(100.0), F.col("hab")), 2))


def enrich_features(features: DataFrame, winners_: DataFrame, turnout: DataFrame,
                    level: str) -> DataFrame:
    """Map features with the winner, turnout, class and colour of their place.

    A place nothing is known about gets the neutral name and zeros.
    """
    won = winners_.filter(F.col("level") == level).select(
        F.col("place").alias("feature_id"), "partido", "votos", F.col("pct").alias("_pct"))
    voted = turnout.filter(F.col("level") == level).select(
        F.col("place").alias("feature_id"), "emit", "hab", F.col("pct").alias("_turnout"))

    def or_zero(name: str, alias: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).alias(alias)

    joined = features.join(won, "feature_id", "left").join(voted, "feature_id", "left").select(
        *features.columns,
        F.coalesce("partido", F.lit(NO_DATA)).alias("presidencial_partido"),
        or_zero("votos", "presidencial_votos"), or_zero("_pct", "presidencial_pct"),
        or_zero("_turnout", "participacion_pct"), or_zero("emit", "participacion_emit"),
        or_zero("hab", "participacion_hab"),
    )
    return joined.withColumns({
        "color": party_color("presidencial_partido"),
        "participacion_clase": turnout_class("participacion_pct"),
    })


def district_features(features: DataFrame) -> DataFrame:
    """District maps leave out features that carry no id at all."""
    return features.filter(F.col("feature_id") != "")
