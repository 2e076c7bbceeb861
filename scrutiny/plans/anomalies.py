"""Anomaly detection: seven rules, ten columns per finding.

The five rules about a single acta are conditions over the header and two figures of
its votes. Alone, each is a filter; together they are one pass over the header with one
join, whatever the number of rules.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutiny import contracts as c
from scrutiny.functions.aggregates import total
from scrutiny.functions.scalars import message
from scrutiny.operators.filters import at_least_severity
from scrutiny.operators.ranking import top
from scrutiny.operators.unions import union_all
from scrutiny.sinks.tables import grouped_summary


def _finding(kind: str, severity: str, observed: Column, expected: Column, text: Column,
             acta: Column | None = None, election: Column | None = None,
             state: Column | None = None, district: Column | None = None) -> Column:
    def column(given: Column | None, name: str) -> Column:
        return (F.col(name) if given is None else given).alias(name)

    return F.struct(
        F.lit(kind).alias("tipo"),
        F.lit(severity).alias("severidad"),
        column(acta, "idActa"),
        column(election, "idEleccion"),
        column(state, "codigoEstadoActa"),
        F.col("ubigeoDistrito"),
        column(district, "idDistritoElectoral"),
        observed.cast("double").alias("valor_observado"),
        expected.cast("double").alias("valor_esperado_max"),
        text.alias("mensaje"),
    )


@dataclass(frozen=True)
class ActaRule:
    """A condition over one header row (with its vote figures) and the finding it makes."""

    condition: Column
    finding: Column
    needs_votes: bool = False


def acta_rules() -> dict[str, ActaRule]:
    """The five single-acta rules, by name."""
    emitted, valid = F.col("totalVotosEmitidos"), F.col("totalVotosValidos")
    roll, attended = F.col("totalElectoresHabiles"), F.col("totalAsistentes")
    turnout = F.col("porcentajeParticipacionCiudadana")
    counted = F.col("codigoEstadoActa") == c.STATE_COUNTED
    summed, largest = F.col("suma_nvotos"), F.col("max_nvotos_partido")
    ratio = F.try_divide(largest, valid)
    # Message texts are fixed values.
    return {
        "validos_gt_emitidos": ActaRule(
            valid > emitted,
            _finding("validos_gt_emitidos", "CRITICAL", valid, emitted,
                     message("validos=", valid, " > emitidos=", emitted, " (imposible)")),
        ),
        "asistentes_gt_habiles": ActaRule(
            attended > roll,
            _finding("asistentes_gt_habiles", "CRITICAL", attended, roll,
                     message("asistentes=", attended, " > hábiles=", roll, " (imposible)")),
        ),
        "participacion_gt_100": ActaRule(
            turnout > 100.0,
            _finding("participacion_gt_100", "CRITICAL", turnout, F.lit(100.0),
                     message("participación=", turnout, "% > 100%")),
        ),
        "suma_votos_mismatch": ActaRule(
            counted & (F.abs(summed - emitted) > c.SUM_TOLERANCE),
            _finding("suma_votos_mismatch", "HIGH", summed, emitted,
                     message("suma(nvotos)=", summed, " ≠ emitidos=", emitted,
                             f" (delta > {c.SUM_TOLERANCE})")),
            needs_votes=True,
        ),
        "concentracion_extrema": ActaRule(
            counted & (valid > 0) & (ratio >= c.CONCENTRATION_RATIO),
            _finding("concentracion_extrema", "MEDIUM", ratio, F.lit(c.CONCENTRATION_RATIO),
                     message("1 partido tomó ", F.round(ratio * 100, 1), "% de válidos (>= ",
                             f"{int(c.CONCENTRATION_RATIO * 100)}", "%)")),
            needs_votes=True,
        ),
    }


def vote_figures(votes: DataFrame) -> DataFrame:
    """Per acta: all votes, and the votes of its strongest party.

    The party figure is null, not zero, for an acta that has special rows only.
    """
    return votes.groupBy("idActa").agg(
        total("nvotos").alias("suma_nvotos"),
        F.max(F.when(~F.col("es_especial"), F.col("nvotos"))).alias("max_nvotos_partido"),
    )


def detect(name: str, header: DataFrame, votes: DataFrame | None = None) -> DataFrame:
    """Findings of one single-acta rule."""
    rule = acta_rules()[name]
    if rule.needs_votes:
        if votes is None:
            raise ValueError(f"rule {name} needs the votes")
        header = header.join(vote_figures(votes), "idActa", "inner")
    return header.filter(rule.condition).select(F.inline(F.array(rule.finding)))


def detect_acta_rules(header: DataFrame, votes: DataFrame) -> DataFrame:
    """Findings of all five single-acta rules in one pass."""
    candidates = [F.when(r.condition, r.finding) for r in acta_rules().values()]
    joined = header.join(vote_figures(votes), "idActa", "left")
    return joined.select(F.inline(F.array_compact(F.array(*candidates))))


def detect_turnout_outliers(header: DataFrame) -> DataFrame:
    """Turnout more than three standard deviations off its district and election.

    The statistics are an aggregate joined back, not a window: a window would sort a
    whole district (which may hold a third of all actas) in one task.
    """
    pct = F.col("porcentajeParticipacionCiudadana")
    base = header.filter((pct > 0) & (pct <= 100))
    keys = ["idDistritoElectoral", "idEleccion"]
    stats = (
        base.groupBy(*keys)
        .agg(F.avg(pct).alias("mean_part"), F.stddev_samp(pct).alias("std_part"))
        .filter(F.col("std_part") > 0)
    )
    z = (pct - F.col("mean_part")) / F.col("std_part")
    return (
        base.join(stats, keys, "inner")
        .withColumn("z_score", z)
        .filter(F.abs("z_score") > c.OUTLIER_Z)
        .select(F.inline(F.array(_finding(
            "participacion_outlier_distrito", "MEDIUM", pct, F.col("mean_part"),
            message("participación=", F.round(pct, 1), "% vs media DE=",
                    F.round("mean_part", 1), "% (z=", F.round("z_score", 2), ")"),
        ))))
    )


def detect_votes_beyond_roll(header: DataFrame, roll: DataFrame) -> DataFrame:
    """Districts at home whose presidential votes exceed the voter roll by over 5 %."""
    per_district = (
        header.filter(
            (F.col("idEleccion") == c.ELECTION_PRESIDENT)
            & (F.col("codigoEstadoActa") == c.STATE_COUNTED)
            & (F.col("idAmbitoGeografico") == c.SCOPE_HOME)
        )
        .groupBy("ubigeoDistrito").agg(total("totalVotosEmitidos").alias("emitidos_distrito"))
    )
    home = roll.filter(F.col("residencia") == "Nacional").select(
        F.col("ubigeo_reniec").alias("ubigeoDistrito"), "total_electores"
    )
    factor = 1 + c.ROLL_MARGIN
    limit = F.col("total_electores") * F.lit(factor)
    return (
        per_district.join(home, "ubigeoDistrito", "inner")
        .filter(F.col("emitidos_distrito") > limit)
        .select(F.inline(F.array(_finding(
            "emitidos_gt_padron_reniec", "HIGH", F.col("emitidos_distrito"), limit,
            message("emitidos=", F.col("emitidos_distrito"), f" > padrón×{factor} = ",
                    limit.cast("bigint"), " (padrón RENIEC Q1 2026)"),
            acta=F.lit(None).cast("bigint"),
            election=F.lit(c.ELECTION_PRESIDENT).cast("bigint"),
            state=F.lit(c.STATE_COUNTED), district=F.lit(None).cast("bigint"),
        ))))
    )


def run_all(header: DataFrame, votes: DataFrame, roll: DataFrame | None = None,
            election: int | None = None, min_severity: str = "MEDIUM") -> DataFrame:
    """All findings of at least a severity, in order.

    The roll rule runs only with a roll, for all elections or the presidential one, and
    if the header knows its scope.
    """
    if election is not None:
        header = header.filter(F.col("idEleccion") == election)
        votes = votes.filter(F.col("idEleccion") == election)
    parts = [detect_acta_rules(header, votes), detect_turnout_outliers(header)]
    if (roll is not None and election in (None, c.ELECTION_PRESIDENT)
            and "idAmbitoGeografico" in header.columns):
        parts.append(detect_votes_beyond_roll(header, roll))
    return at_least_severity(union_all(parts), min_severity).orderBy(
        "severidad", "tipo", F.col("idEleccion").asc_nulls_first(),
        F.col("ubigeoDistrito").asc_nulls_first(),
    )


# --- summaries ----------------------------------------------------------------


def by_severity_and_type(findings: DataFrame) -> DataFrame:
    return findings.groupBy("severidad", "tipo").agg(F.count(F.lit(1)).alias("n")).orderBy(
        "severidad", F.col("n").desc(), "tipo"
    )


def by_election(findings: DataFrame) -> DataFrame:
    return findings.groupBy("idEleccion").agg(F.count(F.lit(1)).alias("n")).orderBy("idEleccion")


def first_critical(findings: DataFrame, k: int = 10) -> DataFrame:
    order: Sequence[Column] = [F.col(x).asc_nulls_first() for x in
                               ("tipo", "idEleccion", "ubigeoDistrito", "idActa")]
    return top(findings.filter(F.col("severidad") == "CRITICAL"), order, k)


def summary(findings: DataFrame, **filters: object) -> DataFrame:
    """Totals, per severity, per type, and the filters used, as ``metric, key, n``."""
    return grouped_summary(findings, ["severidad", "tipo"], **filters)


def by_district(findings: DataFrame, k: int = 10) -> DataFrame:
    counts = findings.filter(F.col("idDistritoElectoral").isNotNull()).groupBy(
        "idDistritoElectoral").agg(F.count(F.lit(1)).alias("hallazgos"))
    return top(counts, [F.col("hallazgos").desc(), F.col("idDistritoElectoral").asc()], k)


def largest_of_type(findings: DataFrame, kind: str, k: int = 10) -> DataFrame:
    """Findings of a type with the largest observed value."""
    rows = findings.filter(F.col("tipo") == kind).select(
        "idActa", "idEleccion", "ubigeoDistrito", "valor_observado", "mensaje"
    )
    return top(rows, [F.col("valor_observado").desc(), F.col("idActa").asc()], k)


def type_by_scope(findings: DataFrame, header: DataFrame, kind: str) -> DataFrame:
    """Findings of a type at home and abroad."""
    return (
        findings.filter(F.col("tipo") == kind).select("idActa")
        .join(header.select("idActa", "idAmbitoGeografico"), "idActa", "inner")
        .groupBy("idAmbitoGeografico").agg(F.count(F.lit(1)).alias(kind))
    )
