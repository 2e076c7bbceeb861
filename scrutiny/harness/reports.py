"""Queries over the reports: results, turnout, maps, coverage, exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from scrutiny.harness.jobs import _TIDY
from scrutiny.harness.registry import query
from scrutiny.operators import filters
from scrutiny.plans import analytics, curate, export, ingest, maps
from scrutiny.sources import documents

# --- executive figures and parties --------------------------------------------


@query("executive_totals", "R1 A1 A2", """
SELECT count(*) AS actas, count(DISTINCT codigoMesa) AS mesas,
  count(DISTINCT idEleccion) AS elecciones FROM {cab0}""")
def _(t):
    return analytics.executive_totals(t("cab0"))


@query("states_with_share", "R1 R20 A11", """
SELECT codigoEstadoActa, n, n * 100.0::DOUBLE / sum(n) OVER () AS pct FROM (
  SELECT codigoEstadoActa, count(*) AS n FROM {cab0} GROUP BY codigoEstadoActa) x""")
def _(t):
    return analytics.states_with_share(t("cab0"))


@query("actas_by_election", "R1 R20 A1", """
SELECT idEleccion, count(*) AS n FROM {cab0} GROUP BY idEleccion""")
def _(t):
    return analytics.actas_by_election(t("cab0"))


@query("roll_by_scope", "R20 A3", """
SELECT idAmbitoGeografico, count(*) AS actas,
  CAST(coalesce(sum(totalElectoresHabiles), 0) AS BIGINT) AS electores
FROM {cab} WHERE idEleccion = 10 GROUP BY idAmbitoGeografico""")
def _(t):
    return analytics.roll_by_scope(t("cab"))


_PARTIES = """SELECT idEleccion, nagrupacionPolitica, descripcion, v AS total_votos,
  CAST(sum(v) OVER (PARTITION BY idEleccion) AS BIGINT) AS sum_eleccion,
  v * 100.0::DOUBLE / sum(v) OVER (PARTITION BY idEleccion) AS pct
FROM (SELECT idEleccion, nagrupacionPolitica, descripcion, CAST(sum(nvotos) AS BIGINT) AS v
  FROM {votos} WHERE NOT es_especial GROUP BY ALL) x"""


@query("party_totals_share", "R2 A3 A10", _PARTIES)
def _(t):
    return analytics.party_totals(t("votos"))


@query("top10_per_election", "R2 O4 A10", f"""
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY idEleccion
  ORDER BY total_votos DESC, descripcion, nagrupacionPolitica) AS INTEGER) AS rank
FROM ({_PARTIES}) p) q WHERE rank <= 10""")
def _(t):
    return analytics.top_parties(t("votos"))


@query("national_top10", "R16 O3 A10", """
SELECT partido, nvotos, round(nvotos * 100.0::DOUBLE / sum(nvotos) OVER (), 2) AS pct_top10
FROM (SELECT descripcion AS partido, CAST(sum(nvotos) AS BIGINT) AS nvotos FROM {votos}
  WHERE idEleccion = 10 AND NOT es_especial GROUP BY descripcion
  ORDER BY nvotos DESC, partido LIMIT 10) x""")
def _(t):
    return analytics.national_top(t("votos"))


@query("special_rows_ranking", "R16 A3 O1", """
SELECT descripcion AS partido, CAST(sum(nvotos) AS BIGINT) AS nvotos FROM {votos}
WHERE idEleccion = 10 AND es_especial GROUP BY descripcion""")
def _(t):
    return analytics.special_rows_ranking(t("votos"))


def _by_district(election: int) -> str:
    return f"""SELECT c.idDistritoElectoral, v.nagrupacionPolitica, v.descripcion,
  CAST(sum(v.nvotos) AS BIGINT) AS total_votos FROM {{votos}} v JOIN {{cab0}} c
  ON v.idActa = c.idActa WHERE NOT v.es_especial AND v.idEleccion = {election}
  AND c.idEleccion = {election} GROUP BY ALL"""


def _district_winner(election: int) -> str:
    return f"""SELECT idDistritoElectoral, nagrupacionPolitica, descripcion, total_votos FROM (
  SELECT *, row_number() OVER (PARTITION BY idDistritoElectoral
    ORDER BY total_votos DESC, descripcion) AS rn FROM ({_by_district(election)}) x) y
  WHERE rn = 1"""


@query("parties_by_electoral_district", "R4 J4 A3", _by_district(13))
def _(t):
    return analytics.party_totals_by_district(t("votos"), t("cab0"))


@query("deputies_winner_by_district", "R4 W2", _district_winner(13))
def _(t):
    return analytics.district_winners(t("votos"), t("cab0"))


@query("presidential_winner_by_district", "R17 W2", _district_winner(10))
def _(t):
    return analytics.district_winners(t("votos"), t("cab0"), 10)


@query("top5_by_scope", "R17 O4", """
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY idAmbitoGeografico
    ORDER BY nvotos DESC, partido) AS INTEGER) AS rank
  FROM (SELECT c.idAmbitoGeografico, v.descripcion AS partido, CAST(sum(v.nvotos) AS BIGINT)
      AS nvotos FROM {votos} v JOIN {cab0} c ON v.idActa = c.idActa
    WHERE v.idEleccion = 10 AND NOT v.es_especial GROUP BY ALL) x) y WHERE rank <= 5""")
def _(t):
    return analytics.top_by_scope(t("votos"), t("cab0"))


# --- turnout ------------------------------------------------------------------


@query("turnout_by_department", "R3 F3 A3 O1", """
SELECT depto_code, hab, emit, n_actas, emit * 100.0::DOUBLE / nullif(hab, 0) AS pct_participacion
FROM (SELECT substr(ubigeoDistrito, 1, 2) AS depto_code,
    CAST(coalesce(sum(totalElectoresHabiles), 0) AS BIGINT) AS hab,
    CAST(coalesce(sum(totalVotosEmitidos), 0) AS BIGINT) AS emit, count(*) AS n_actas
  FROM {cab} WHERE idEleccion = 10 AND codigoEstadoActa = 'C' GROUP BY depto_code) x""")
def _(t):
    return analytics.turnout_by_department(t("cab"))


@query("turnout_by_electoral_district", "R14 A3 O1", """
SELECT idDistritoElectoral, habiles, emitidos,
  round(emitidos * 100.0::DOUBLE / nullif(habiles, 0), 2) AS participacion_pct
FROM (SELECT idDistritoElectoral,
    CAST(coalesce(sum(totalElectoresHabiles), 0) AS BIGINT) AS habiles,
    CAST(coalesce(sum(totalVotosEmitidos), 0) AS BIGINT) AS emitidos
  FROM {cab} WHERE idEleccion = 10 AND codigoEstadoActa = 'C' GROUP BY idDistritoElectoral) x""")
def _(t):
    return analytics.turnout_by_district(t("cab"))


_AGAINST = """SELECT ubigeoDistrito, habiles_mesas, emitidos, total_electores,
  round(emitidos * 100.0::DOUBLE / nullif(total_electores, 0), 2) AS participacion_vs_padron_pct,
  round(emitidos * 100.0::DOUBLE / nullif(habiles_mesas, 0), 2) AS participacion_vs_habiles_pct
FROM (SELECT ubigeoDistrito, CAST(coalesce(sum(totalElectoresHabiles), 0) AS BIGINT)
    AS habiles_mesas, CAST(coalesce(sum(totalVotosEmitidos), 0) AS BIGINT) AS emitidos
  FROM {cab} WHERE idEleccion = 10 AND codigoEstadoActa = 'C' GROUP BY ubigeoDistrito) x
JOIN {padron} p ON x.ubigeoDistrito = p.ubigeo_reniec WHERE p.residencia = 'Nacional'"""


@query("turnout_against_roll", "R15 J7", _AGAINST)
def _(t):
    return analytics.turnout_against_roll(t("cab"), t("padron"))


@query("highest_turnout", "R15 O3", f"""
{_AGAINST} ORDER BY participacion_vs_padron_pct DESC NULLS LAST, ubigeoDistrito LIMIT 10""")
def _(t):
    return analytics.highest_turnout(t("cab"), t("padron"))


@query("lowest_turnout", "R15 O3", f"""
{_AGAINST} ORDER BY participacion_vs_habiles_pct NULLS FIRST, ubigeoDistrito LIMIT 10""")
def _(t):
    return analytics.lowest_turnout(t("cab"), t("padron"))


# --- abroad -------------------------------------------------------------------


@query("abroad_totals", "R5 A2", """
SELECT count(DISTINCT codigoMesa) AS mesas, count(*) AS actas FROM {cab0}
WHERE idAmbitoGeografico = 2""")
def _(t):
    return analytics.abroad_totals(t("cab0"))


@query("abroad_cities", "R5 O3", """
SELECT ubigeoDistrito, ubigeoNivel03, count(*) AS n FROM {cab0} WHERE idAmbitoGeografico = 2
GROUP BY ALL ORDER BY n DESC, ubigeoDistrito, ubigeoNivel03 LIMIT 10""")
def _(t):
    return analytics.abroad_cities(t("cab0"))


@query("abroad_parties", "R5 J9 O3", """
SELECT descripcion, CAST(sum(nvotos) AS BIGINT) AS total FROM {votos}
WHERE idEleccion = 10 AND NOT es_especial AND idActa IN (
  SELECT idActa FROM {cab0} WHERE idAmbitoGeografico = 2 AND idEleccion = 10)
GROUP BY descripcion ORDER BY total DESC, descripcion LIMIT 5""")
def _(t):
    return analytics.abroad_parties(t("cab0"), t("votos"))


@query("abroad_states", "R18 A11", """
SELECT codigoEstadoActa, actas, round(actas * 100.0::DOUBLE / sum(actas) OVER (), 2) AS pct FROM (
  SELECT codigoEstadoActa, count(*) AS actas FROM {cab0} WHERE idAmbitoGeografico = 2
  GROUP BY codigoEstadoActa) x""")
def _(t):
    return analytics.abroad_states(t("cab0"))


@query("abroad_by_election", "R18 A1", """
SELECT idEleccion, count(*) AS actas FROM {cab0} WHERE idAmbitoGeografico = 2
GROUP BY idEleccion""")
def _(t):
    return analytics.abroad_by_election(t("cab0"))


@query("abroad_regions", "R18 O3", """
SELECT ubigeoDepartamento, CAST(coalesce(sum(totalElectoresHabiles), 0) AS BIGINT) AS habiles,
  count(*) AS mesas FROM {cab} WHERE idAmbitoGeografico = 2 AND idEleccion = 10
GROUP BY ubigeoDepartamento ORDER BY habiles DESC, ubigeoDepartamento LIMIT 10""")
def _(t):
    return analytics.abroad_regions(t("cab"))


@query("roll_by_country", "R18 O3", """
SELECT Pais AS pais_nombre, CAST(sum(Cantidad) AS BIGINT) AS total_electores,
  CAST(coalesce(sum(Cantidad) FILTER (WHERE Sexo = 'Hombre'), 0) AS BIGINT) AS hombres,
  CAST(coalesce(sum(Cantidad) FILTER (WHERE Sexo = 'Mujer'), 0) AS BIGINT) AS mujeres
FROM {padron_base} WHERE Residencia = 'Extranjero' AND Edad >= 18 GROUP BY CodPais, Pais
ORDER BY total_electores DESC, pais_nombre LIMIT 10""")
def _(t):
    from scrutiny.plans.padron import roll_by_place

    return analytics.roll_by_country(roll_by_place(t("padron_base")))


@query("installation_rate", "R18 A2", """
SELECT m AS mesas, k AS mesas_c, round(k * 100.0::DOUBLE / nullif(m, 0), 2) AS tasa_pct FROM (
  SELECT count(DISTINCT idMesaRef) AS m,
    count(DISTINCT CASE WHEN codigoEstadoActa = 'C' THEN idMesaRef END) AS k
  FROM {cab0} WHERE idAmbitoGeografico = 2 AND idEleccion = 10) x""")
def _(t):
    return analytics.installation_rate(t("cab0")).withColumn(
        "mesas_c", F.col("mesas_c").cast("bigint"))


# --- maps ---------------------------------------------------------------------

_PLACE_VOTES = """SELECT level, place, descripcion, CAST(sum(nvotos) AS BIGINT) AS votos FROM (
  SELECT v.descripcion, v.nvotos, unnest(['department', 'province', 'district']) AS level,
    unnest([substr(c.ubigeoDistrito, 1, 2) || '0000', substr(c.ubigeoDistrito, 1, 4) || '00',
      c.ubigeoDistrito]) AS place
  FROM {votos} v JOIN {cab0} c ON v.idActa = c.idActa
  WHERE NOT v.es_especial AND v.idEleccion = 10 AND c.idEleccion = 10
    AND c.idAmbitoGeografico = 1) x GROUP BY level, place, descripcion"""
_PLACE_WINNERS = f"""SELECT level, place, descripcion AS partido, votos, round(votos * 100.0::DOUBLE
  / nullif(total_key, 0), 2) AS pct, total_key FROM (SELECT *,
    CAST(sum(votos) OVER (PARTITION BY level, place) AS BIGINT) AS total_key,
    row_number() OVER (PARTITION BY level, place ORDER BY votos DESC, descripcion) AS rn
  FROM ({_PLACE_VOTES}) p) q WHERE rn = 1"""
_PLACE_TURNOUT = """SELECT level, place, hab, emit, n_actas,
  round(emit * 100.0::DOUBLE / nullif(hab, 0), 2) AS pct FROM (SELECT level, place,
    CAST(coalesce(sum(h), 0) AS BIGINT) AS hab, CAST(coalesce(sum(e), 0) AS BIGINT) AS emit,
    count(*) AS n_actas FROM (SELECT totalElectoresHabiles AS h, totalVotosEmitidos AS e,
      unnest(['department', 'province', 'district']) AS level,
      unnest([substr(ubigeoDistrito, 1, 2) || '0000', substr(ubigeoDistrito, 1, 4) || '00',
        ubigeoDistrito]) AS place FROM {cab}
    WHERE idEleccion = 10 AND codigoEstadoActa = 'C' AND idAmbitoGeografico = 1) x
  GROUP BY level, place) y"""


@query("party_totals_by_place", "R6 A14", _PLACE_VOTES)
def _(t):
    return maps.party_totals_by_place(t("cab0"), t("votos"))


@query("winners_by_place", "R6 A14 A10 W2 F28", _PLACE_WINNERS)
def _(t):
    return maps.winners_by_place(t("cab0"), t("votos"))


@query("turnout_by_place", "R7 A14 F28", _PLACE_TURNOUT)
def _(t):
    return maps.turnout_by_place(t("cab"))


def _collections(t):
    """A feature collection per station row, built in place."""
    return t.sql("""SELECT codigoMesa AS source, 'FeatureCollection' AS type, array(
        named_struct('type', 'Feature', 'id', substr(ubigeoDistrito, 2),
          'geometry', to_json(named_struct('type', 'Point')),
          'properties', map('ID', CASE WHEN idMesa % 3 = 0 THEN ubigeoDistrito END,
            'id', CASE WHEN idMesa % 3 = 1 THEN substr(ubigeoDistrito, 2) END)),
        named_struct('type', 'Feature', 'id', CAST(NULL AS STRING), 'geometry', 'null',
          'properties', map('ID', CASE WHEN idMesa % 4 = 0 THEN '999999' END,
            'id', CAST(NULL AS STRING)))) AS features FROM {mesas}""")


# District ids arrive with six digits or, without their leading zero, with five.
_FEATURES = """SELECT codigoMesa AS source, CASE WHEN idMesa % 3 = 0 THEN ubigeoDistrito
    ELSE '0' || substr(ubigeoDistrito, 2) END AS feature_id FROM {mesas}
  UNION ALL SELECT codigoMesa, CASE WHEN idMesa % 4 = 0 THEN '999999' ELSE '' END FROM {mesas}"""


@query("feature_ids", "F23 S12 F26", _FEATURES)
def _(t):
    features = documents.explode_features(_collections(t))
    return documents.with_feature_id(features, "district").select("source", "feature_id")


@query("feature_count_check", "S12", """
SELECT codigoMesa AS source, CAST(2 AS BIGINT) AS n, false AS passed FROM {mesas}""")
def _(t):
    return documents.feature_count_check(documents.explode_features(_collections(t)))


@query("enriched_features", "R8 J11 F23 F24 S12", f"""
SELECT source, f.feature_id, coalesce(w.partido, 's/d') AS presidencial_partido,
  coalesce(w.votos, 0) AS presidencial_votos, coalesce(w.pct, 0.0) AS presidencial_pct,
  coalesce(p.pct, 0.0) AS participacion_pct, coalesce(p.emit, 0) AS participacion_emit,
  coalesce(p.hab, 0) AS participacion_hab, '#95a5a6' AS color,
  CASE WHEN coalesce(p.pct, 0) >= 80 THEN 'ge_80' WHEN p.pct >= 75 THEN 'ge_75'
    WHEN p.pct >= 70 THEN 'ge_70' WHEN p.pct >= 65 THEN 'ge_65' WHEN p.pct >= 60 THEN 'ge_60'
    WHEN p.pct >= 50 THEN 'ge_50' ELSE 'lt_50' END AS participacion_clase
FROM ({_FEATURES}) f
LEFT JOIN (SELECT * FROM ({_PLACE_WINNERS}) a WHERE level = 'district') w ON f.feature_id = w.place
LEFT JOIN (SELECT * FROM ({_PLACE_TURNOUT}) b WHERE level = 'district') p ON f.feature_id = p.place
WHERE f.feature_id <> ''""")
def _(t):
    features = documents.with_feature_id(
        documents.explode_features(_collections(t)), "district").select("source", "feature_id")
    return maps.enrich_features(
        maps.district_features(features), maps.winners_by_place(t("cab0"), t("votos")),
        maps.turnout_by_place(t("cab")), "district")


# --- coverage and progress ----------------------------------------------------


@query("coverage", "R9 A1 A2", """
SELECT *, actas * 100.0::DOUBLE / 463830 AS cobertura_pct FROM (
  SELECT 'cabecera' AS tabla, count(*) AS filas, count(DISTINCT idActa) AS actas FROM {cab0}
  UNION ALL SELECT 'votos', count(*), count(DISTINCT idActa) FROM {votos}
  UNION ALL SELECT 'archivos', count(*), count(DISTINCT idActa) FROM {archivos}) x""")
def _(t):
    return analytics.coverage({"cabecera": t("cab0"), "votos": t("votos"),
                               "archivos": t("archivos")}).withColumn(
        "filas", F.col("filas").cast("bigint"))


@query("actas_by_electoral_district", "R11 A1", """
SELECT idDistritoElectoral, n, round(n * 100.0::DOUBLE / max(n) OVER (), 1) AS bar_pct FROM (
  SELECT idDistritoElectoral, count(*) AS n FROM {cab0} WHERE idEleccion = 10
  GROUP BY idDistritoElectoral) x""")
def _(t):
    return analytics.actas_by_electoral_district(t("cab0"))


@query("progress_series", "R12 W5 F5", """
SELECT snapshot_ts_ms, contabilizadas, totalActas, actasContabilizadas AS pct_contabilizadas,
  strftime(make_timestamp((snapshot_ts_ms - 18000000) * 1000), '%Y-%m-%dT%H:%M:%S') ||
    CASE WHEN snapshot_ts_ms % 1000 = 0 THEN '' ELSE '.' ||
      lpad(CAST(snapshot_ts_ms % 1000 AS VARCHAR), 3, '0') || '000' END || '-05:00' AS iso
FROM {snapshots} WHERE idEleccion = 10 ORDER BY snapshot_ts_ms DESC LIMIT 20""")
def _(t):
    return analytics.progress_series(t("snapshots"), 48, 20)


@query("run_progress", "R13 S15", """
SELECT run_ts_ms, strftime(make_timestamp((run_ts_ms - 18000000) * 1000), '%Y-%m-%dT%H:%M:%S')
  || '-05:00' AS started_iso, n AS completed, n * 2 AS expected, 50.0::DOUBLE AS pct
FROM (SELECT run_ts_ms, count(*) AS n FROM {votos} GROUP BY run_ts_ms) x""")
def _(t):
    batches = t("votos").groupBy("run_ts_ms", (F.col("idActa") % 10).alias("batch_id")).agg(
        F.count_if("es_especial").alias("empty"), F.count_if(~F.col("es_especial")).alias("ok"))
    runs = t("votos").groupBy("run_ts_ms").agg((F.count(F.lit(1)) * 2).alias("expected"))
    ledger = batches.join(runs, "run_ts_ms").withColumn("failed", F.lit(0).cast("bigint"))
    return ingest.run_progress(ledger)


# --- exports ------------------------------------------------------------------

_LONG = """SELECT v.idActa, c.codigoMesa, v.idEleccion, c.idDistritoElectoral,
  c.idAmbitoGeografico, c.ubigeoDepartamento, c.ubigeoProvincia, v.ubigeoDistrito,
  c.nombreDistrito, c.nombreLocalVotacion, c.codigoEstadoActa, c.totalElectoresHabiles,
  c.totalVotosEmitidos, c.totalVotosValidos, c.totalAsistentes,
  c.porcentajeParticipacionCiudadana, v.descripcion AS partido, v.ccodigo, v.es_especial,
  v.nvotos, v.nporcentajeVotosValidos, v.nporcentajeVotosEmitidos
FROM {votos} v JOIN {cab} c ON v.idActa = c.idActa"""


@query("export_long", "E1 J4 P4 P1", f"""{_LONG}
WHERE v.idEleccion IN (10, 13) AND c.codigoEstadoActa = 'C' AND v.ccodigo IN ('00000003',
  '00000014', '00000038')""")
def _(t):
    chosen = filters.selection(elections=[10, 13], state="C",
                               parties=["00000003", "00000014", "00000038"])
    return export.export_long(t("votos"), t("cab"), chosen)


@query("export_district_summary", "E2 A3 A2 O2", f"""
SELECT idEleccion, idDistritoElectoral, ubigeoDepartamento, ubigeoProvincia, ubigeoDistrito,
  nombreDistrito, partido, ccodigo, es_especial,
  CAST(coalesce(sum(nvotos), 0) AS BIGINT) AS nvotos,
  CAST(coalesce(sum(totalElectoresHabiles), 0) AS BIGINT) AS padron_distrito,
  CAST(coalesce(sum(totalVotosEmitidos), 0) AS BIGINT) AS emitidos_distrito,
  CAST(coalesce(sum(totalVotosValidos), 0) AS BIGINT) AS validos_distrito,
  count(DISTINCT idActa) AS actas
FROM ({_LONG}) l WHERE idAmbitoGeografico = 1 GROUP BY ALL""")
def _(t):
    return export.export_district_summary(
        t("votos"), t("cab"), filters.selection(scope=1)).withColumn(
        "actas", F.col("actas").cast("bigint"))


@query("export_header", "E3 E6 P4", """
SELECT * FROM {cab} WHERE idEleccion = 14 AND codigoEstadoActa = 'E'""")
def _(t):
    return export.export_header(t("cab"), filters.selection(elections=[14], state="E"))


@query("presidential_by_place", "E4 A3 O1", f"""
SELECT idDistritoElectoral, ubigeoDepartamento, ubigeoDistrito, nombreDistrito, partido, ccodigo,
  es_especial, CAST(sum(nvotos) AS BIGINT) AS nvotos FROM ({_TIDY}) t WHERE idEleccion = 10
GROUP BY ALL""")
def _(t):
    return export.presidential_by_place(curate.tidy_votes(t("votos"), t("cab")))


@query("national_totals", "E5 A3 O1", f"""
SELECT idEleccion, partido, ccodigo, es_especial, CAST(sum(nvotos) AS BIGINT) AS nvotos
FROM ({_TIDY}) t GROUP BY ALL""")
def _(t):
    return export.national_totals(curate.tidy_votes(t("votos"), t("cab")))
