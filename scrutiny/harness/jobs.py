"""Queries over the composed jobs: curation, checks, anomalies, analytics, exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from scrutiny import contracts as c
from scrutiny.harness.registry import query
from scrutiny.plans import anomalies, curate, dq, ingest, padron

# --- curation -----------------------------------------------------------------


@query("header_view", "J3 B02 B06", """
SELECT * FROM {cab}""")
def _(t):
    header = t("cab").drop(*c.ENRICH_COLUMNS)
    return curate.enrich_header(header, t("mesas"))


@query("curate_header", "B02 P3 W1 J1", """
SELECT f.idActa, f.copia, f.idEleccion, f.idMesaRef, f.ubigeoDistrito, f.codigoMesa,
  f.codigoEstadoActa FROM {cab_facts} f
JOIN (SELECT idActa, max(run_ts_ms) AS m FROM {cab_facts} GROUP BY idActa) w
ON f.idActa = w.idActa AND f.run_ts_ms = w.m""")
def _(t):
    return curate.curate_header(t("cab_facts"))


@query("curate_votes_by_header_run", "B03 J1", """
SELECT v.idActa, v.nposicion, v.ccodigo, v.nvotos FROM {votos} v
JOIN (SELECT idActa, max(run_ts_ms) AS m FROM {cab_facts} GROUP BY idActa) w
ON v.idActa = w.idActa AND v.run_ts_ms = w.m""")
def _(t):
    from scrutiny.operators.versions import latest_runs

    votes = t("votos").select("idActa", "nposicion", "ccodigo", "nvotos", "run_ts_ms")
    return curate.curate_child(votes, latest_runs(t("cab_facts")))


@query("curate_auxiliary", "B04", """
SELECT v.idActa, v.nposicion, v.estado FROM (
  SELECT idActa, nposicion, run_ts_ms, 'R' AS estado FROM {votos}) v
JOIN (SELECT idActa, max(run_ts_ms) AS m FROM {cab_facts} GROUP BY idActa) w
ON v.idActa = w.idActa AND v.run_ts_ms = w.m""")
def _(t):
    from scrutiny.operators.versions import latest_runs

    events = t("votos").select(
        "idActa", "nposicion", "run_ts_ms", F.lit("R").alias("estado"))
    return curate.curate_child(events, latest_runs(t("cab_facts")))


@query("curation_coherence", "B05", """
SELECT h AS header_rows, r AS vote_rows, a AS actas_with_votes, h - a AS headers_without_votes
FROM (SELECT (SELECT count(*) FROM {cab0}) AS h, (SELECT count(*) FROM {votos}) AS r,
  (SELECT count(DISTINCT idActa) FROM {votos}) AS a) x""")
def _(t):
    return curate.coherence(t("cab0"), t("votos"))


@query("enrich_header", "B06 J3 P10 F6 X1", """
SELECT idActa, idAmbitoGeografico, ubigeoDepartamento, ubigeoProvincia, nombreDistrito,
  idDistritoElectoral FROM {cab0}""")
def _(t):
    header = t("cab0").select("idActa", "idMesaRef", "ubigeoDistrito", "idDistritoElectoral")
    return curate.enrich_header(header, t("mesas")).drop("idMesaRef", "ubigeoDistrito")


@query("enrichment_nulls", "B07 A9", """
SELECT count(*) AS rows, count(*) FILTER (WHERE idAmbitoGeografico IS NULL) AS scope_nulls,
  count(*) FILTER (WHERE idDistritoElectoral IS NULL) AS district_nulls FROM {cab0}""")
def _(t):
    return curate.enrichment_nulls(t("cab0"))


@query("enrichment_distribution", "B07 A1", """
SELECT idDistritoElectoral, count(*) AS n FROM {cab0} GROUP BY idDistritoElectoral""")
def _(t):
    return curate.enrichment_distribution(t("cab0"))


_TIDY = """SELECT v.idActa, c.codigoMesa, v.idEleccion, c.idAmbitoGeografico,
  c.idDistritoElectoral, c.ubigeoDepartamento, c.ubigeoProvincia, v.ubigeoDistrito,
  c.nombreDistrito, c.codigoEstadoActa, v.descripcion AS partido, v.ccodigo, v.es_especial,
  v.nvotos, c.totalVotosEmitidos, c.totalVotosValidos, c.totalElectoresHabiles
FROM {votos} v JOIN {cab} c ON v.idActa = c.idActa"""


@query("tidy_votes", "B08 J4 P1", _TIDY)
def _(t):
    return curate.tidy_votes(t("votos"), t("cab"))


def _venues(t):
    return t.sql("""SELECT ubigeoDistrito, codigoMesa AS codigoLocalVotacion, idAmbitoGeografico
        FROM {mesas}""")


def _districts(t):
    return t.sql("""SELECT ubigeoDistrito AS ubigeo, max(ubigeoProvincia) AS ubigeoProvincia,
        max(ubigeoDepartamento) AS ubigeoDepartamento, max(nombreDistrito) AS nombre,
        max(idAmbitoGeografico) AS idAmbitoGeografico FROM {mesas} GROUP BY ubigeoDistrito""")


@query("trigger_venues", "A7 B09", """
SELECT ubigeoDistrito, min(codigoMesa) AS "codigoLocalGatillo", idAmbitoGeografico FROM {mesas}
GROUP BY ubigeoDistrito, idAmbitoGeografico""")
def _(t):
    return curate.trigger_venues(_venues(t))


@query("station_universe", "B09 J7 A12", """
SELECT o_custkey AS idMesa, codigoMesa, ubigeoDistrito, ubigeoProvincia, ubigeoDepartamento,
  nombreDistrito, idAmbitoGeografico
FROM (SELECT DISTINCT o_custkey FROM {orders}) o JOIN {mesas} ON o_custkey = idMesa""")
def _(t):
    listing = t.sql("""SELECT o_custkey AS idMesa, codigoMesa, ubigeoDistrito FROM {orders}
        JOIN {mesas} ON o_custkey = idMesa""")
    return curate.station_universe(listing, _venues(t), _districts(t))


# --- tasks, refresh, files ----------------------------------------------------


@query("task_universe", "B10 J10 J12 U4", """
SELECT idMesa * 100000000 + CAST(ubigeoDistrito AS BIGINT) * 100 + e.idEleccion AS idActa,
  idMesa, ubigeoDistrito, e.idEleccion FROM {mesas}
CROSS JOIN (SELECT CAST(unnest([10, 12, 13, 14, 15]) AS BIGINT) AS idEleccion) e
WHERE (('0x' || md5(CAST(idMesa AS VARCHAR)))::UHUGEINT) % 3 = 1
  AND NOT (e.idEleccion = 10 AND idAmbitoGeografico = 2)""")
def _(t):
    from scrutiny.operators.keys import station_tasks

    done = station_tasks(t("mesas").filter(F.col("idAmbitoGeografico") == 2), [10])
    return ingest.task_universe(t("mesas"), shard=(1, 3), done=done)


@query("volatile_tasks", "B11 P12", """
SELECT idActa, idMesaRef, ubigeoDistrito, idEleccion FROM {cab0}
WHERE codigoEstadoActa IN ('P', 'E')""")
def _(t):
    return ingest.volatile_tasks(t("cab0"))


@query("state_distribution", "B11 A11", """
SELECT codigoEstadoActa, n, n * 100.0::DOUBLE / sum(n) OVER () AS pct FROM (
  SELECT codigoEstadoActa, count(*) AS n FROM {cab0} GROUP BY codigoEstadoActa) x""")
def _(t):
    return ingest.state_distribution(t("cab0"))


@query("file_manifest", "B12 J16 A13 F10 F11 U4", """
SELECT archivoId, regexp_full_match(archivoId, '[0-9a-fA-F]{24}') AS valid,
  'pdfs/' || substr(archivoId, 1, 2) || '/' || substr(archivoId, 3, 2) || '/' || archivoId || '.pdf'
  AS path FROM (SELECT DISTINCT archivoId FROM {archivos}
  WHERE archivoId IS NOT NULL AND tipo IN (1, 2, 3)
    AND idActa IN (SELECT idActa FROM {cab0} WHERE codigoEstadoActa IN ('C', 'E'))) x
WHERE (('0x' || md5(archivoId))::UHUGEINT) % 2 = 0""")
def _(t):
    return ingest.file_targets(t("cab0"), t("archivos"), states=("C", "E"), kinds=(1, 2, 3),
                               shard=(0, 2))


@query("shard_sizes", "U4", """
SELECT CAST((('0x' || md5(archivoId))::UHUGEINT) % 5 AS BIGINT) AS shard, count(*) AS n
FROM {archivos} WHERE archivoId IS NOT NULL GROUP BY shard""")
def _(t):
    ids = t("archivos").filter(F.col("archivoId").isNotNull())
    return ingest.shard_sizes(ids, "archivoId", 5)


# --- voter roll ---------------------------------------------------------------

_ROLL_SUMS = """CAST(sum(Cantidad) AS BIGINT) AS total_electores,
  CAST(coalesce(sum(Cantidad) FILTER (WHERE Sexo = 'Hombre'), 0) AS BIGINT) AS hombres,
  CAST(coalesce(sum(Cantidad) FILTER (WHERE Sexo = 'Mujer'), 0) AS BIGINT) AS mujeres,
  CAST(coalesce(sum(Cantidad) FILTER (WHERE TipoDNI = 'DNI electrónico'), 0) AS BIGINT)
    AS dni_electronico,
  CAST(coalesce(sum(Cantidad) FILTER (WHERE TipoDNI = 'DNI convencional'), 0) AS BIGINT)
    AS dni_convencional,
  CAST(coalesce(sum(Cantidad) FILTER (WHERE Edad BETWEEN 18 AND 25), 0) AS BIGINT) AS rango_18_25,
  CAST(coalesce(sum(Cantidad) FILTER (WHERE Edad BETWEEN 26 AND 35), 0) AS BIGINT) AS rango_26_35,
  CAST(coalesce(sum(Cantidad) FILTER (WHERE Edad BETWEEN 36 AND 45), 0) AS BIGINT) AS rango_36_45,
  CAST(coalesce(sum(Cantidad) FILTER (WHERE Edad BETWEEN 46 AND 60), 0) AS BIGINT) AS rango_46_60,
  CAST(coalesce(sum(Cantidad) FILTER (WHERE Edad >= 61), 0) AS BIGINT) AS rango_61_plus"""
_ROLL = f"""SELECT UBIGEO_RENIEC AS ubigeo_reniec, UBIGEO_INEI AS ubigeo_inei,
  'Nacional' AS residencia, '' AS pais_codigo, 'Perú' AS pais_nombre,
  Departamento AS departamento, Provincia AS provincia, Distrito AS distrito, {_ROLL_SUMS}
FROM {{padron_base}} WHERE Edad >= 18 AND Residencia = 'Nacional'
GROUP BY UBIGEO_RENIEC, UBIGEO_INEI, Departamento, Provincia, Distrito
UNION ALL SELECT '', '', 'Extranjero', CodPais, Pais, '', '', Pais, {_ROLL_SUMS}
FROM {{padron_base}} WHERE Edad >= 18 AND Residencia = 'Extranjero' GROUP BY CodPais, Pais"""
_VALIDITY_SUMS = """
  CAST(coalesce(sum(Cantidad) FILTER (WHERE Caducado = 'Vigente'), 0) AS BIGINT) AS vigentes,
  CAST(coalesce(sum(Cantidad) FILTER (WHERE Caducado = 'Caducado'), 0) AS BIGINT) AS caducados"""
_VALIDITY = f"""SELECT UBIGEO_RENIEC AS ubigeo_reniec, '' AS pais_codigo, {_VALIDITY_SUMS}
FROM {{padron_vigencia}} WHERE Edad >= 18 AND Residencia = 'Nacional' GROUP BY UBIGEO_RENIEC
UNION ALL SELECT '', CodPais, {_VALIDITY_SUMS} FROM {{padron_vigencia}}
WHERE Edad >= 18 AND Residencia = 'Extranjero' GROUP BY CodPais"""


@query("age_band_roll", "B20 A15 A4 F7 U1", _ROLL)
def _(t):
    return padron.roll_by_place(t("padron_base"))


@query("validity_by_place", "B21 A15", _VALIDITY)
def _(t):
    return padron.validity_by_place(t("padron_vigencia"))


@query("validity_merge", "B22 J8 B24", f"""
SELECT b.*, coalesce(v.vigentes, 0) AS vigentes, coalesce(v.caducados, 0) AS caducados,
  '2026_03' AS fuente_trimestre
FROM ({_ROLL}) b LEFT JOIN ({_VALIDITY}) v
ON b.ubigeo_reniec = v.ubigeo_reniec AND b.pais_codigo = v.pais_codigo""")
def _(t):
    return padron.build_roll(t("padron_base"), t("padron_vigencia"), "2026_03")


@query("validity_unmatched", "B22 J8", f"""
SELECT count(*) AS unmatched FROM ({_ROLL}) b WHERE NOT EXISTS (SELECT 1 FROM ({_VALIDITY}) v
  WHERE b.ubigeo_reniec = v.ubigeo_reniec AND b.pais_codigo = v.pais_codigo)""")
def _(t):
    return padron.unmatched_places(padron.roll_by_place(t("padron_base")),
                                   padron.validity_by_place(t("padron_vigencia")))


@query("roll_summary", "B23", f"""
SELECT '2026_03' AS trimestre, p + e AS total_electores, p AS total_peru,
  e AS total_extranjero, dp AS distritos_peru, pe AS paises_extranjero, p + e - 1000 AS delta_vs_base
FROM (SELECT
  CAST(coalesce(sum(total_electores) FILTER (WHERE residencia = 'Nacional'), 0) AS BIGINT) AS p,
  CAST(coalesce(sum(total_electores) FILTER (WHERE residencia = 'Extranjero'), 0) AS BIGINT) AS e,
  count(*) FILTER (WHERE residencia = 'Nacional') AS dp,
  count(*) FILTER (WHERE residencia = 'Extranjero') AS pe FROM ({_ROLL}) r) x""")
def _(t):
    return padron.roll_summary(padron.roll_by_place(t("padron_base")), "2026_03", 1000)


# --- data quality -------------------------------------------------------------



def _one(level: int, name: str, passed: str, detail: str, source: str) -> str:
    return f"""SELECT CAST({level} AS BIGINT) AS level, '{name}' AS "check",
  coalesce({passed}, false) AS passed, false AS skipped, {detail} AS detail FROM ({source}) q"""


_D11 = _one(1, "universe_by_election", "u AND mn = mx",
            "'elections=' || e || ' min_rows=' || mn || ' max_rows=' || mx",
            """SELECT count(*) AS e, bool_and(d = n) AS u, min(n) AS mn, max(n) AS mx FROM (
  SELECT count(DISTINCT idActa) AS d, count(*) AS n FROM {cab0} GROUP BY idEleccion) x""")
_D12 = _one(1, "detail_rows_per_acta", "mn = 41 AND mx = 41",
            "'min_rows=' || mn || ' max_rows=' || mx",
            """SELECT min(n) AS mn, max(n) AS mx FROM (SELECT count(*) AS n FROM {votos}
  GROUP BY idActa, idEleccion) x""")
_D13 = _one(1, "accounting_identities", "me = 0 AND mv = 0",
            "'total_con_detalle=' || n || ' mismatch_emit=' || me || ' mismatch_val=' || mv",
            """SELECT count(*) AS n, count(*) FILTER (WHERE st <> totalVotosEmitidos) AS me,
    count(*) FILTER (WHERE sv <> totalVotosValidos) AS mv
  FROM {cab} c JOIN {votos_sum} s ON c.idActa = s.idActa WHERE codigoEstadoActa = 'C'""")
_D14 = _one(1, "ranges_and_signs", "a + b + c + d + e = 0",
            "'emit_neg=' || a || ' val_neg=' || b || ' hab_le_0=' || c || ' emit_gt_hab=' || d"
            " || ' val_gt_emit=' || e",
            """SELECT count(*) FILTER (WHERE totalVotosEmitidos < 0) AS a,
    count(*) FILTER (WHERE totalVotosValidos < 0) AS b,
    count(*) FILTER (WHERE totalElectoresHabiles <= 0) AS c,
    count(*) FILTER (WHERE totalVotosEmitidos > totalElectoresHabiles) AS d,
    count(*) FILTER (WHERE totalVotosValidos > totalVotosEmitidos) AS e
  FROM {cab} WHERE codigoEstadoActa = 'C'""")
_D15 = _one(1, "roll_coherent_by_station", "ok", "'mesas=' || n",
            """SELECT count(*) AS n, bool_and(el = 5 AND h = 1 AND d = 1) AS ok FROM (
  SELECT count(DISTINCT idEleccion) AS el, count(DISTINCT totalElectoresHabiles)
      + max(CASE WHEN totalElectoresHabiles IS NULL THEN 1 ELSE 0 END) AS h,
    count(DISTINCT ubigeoDistrito) AS d FROM {cab} GROUP BY codigoMesa) x""")
_D21 = _one(2, "station_universe", "o = c", "'oficial=' || o || ' curated=' || c",
            """SELECT (SELECT max(mesasInstaladas + mesasPendientes + mesasNoInstaladas)
    FROM {of_mesas}) AS o, (SELECT count(DISTINCT codigoMesa) FROM {cab0}) AS c""")
_LAST = "snapshot_ts_ms = (SELECT max(snapshot_ts_ms) FROM {of_totales})"
_D22 = _one(2, "actas_by_election", "same", "'elections=' || n",
            f"""SELECT count(*) AS n, bool_and(o.totalActas = c.n) AS same FROM {{of_totales}} o
  JOIN (SELECT idEleccion, count(*) AS n FROM {{cab0}} GROUP BY idEleccion) c
  ON o.idEleccion = c.idEleccion WHERE {_LAST}""")
_D23 = _one(2, "presidential_votes_drift", "ep <= 0.1 AND vp <= 0.1",
            "'emit_ofi=' || eo || ' val_ofi=' || vo || ' emit_cur=' || ec || ' val_cur=' || vc"
            " || ' emit_pct=' || round(ep, 3) || ' val_pct=' || round(vp, 3)",
            f"""SELECT *, abs(eo - ec) * 1.0::DOUBLE / greatest(eo, 1) * 100 AS ep,
    abs(vo - vc) * 1.0::DOUBLE / greatest(vo, 1) * 100 AS vp FROM (SELECT
    (SELECT max(totalVotosEmitidos) FROM {{of_totales}} WHERE idEleccion = 10 AND {_LAST}) AS eo,
    (SELECT max(totalVotosValidos) FROM {{of_totales}} WHERE idEleccion = 10 AND {_LAST}) AS vo,
    CAST(sum(totalVotosEmitidos) AS BIGINT) AS ec, CAST(sum(totalVotosValidos) AS BIGINT) AS vc
  FROM {{cab}} WHERE idEleccion = 10 AND codigoEstadoActa = 'C') y""")
_D24 = _one(2, "regions_presidential", "md <= tol AND m = o",
            "'matched=' || m || ' max_delta=' || md || ' tolerance=' || tol",
            """SELECT m, o, md, greatest(10, CAST(floor(t * 0.01::DOUBLE / greatest(m, 1)) AS BIGINT))
    AS tol FROM (SELECT count(*) AS o, count(c.n) AS m,
      coalesce(max(abs(c.n - f.actasContabilizadas)), 0) AS md,
      coalesce(sum(f.actasContabilizadas) FILTER (WHERE c.n IS NOT NULL), 0) AS t
    FROM {of_mapa} f LEFT JOIN (SELECT CAST(substr(ubigeoDistrito, 1, 2) AS BIGINT) * 10000 AS u,
      count(*) AS n FROM {cab0} WHERE idEleccion = 10 AND codigoEstadoActa = 'C' GROUP BY u) c
    ON f.ubigeoNivel01 = c.u WHERE f.idEleccion = 10) x""")
_D25 = _one(2, "parties_presidential", "m = o AND dp <= 0.5",
            "'matched=' || m || '/' || o || ' drift_pct=' || round(dp, 3)",
            """SELECT m, o, CAST(d AS DOUBLE) / greatest(t, 1) * 100 AS dp FROM (
    SELECT count(*) AS o, count(c.v) AS m, sum(abs(c.v - f.totalVotosValidos)) AS d,
      sum(f.totalVotosValidos) FILTER (WHERE c.v IS NOT NULL) AS t
    FROM {of_partidos} f LEFT JOIN (SELECT nagrupacionPolitica AS cod, sum(nvotos) AS v
      FROM {votos} WHERE NOT es_especial AND idEleccion = 10 GROUP BY cod) c
    ON CAST(f.codigoAgrupacionPolitica AS BIGINT) = c.cod WHERE f.idEleccion = 10) x""")
_D31 = _one(3, "scope_matches_district", "a + b + c = 0",
            "'de27_no_ext=' || a || ' ext_no_de27=' || b || ' nulls=' || c",
            """SELECT count(*) FILTER (WHERE idDistritoElectoral = 27 AND idAmbitoGeografico <> 2) AS a,
    count(*) FILTER (WHERE idAmbitoGeografico = 2 AND idDistritoElectoral <> 27) AS b,
    count(*) FILTER (WHERE idDistritoElectoral IS NULL OR idAmbitoGeografico IS NULL) AS c
  FROM {cab0}""")
_D32 = _one(3, "universe_abroad", "n = 2543", "'abroad_actas=' || n",
            """SELECT count(*) AS n FROM {cab0} WHERE idDistritoElectoral = 27
  AND idEleccion = 15""")
_D33 = _one(3, "district_totals_deputies", "md = 0 AND m = o",
            "'matched=' || m || '/' || o || ' max_delta=' || md",
            """SELECT count(*) AS o, count(c.n) AS m, coalesce(max(abs(c.n - f.totalActas)), 0) AS md
  FROM (SELECT * FROM {of_totales_de} WHERE idEleccion = 13 AND snapshot_ts_ms = 1700000900000) f
  LEFT JOIN (SELECT idDistritoElectoral, count(*) AS n FROM {cab0} WHERE idEleccion = 13
    GROUP BY idDistritoElectoral) c ON f.idDistritoElectoral = c.idDistritoElectoral""")
_D34 = _one(3, "district_parties_deputies", "m = o AND mr <= 5.0",
            "'matched=' || m || '/' || o || ' max_delta=' || md || ' max_drift=' || round(mr, 2)",
            """SELECT CAST(sum(o) AS BIGINT) AS o, CAST(sum(m) AS BIGINT) AS m,
    CAST(coalesce(max(md), 0) AS BIGINT) AS md, coalesce(max(r), 0.0::DOUBLE) * 100 AS mr FROM (
    SELECT f.idDistritoElectoral, count(*) AS o, count(c.v) AS m,
      max(abs(c.v - f.totalVotosValidos)) AS md,
      CAST(coalesce(sum(abs(c.v - f.totalVotosValidos)), 0) AS DOUBLE) / CASE
        WHEN coalesce(sum(f.totalVotosValidos) FILTER (WHERE c.v IS NOT NULL), 0) > 0
        THEN sum(f.totalVotosValidos) FILTER (WHERE c.v IS NOT NULL) ELSE 1 END AS r
    FROM {of_partidos_de} f LEFT JOIN (SELECT h.idDistritoElectoral, v.nagrupacionPolitica AS cod,
        sum(v.nvotos) AS v FROM {votos} v JOIN {cab0} h ON v.idActa = h.idActa
      WHERE NOT v.es_especial AND v.idEleccion = 13 GROUP BY ALL) c
    ON f.idDistritoElectoral = c.idDistritoElectoral
      AND CAST(f.codigoAgrupacionPolitica AS BIGINT) = c.cod
    WHERE f.idEleccion = 13 GROUP BY f.idDistritoElectoral) x""")
_RECON = """SELECT coalesce(o.idEleccion, n.idEleccion) AS idEleccion,
  coalesce(o.ubigeoDistrito, n.ubigeoDistrito) AS ubigeoDistrito,
  coalesce(o.ccodigo, n.ccodigo) AS ccodigo, coalesce(n.v, 0) AS cur, coalesce(o.votos, 0) AS ofi,
  abs(coalesce(n.v, 0) - coalesce(o.votos, 0)) AS delta
FROM {of_publicacion} o FULL JOIN (SELECT idEleccion, ubigeoDistrito, ccodigo,
    CAST(sum(nvotos) AS BIGINT) AS v FROM {votos} WHERE NOT es_especial
    AND idActa IN (SELECT idActa FROM {cab0}) GROUP BY ALL) n
ON o.idEleccion = n.idEleccion AND o.ubigeoDistrito = n.ubigeoDistrito AND o.ccodigo = n.ccodigo"""
_D41 = """SELECT CAST(4 AS BIGINT) AS level, 'official_available' AS "check", true AS passed,
  false AS skipped, 'available' AS detail"""
_D42 = _one(4, "reconciliation", "b = 0", "'groups=' || g || ' beyond=' || b || ' max_delta=' || m",
            f"""SELECT count(*) AS g, count(*) FILTER (WHERE delta > 1) AS b,
    coalesce(max(delta), 0) AS m FROM ({_RECON}) y""")


@query("check_universe", "D11 A18 A2", _D11)
def _(t):
    return dq.check_universe(t("cab0"))


@query("check_votes", "D12 D13 A8 A9", f"{_D12} UNION ALL {_D13}")
def _(t):
    return dq.check_votes(t("votos"), t("cab"))


@query("check_ranges", "D14 A9", _D14)
def _(t):
    return dq.check_header(t("cab"), [1])


@query("check_stations", "D15 A2 A18", _D15)
def _(t):
    return dq.check_stations(t("cab"), levels=[1])


@query("check_station_universe", "D21 W4 A2", _D21)
def _(t):
    return dq.check_stations(t("cab"), t("of_mesas"), [2])


@query("check_actas_by_election", "D22 W4 J14", _D22)
def _(t):
    return dq.check_actas_by_election(t("cab0"), t("of_totales"))


@query("check_presidential_votes", "D23 F18", _D23)
def _(t):
    return dq.check_presidential_votes(t("cab"), t("of_totales"))


@query("check_regions", "D24 F3 J14 F20", _D24)
def _(t):
    return dq.check_regions(t("cab0"), t("of_mapa"))


@query("check_parties", "D25 F27 J14 F18", _D25)
def _(t):
    return dq.check_parties(t("votos"), t("of_partidos"))


@query("check_scope_coherence", "D31 D32 A9 D30", f"{_D31} UNION ALL {_D32}")
def _(t):
    return dq.check_header(t("cab"), [3])


@query("check_district_totals", "D33 W6 J14", _D33)
def _(t):
    return dq.check_district_totals(t("cab0"), t("of_totales_de"))


@query("check_district_parties", "D34 W6 J4 A17", _D34)
def _(t):
    return dq.check_district_parties(t("votos"), t("cab0"), t("of_partidos_de"))


@query("reconcile_with_official", "D42", _RECON)
def _(t):
    return dq.reconcile_with_official(t("votos"), t("cab0"), t("of_publicacion"))


@query("check_official", "D41 D42", f"{_D41} UNION ALL {_D42}")
def _(t):
    from scrutiny.operators.unions import union_all

    official = t("of_publicacion")
    return union_all([dq.check_official_available(t("cab0"), official),
                      dq.check_reconciliation(t("votos"), t("cab0"), official)])


#: Header columns that both the checks and the anomaly rules read.
_AUDITED = ("idActa", "idEleccion", "codigoEstadoActa", "ubigeoDistrito", "idDistritoElectoral",
            "idAmbitoGeografico", "totalVotosEmitidos", "totalVotosValidos", "totalElectoresHabiles")

_ALL_CHECKS = [_D11, _D12, _D13, _D15, _D14, _D31, _D32, _D21, _D22, _D23, _D24, _D25, _D33,
               _D34, _D41, _D42]


def _report(t):
    header = t.stored("cab", *_AUDITED, "codigoMesa")
    return dq.report(header, t("votos"), {
        "mesa_totales": t("of_mesas"), "totales": t("of_totales"), "mapa_calor": t("of_mapa"),
        "participantes": t("of_partidos"), "totales_de": t("of_totales_de"),
        "participantes_de": t("of_partidos_de"),
    }, t("of_publicacion"))


@query("dq_report", "D50 D11 D12 D13 D14 D15 D21 D22 D23 D24 D25 D31 D32 D33 D34 D41 D42",
       "SELECT *, CASE WHEN skipped THEN 'SKIP' WHEN passed THEN 'PASS' ELSE 'FAIL' END AS result "
       "FROM (" + " UNION ALL ".join(_ALL_CHECKS) + ") r")
def _(t):
    return _report(t)


@query("dq_report_totals", "D50",
       "SELECT count(*) FILTER (WHERE passed AND NOT skipped) AS pass, "
       "count(*) FILTER (WHERE NOT passed AND NOT skipped) AS fail, "
       "count(*) FILTER (WHERE skipped) AS skip, count(*) AS total "
       "FROM (" + " UNION ALL ".join(_ALL_CHECKS) + ") r")
def _(t):
    return dq.report_totals(_report(t))


_REREAD = """SELECT c.idActa, codigoMesa, ubigeoDistrito, c.idEleccion,
  coalesce(c.estadoActa, '') AS "prev_estadoActa",
  CASE WHEN c.idActa % 5 = 0 THEN 'error' WHEN c.idActa % 3 > 0 THEN 'resolved'
    WHEN c.idActa % 2 = 0 THEN 'mesa_no_instalada' ELSE 'other' END AS bucket,
  CASE WHEN c.idActa % 5 <> 0 THEN 'C' END AS "now_codigoEstadoActa",
  CASE WHEN c.idActa % 5 <> 0 THEN CASE WHEN c.idActa % 2 = 0 THEN 'N' ELSE 'D' END END
    AS "now_estadoActa",
  CASE WHEN c.idActa % 5 = 0 THEN 0 ELSE c.idActa % 3 END AS "n_detalle",
  CAST(NULL AS VARCHAR) AS "descripcionSubEstadoActa"
FROM {cab0} c WHERE codigoEstadoActa = 'C'
  AND NOT EXISTS (SELECT 1 FROM {votos} v WHERE v.idActa = c.idActa)"""


def _reread(t):
    docs = t.sql("""SELECT o_orderkey AS req_acta_id, true AS parsed,
        slice(array(1, 2), 1, CAST(o_orderkey % 3 AS INT)) AS detalle, 'C' AS codigoEstadoActa,
        CASE WHEN o_orderkey % 2 = 0 THEN 'N' ELSE 'D' END AS estadoActa,
        CAST(NULL AS STRING) AS descripcionSubEstadoActa FROM {orders} WHERE o_orderkey % 5 <> 0""")
    return dq.classify_reread(dq.counted_without_detail(t("cab0"), t("votos")), docs)


@query("classify_reread", "D61", _REREAD)
def _(t):
    return _reread(t)


@query("reread_verdict", "D61 A11", f"""
SELECT bucket, n, n * 100.0::DOUBLE / sum(n) OVER () AS pct,
  bucket = 'mesa_no_instalada' AND n * 100.0::DOUBLE / sum(n) OVER () >= 90 AS explained
FROM (SELECT bucket, count(*) AS n FROM ({_REREAD}) r GROUP BY bucket) x""")
def _(t):
    return dq.reread_verdict(_reread(t))


@query("scope_segregation", "D70 U1", """
SELECT 'mesas' AS tabla, count(*) AS total, count(*) FILTER (WHERE idAmbitoGeografico = 1) AS peru,
  count(*) FILTER (WHERE idAmbitoGeografico = 2) AS exterior FROM {mesas}
UNION ALL SELECT 'distritos', count(DISTINCT ubigeoDistrito),
  count(DISTINCT ubigeoDistrito) FILTER (WHERE idAmbitoGeografico = 1),
  count(DISTINCT ubigeoDistrito) FILTER (WHERE idAmbitoGeografico = 2) FROM {mesas}
UNION ALL SELECT 'locales', count(*), NULL, NULL FROM {mesas}""")
def _(t):
    return dq.scope_segregation({"mesas": t("mesas"), "distritos": _districts(t),
                                 "locales": _venues(t).drop("idAmbitoGeografico")})


@query("top_cities_abroad", "D70 O3", """
SELECT ubigeoDistrito, nombreDistrito, count(*) AS n FROM {mesas} WHERE idAmbitoGeografico = 2
GROUP BY ubigeoDistrito, nombreDistrito ORDER BY n DESC, ubigeoDistrito, nombreDistrito LIMIT 5""")
def _(t):
    return dq.top_cities_abroad(t("mesas"))


# --- anomalies ----------------------------------------------------------------

_FIND = """SELECT '{tipo}' AS tipo, '{sev}' AS severidad, c.idActa, c.idEleccion,
  c.codigoEstadoActa, c.ubigeoDistrito, c.idDistritoElectoral, {obs} AS valor_observado,
  {exp} AS valor_esperado_max, {msg} AS mensaje FROM {src}"""


def _find(tipo: str, sev: str, obs: str, exp: str, msg: str, src: str) -> str:
    out = _FIND
    for key, value in (("tipo", tipo), ("sev", sev), ("obs", obs), ("exp", exp), ("msg", msg),
                       ("src", src)):
        out = out.replace("{" + key + "}", value)
    return out


_N1 = _find("validos_gt_emitidos", "CRITICAL", "CAST(totalVotosValidos AS DOUBLE)",
            "CAST(totalVotosEmitidos AS DOUBLE)",
            "'validos=' || totalVotosValidos || ' > emitidos=' || totalVotosEmitidos"
            " || ' (imposible)'",
            "{cab} c WHERE totalVotosValidos > totalVotosEmitidos")
_N2 = _find("asistentes_gt_habiles", "CRITICAL", "CAST(totalAsistentes AS DOUBLE)",
            "CAST(totalElectoresHabiles AS DOUBLE)",
            "'asistentes=' || totalAsistentes || ' > hábiles=' || totalElectoresHabiles"
            " || ' (imposible)'",
            "{cab} c WHERE totalAsistentes > totalElectoresHabiles")
_N3 = _find("participacion_gt_100", "CRITICAL", "porcentajeParticipacionCiudadana",
            "100.0::DOUBLE",
            "'participación=' || porcentajeParticipacionCiudadana || '% > 100%'",
            "{cab} c WHERE porcentajeParticipacionCiudadana > 100")
_N4 = _find("suma_votos_mismatch", "HIGH", "CAST(st AS DOUBLE)",
            "CAST(totalVotosEmitidos AS DOUBLE)",
            "'suma(nvotos)=' || st || ' ≠ emitidos=' || totalVotosEmitidos || ' (delta > 1)'",
            "{cab} c JOIN {votos_sum} s ON c.idActa = s.idActa "
            "WHERE codigoEstadoActa = 'C' AND abs(st - totalVotosEmitidos) > 1")
_N5 = _find("concentracion_extrema", "MEDIUM", "mx / totalVotosValidos", "0.95::DOUBLE",
            "'1 partido tomó ' || round(mx / totalVotosValidos * 100, 1)"
            " || '% de válidos (>= 95%)'",
            "{cab} c JOIN (SELECT idActa, CAST(max(nvotos) AS DOUBLE) AS mx FROM {votos} "
            "WHERE NOT es_especial GROUP BY idActa) m ON c.idActa = m.idActa "
            "WHERE codigoEstadoActa = 'C' AND totalVotosValidos > 0 "
            "AND mx / totalVotosValidos >= 0.95")
_P = "porcentajeParticipacionCiudadana"
_N6 = _find("participacion_outlier_distrito", "MEDIUM", _P, "round(mn, 6)",
            f"'participación=' || round({_P}, 1) || '% vs media DE=' || round(mn, 1)"
            f" || '% (z=' || round(({_P} - mn) / sd, 2) || ')'",
            f"{{cab}} c JOIN (SELECT idDistritoElectoral AS de, idEleccion AS el, avg({_P}) AS mn, "
            f"stddev_samp({_P}) AS sd FROM {{cab}} WHERE {_P} > 0 AND {_P} <= 100 "
            "GROUP BY de, el) g ON c.idDistritoElectoral = g.de AND c.idEleccion = g.el "
            f"WHERE {_P} > 0 AND {_P} <= 100 AND sd > 0 AND abs(({_P} - mn) / sd) > 3")
_N7 = """SELECT 'emitidos_gt_padron_reniec' AS tipo, 'HIGH' AS severidad,
  CAST(NULL AS BIGINT) AS idActa, CAST(10 AS BIGINT) AS idEleccion, 'C' AS codigoEstadoActa,
  ubigeoDistrito, CAST(NULL AS BIGINT) AS idDistritoElectoral, CAST(e AS DOUBLE) AS valor_observado,
  total_electores * 1.05::DOUBLE AS valor_esperado_max,
  'emitidos=' || e || ' > padrón×1.05 = ' || CAST(trunc(total_electores * 1.05::DOUBLE) AS BIGINT)
    || ' (padrón RENIEC Q1 2026)' AS mensaje
FROM (SELECT ubigeoDistrito, CAST(coalesce(sum(totalVotosEmitidos), 0) AS BIGINT) AS e FROM {cab}
  WHERE idEleccion = 10 AND codigoEstadoActa = 'C' AND idAmbitoGeografico = 1
  GROUP BY ubigeoDistrito) d JOIN {padron} p ON d.ubigeoDistrito = p.ubigeo_reniec
WHERE e > total_electores * 1.05::DOUBLE"""


@query("valid_gt_emitted", "N1 P5 F21", _N1)
def _(t):
    return anomalies.detect("validos_gt_emitidos", t("cab"))


@query("attendees_gt_roll", "N2 P5 F21", _N2)
def _(t):
    return anomalies.detect("asistentes_gt_habiles", t("cab"))


@query("turnout_gt_100", "N3 P5 F21", _N3)
def _(t):
    return anomalies.detect("participacion_gt_100", t("cab"))


@query("sum_mismatch", "N4 A3 J5", _N4)
def _(t):
    return anomalies.detect("suma_votos_mismatch", t("cab"), t("votos"))


@query("extreme_concentration", "N5 A5 J5", _N5)
def _(t):
    return anomalies.detect("concentracion_extrema", t("cab"), t("votos"))


def _rounded(findings):
    """Means depend on the order of addition in the last digits: compare six decimals."""
    mean = F.col("tipo") == "participacion_outlier_distrito"
    value = F.col("valor_esperado_max")
    return findings.withColumn("valor_esperado_max",
                               F.when(mean, F.round(value, 6)).otherwise(value))


@query("turnout_outlier", "N6 W7 J6", _N6)
def _(t):
    return _rounded(anomalies.detect_turnout_outliers(t("cab")))


@query("emitted_gt_roll", "N7 A3 J7", _N7)
def _(t):
    return anomalies.detect_votes_beyond_roll(t("cab"), t("padron"))


_ALL_FINDINGS = " UNION ALL ".join([_N1, _N2, _N3, _N4, _N5, _N6, _N7])


def _findings(t, **kwargs):
    header = t.stored("cab", *_AUDITED, "totalAsistentes", "porcentajeParticipacionCiudadana")
    return anomalies.run_all(header, t("votos"), t("padron"), **kwargs)


@query("anomalies_all", "N8 N1 N2 N3 N4 N5 N6 N7 U2 P13 O1", _ALL_FINDINGS)
def _(t):
    return _rounded(_findings(t))


@query("anomalies_high_presidential", "N8 P13",
       f"SELECT * FROM ({' UNION ALL '.join([_N1, _N2, _N3, _N4, _N7])}) f WHERE idEleccion = 10")
def _(t):
    return _findings(t, election=10, min_severity="HIGH")


@query("anomalies_by_severity_and_type", "N9 R19 A1", f"""
SELECT severidad, tipo, count(*) AS n FROM ({_ALL_FINDINGS}) f GROUP BY severidad, tipo""")
def _(t):
    return anomalies.by_severity_and_type(_findings(t))


@query("anomalies_by_election", "N9 A1", f"""
SELECT idEleccion, count(*) AS n FROM ({_ALL_FINDINGS}) f GROUP BY idEleccion""")
def _(t):
    return anomalies.by_election(_findings(t))


@query("anomalies_first_critical", "N9 O3", f"""
SELECT * FROM ({' UNION ALL '.join([_N1, _N2, _N3])}) f
ORDER BY tipo, idEleccion, ubigeoDistrito, idActa LIMIT 10""")
def _(t):
    return anomalies.first_critical(_findings(t))


@query("anomalies_summary", "N9 K8", f"""
SELECT 'total' AS metric, '' AS "key", count(*) AS n FROM ({_ALL_FINDINGS}) f
UNION ALL SELECT 'severidad', severidad, count(*) FROM ({_ALL_FINDINGS}) f GROUP BY severidad
UNION ALL SELECT 'tipo', tipo, count(*) FROM ({_ALL_FINDINGS}) f GROUP BY tipo
UNION ALL SELECT 'param:min_severity', '"MEDIUM"', NULL""")
def _(t):
    return anomalies.summary(_findings(t), min_severity="MEDIUM").withColumn(
        "n", F.col("n").cast("bigint"))


@query("anomalies_by_district", "R19 O3", f"""
SELECT idDistritoElectoral, count(*) AS hallazgos FROM ({_ALL_FINDINGS}) f
WHERE idDistritoElectoral IS NOT NULL GROUP BY idDistritoElectoral
ORDER BY hallazgos DESC, idDistritoElectoral LIMIT 10""")
def _(t):
    return anomalies.by_district(_findings(t))


@query("anomalies_top_outliers", "R19 O3", f"""
SELECT idActa, idEleccion, ubigeoDistrito, valor_observado, mensaje FROM ({_N6}) f
ORDER BY valor_observado DESC, idActa LIMIT 10""")
def _(t):
    return anomalies.largest_of_type(_findings(t), "participacion_outlier_distrito")


@query("anomalies_concentration_by_scope", "R19 J4", f"""
SELECT h.idAmbitoGeografico, count(*) AS concentracion_extrema FROM ({_N5}) f
JOIN {{cab0}} h ON f.idActa = h.idActa GROUP BY h.idAmbitoGeografico""")
def _(t):
    return anomalies.type_by_scope(_findings(t), t("cab0"), "concentracion_extrema")
