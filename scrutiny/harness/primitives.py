"""Queries over single operators: filters, joins, aggregates, windows, sorts, functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from scrutiny import contracts as c
from scrutiny.functions import aggregates as A
from scrutiny.functions import scalars as S
from scrutiny.harness.registry import query
from scrutiny.operators import contract_checks, filters, keys, ranking, rollups, unions, versions
from scrutiny.plans import dq

# --- projections and filters --------------------------------------------------


@query("select_rename_literal", "P1 S3", """
SELECT idActa, descripcion AS partido, nvotos, 'acta' AS origen FROM {votos}""")
def _(t):
    return t("votos").select("idActa", F.col("descripcion").alias("partido"), "nvotos",
                             F.lit("acta").alias("origen"))


@query("drop_run_columns", "P2 P3", """
SELECT idActa, nposicion, nvotos FROM {votos}""")
def _(t):
    df = t("votos").select("idActa", "nposicion", "nvotos", "run_ts_ms",
                           F.lit(None).cast("bigint").alias("idMesa"))
    return filters.drop_legacy(filters.drop_run_columns(df))


@query("filter_selection", "P4 E3", """
SELECT idActa, idEleccion, ubigeoDistrito, codigoEstadoActa FROM {cab0}
WHERE idEleccion IN (10, 13) AND idDistritoElectoral IN (1, 2, 8, 15, 27)
  AND ubigeoDepartamento IN ('010000', '020000', '070000', '920000')
  AND idAmbitoGeografico = 1 AND codigoEstadoActa = 'C'""")
def _(t):
    chosen = filters.selection(
        elections=[10, 13], districts=[1, 2, 8, 15, 27],
        departments=["010000", "020000", "070000", "920000"], scope=1, state="C")
    return filters.apply_selection(t("cab0"), chosen).select(
        "idActa", "idEleccion", "ubigeoDistrito", "codigoEstadoActa")


@query("filter_null_safe", "P5", """
SELECT idActa, totalVotosValidos, totalVotosEmitidos FROM {cab}
WHERE totalVotosValidos IS NOT NULL AND totalVotosEmitidos IS NOT NULL
  AND totalVotosValidos > totalVotosEmitidos""")
def _(t):
    return t("cab").filter(F.col("totalVotosValidos") > F.col("totalVotosEmitidos")).select(
        "idActa", "totalVotosValidos", "totalVotosEmitidos")


@query("coerce_null_columns", "P6", """
SELECT idActa, CAST(NULL AS BIGINT) AS nvotos, CAST(NULL AS VARCHAR) AS cargo,
  CAST(NULL AS DOUBLE) AS nporcentajeVotosValidos FROM {votos}""")
def _(t):
    untyped = t("votos").select("idActa", F.lit(None).alias("nvotos"), F.lit(None).alias("cargo"),
                                F.lit(None).alias("nporcentajeVotosValidos"))
    return contract_checks.coerce_null_columns(untyped, "actas_votos")


@query("stamp_rows", "P8 F4 F5", """
SELECT event_id, ms AS snapshot_ts_ms, 'demo' AS fuente,
  strftime(make_timestamp((ms - 18000000) * 1000), '%Y-%m-%dT%H:%M:%S') ||
    CASE WHEN ms % 1000 = 0 THEN '' ELSE '.' || lpad(CAST(ms % 1000 AS VARCHAR), 3, '0') || '000'
    END || '-05:00' AS snapshot_lima_iso,
  strftime(make_timestamp((ms - 18000000) * 1000), '%Y-%m-%d') AS snapshot_date
FROM (SELECT event_id, @ms(ts) AS ms FROM {events}) e""")
def _(t):
    from scrutiny.sources.documents import stamp

    rows = t.sql("SELECT event_id, @ms(ts) AS ms FROM {events}")
    return (
        stamp(rows, F.col("ms"), fuente="demo").drop("ms")
        .withColumn("snapshot_date", S.lima_date("snapshot_ts_ms"))
    )


@query("require_enriched", "P9 D30", """
SELECT idDistritoElectoral, count(*) AS n FROM {cab0} GROUP BY idDistritoElectoral""")
def _(t):
    return dq.require_enriched(t("cab0")).groupBy("idDistritoElectoral").agg(
        F.count(F.lit(1)).alias("n"))


@query("scope_filter_default", "P11", """
SELECT idMesa, idAmbitoGeografico FROM {mesas} WHERE idAmbitoGeografico IN (1)
UNION ALL SELECT idMesa, 1 FROM {mesas}""")
def _(t):
    cols = ["idMesa", "idAmbitoGeografico"]
    scoped = filters.in_scopes(t("mesas"), [1]).select(*cols)
    legacy = filters.in_scopes(t("mesas").drop("idAmbitoGeografico"), [1]).select(*cols)
    return unions.union_all([scoped, legacy])


@query("state_filter", "P12", """
SELECT idActa, codigoEstadoActa FROM {cab0} WHERE codigoEstadoActa IN ('P', 'E')""")
def _(t):
    return filters.in_states(t("cab0")).select("idActa", "codigoEstadoActa")


@query("severity_threshold", "P13", """
SELECT idActa, severidad FROM (SELECT idActa,
    CASE idActa % 4 WHEN 0 THEN 'CRITICAL' WHEN 1 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' ELSE 'INFO' END
      AS severidad FROM {cab0}) x
WHERE severidad IN ('CRITICAL', 'HIGH')""")
def _(t):
    level = (F.when(F.col("idActa") % 4 == 0, "CRITICAL").when(F.col("idActa") % 4 == 1, "HIGH")
             .when(F.col("idActa") % 4 == 2, "MEDIUM").otherwise("INFO"))
    return filters.at_least_severity(t("cab0").select("idActa", level.alias("severidad")), "HIGH")


# --- joins --------------------------------------------------------------------


@query("curated_votes_last_run", "W1 J1 A5", """
SELECT v.idActa, v.nposicion, v.run_ts_ms, v.ccodigo, v.nvotos FROM {votos} v JOIN (
  SELECT idActa, max(run_ts_ms) AS m FROM {votos} GROUP BY idActa) l
ON v.idActa = l.idActa AND v.run_ts_ms = l.m""")
def _(t):
    votes = t("votos").select("idActa", "nposicion", "run_ts_ms", "ccodigo", "nvotos")
    return versions.keep_runs(votes, versions.latest_runs(votes))


@query("terminal_without_detail", "J2 D60", """
SELECT idActa, codigoMesa, ubigeoDistrito, idEleccion, estadoActa FROM {cab0} c
WHERE codigoEstadoActa = 'C' AND NOT EXISTS (SELECT 1 FROM {votos} v WHERE v.idActa = c.idActa)""")
def _(t):
    return dq.counted_without_detail(t("cab0"), t("votos"))


@query("terminal_without_detail_distribution", "D60 A1", """
SELECT 'idEleccion' AS dimension, CAST(idEleccion AS VARCHAR) AS value, count(*) AS n
FROM {cab0} c WHERE codigoEstadoActa = 'C'
  AND NOT EXISTS (SELECT 1 FROM {votos} v WHERE v.idActa = c.idActa) GROUP BY idEleccion
UNION ALL SELECT 'estadoActa', estadoActa, count(*)
FROM {cab0} c WHERE codigoEstadoActa = 'C'
  AND NOT EXISTS (SELECT 1 FROM {votos} v WHERE v.idActa = c.idActa) GROUP BY estadoActa""")
def _(t):
    return dq.without_detail_distribution(dq.counted_without_detail(t("cab0"), t("votos")))


@query("fact_header_join", "J4", """
SELECT v.idActa, v.nposicion, v.ubigeoDistrito, c.ubigeoDistrito AS ubigeoDistrito_cab, v.nvotos
FROM {votos} v JOIN {cab0} c ON v.idActa = c.idActa""")
def _(t):
    header = t("cab0").select("idActa", F.col("ubigeoDistrito").alias("ubigeoDistrito_cab"))
    return t("votos").select("idActa", "nposicion", "ubigeoDistrito", "nvotos").join(
        header, "idActa", "inner")


@query("header_with_vote_sums", "J5 A3", """
SELECT c.idActa, c.totalVotosEmitidos, CAST(sum(v.nvotos) AS BIGINT) AS suma_nvotos
FROM {cab} c JOIN {votos} v ON c.idActa = v.idActa GROUP BY c.idActa, c.totalVotosEmitidos""")
def _(t):
    sums = t("votos").groupBy("idActa").agg(A.total("nvotos").alias("suma_nvotos"))
    return t("cab").select("idActa", "totalVotosEmitidos").join(sums, "idActa", "inner")


@query("zscore_within_group", "J6 W7 A6", """
SELECT idActa, idEleccion, round((p - m) / s, 4) AS z FROM (
  SELECT idActa, c.idEleccion, p, m, s FROM
   (SELECT idActa, idEleccion, idDistritoElectoral, porcentajeParticipacionCiudadana AS p
    FROM {cab} WHERE porcentajeParticipacionCiudadana > 0
      AND porcentajeParticipacionCiudadana <= 100) c
  JOIN (SELECT idDistritoElectoral, idEleccion, avg(porcentajeParticipacionCiudadana) AS m,
      stddev_samp(porcentajeParticipacionCiudadana) AS s FROM {cab}
    WHERE porcentajeParticipacionCiudadana > 0 AND porcentajeParticipacionCiudadana <= 100
    GROUP BY idDistritoElectoral, idEleccion) g
  ON c.idDistritoElectoral = g.idDistritoElectoral AND c.idEleccion = g.idEleccion
  WHERE s > 0) x""")
def _(t):
    pct = F.col("porcentajeParticipacionCiudadana")
    base = t("cab").filter((pct > 0) & (pct <= 100)).select(
        "idActa", "idEleccion", "idDistritoElectoral", pct.alias("p"))
    group = ["idDistritoElectoral", "idEleccion"]
    stats = base.groupBy(*group).agg(F.avg("p").alias("m"), F.stddev_samp("p").alias("s")).filter(
        F.col("s") > 0)
    return base.join(stats, group).select(
        "idActa", "idEleccion", F.round((F.col("p") - F.col("m")) / F.col("s"), 4).alias("z"))


@query("join_different_keys", "J7", """
SELECT c.ubigeoDistrito, p.total_electores, count(*) AS actas
FROM {cab0} c JOIN {padron} p ON c.ubigeoDistrito = p.ubigeo_reniec
GROUP BY c.ubigeoDistrito, p.total_electores""")
def _(t):
    actas = t("cab0").groupBy("ubigeoDistrito").agg(F.count(F.lit(1)).alias("actas"))
    return actas.join(t("padron"), F.col("ubigeoDistrito") == F.col("ubigeo_reniec")).select(
        "ubigeoDistrito", "total_electores", "actas")


@query("membership_in_other_table", "J9", """
SELECT idActa, nposicion, nvotos FROM {votos}
WHERE idActa IN (SELECT idActa FROM {cab0} WHERE idAmbitoGeografico = 2) AND NOT es_especial""")
def _(t):
    abroad = t("cab0").filter(F.col("idAmbitoGeografico") == 2)
    return keys.only_in(t("votos").filter(~F.col("es_especial")), abroad, "idActa").select(
        "idActa", "nposicion", "nvotos")


@query("station_election_tasks", "J10 F1", """
SELECT idMesa * 100000000 + CAST(ubigeoDistrito AS BIGINT) * 100 + e.idEleccion AS idActa,
  idMesa, ubigeoDistrito, e.idEleccion
FROM {mesas} CROSS JOIN (SELECT CAST(unnest([10, 12, 13, 14, 15]) AS BIGINT) AS idEleccion) e""")
def _(t):
    return keys.station_tasks(t("mesas"))


@query("pending_tasks", "J12", """
SELECT idActa, idMesaRef FROM {cab0} c
WHERE NOT EXISTS (SELECT 1 FROM {votos} v WHERE v.idActa = c.idActa)""")
def _(t):
    return keys.pending(t("cab0").select("idActa", "idMesaRef"), t("votos"))


@query("key_difference", "U3 J13", """
SELECT DISTINCT c_custkey FROM {customer}
EXCEPT SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'P'""")
def _(t):
    known = t("orders").filter("o_orderstatus = 'P'").select(
        F.col("o_custkey").alias("c_custkey"))
    return keys.not_in(t("customer").select("c_custkey"), known, "c_custkey")


@query("structural_match_counts", "J14", """
SELECT (SELECT count(*) FROM {of_totales_de} WHERE snapshot_ts_ms = 1700000900000) AS oficiales,
  (SELECT count(*) FROM {of_totales_de} o JOIN (
     SELECT idEleccion, idDistritoElectoral FROM {cab0} WHERE codigoEstadoActa = 'P'
     GROUP BY ALL) c
   ON o.idEleccion = c.idEleccion AND o.idDistritoElectoral = c.idDistritoElectoral
   WHERE o.snapshot_ts_ms = 1700000900000) AS pares""")
def _(t):
    group = ["idEleccion", "idDistritoElectoral"]
    official = versions.last_snapshot(t("of_totales_de")).select(*group)
    pending = filters.in_states(t("cab0"), ["P"]).select(*group).distinct().withColumn(
        "_m", F.lit(1))
    return official.join(pending, group, "left").agg(
        F.count(F.lit(1)).alias("oficiales"), F.count("_m").alias("pares"))


# --- aggregates ---------------------------------------------------------------


@query("count_by_keys", "A1", """
SELECT idEleccion, codigoEstadoActa, count(*) AS n FROM {cab0} GROUP BY idEleccion, codigoEstadoActa
""")
def _(t):
    return t("cab0").groupBy("idEleccion", "codigoEstadoActa").agg(F.count(F.lit(1)).alias("n"))


@query("distinct_with_null", "A2", """
SELECT idEleccion, count(DISTINCT ubigeoDistrito) AS lugares,
  CAST(count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS valores
FROM (SELECT *, nullif(idMesaRef % 50, 7) AS v FROM {cab0}) x GROUP BY idEleccion""")
def _(t):
    df = t("cab0").withColumn("v", F.nullif(F.col("idMesaRef") % 50, F.lit(7)))
    return df.groupBy("idEleccion").agg(
        A.distinct_values("ubigeoDistrito").cast("bigint").alias("lugares"),
        A.distinct_values("v").cast("bigint").alias("valores"))


@query("sum_null_as_zero", "A3", """
SELECT ubigeoDistrito, CAST(coalesce(sum(totalVotosEmitidos), 0) AS BIGINT) AS emitidos
FROM {cab} WHERE codigoEstadoActa = 'P' GROUP BY ubigeoDistrito""")
def _(t):
    return filters.in_states(t("cab"), ["P"]).groupBy("ubigeoDistrito").agg(
        A.total("totalVotosEmitidos").alias("emitidos"))


@query("conditional_sums", "A4", """
SELECT idActa, CAST(sum(nvotos) AS BIGINT) AS sum_tot,
  CAST(coalesce(sum(nvotos) FILTER (WHERE NOT es_especial), 0) AS BIGINT) AS sum_val
FROM {votos} GROUP BY idActa""")
def _(t):
    return t("votos").groupBy("idActa").agg(
        A.total("nvotos").alias("sum_tot"),
        A.total_where(~F.col("es_especial"), "nvotos").alias("sum_val"))


@query("min_max", "A5", """
SELECT min(ship_ms) AS primero, max(ship_ms) AS ultimo, max(nvotos) AS mayor FROM {votos}""")
def _(t):
    return t("votos").agg(F.min("ship_ms").alias("primero"), F.max("ship_ms").alias("ultimo"),
                          F.max("nvotos").alias("mayor"))


@query("mean_and_deviation", "A6", """
SELECT idEleccion, round(avg(nvotos), 4) AS media, round(stddev_samp(nvotos), 4) AS desviacion
FROM {votos} GROUP BY idEleccion HAVING stddev_samp(nvotos) > 0""")
def _(t):
    return t("votos").groupBy("idEleccion").agg(
        F.round(F.avg("nvotos"), 4).alias("media"),
        F.round(F.stddev_samp("nvotos"), 4).alias("desviacion")).filter(F.col("desviacion") > 0)


@query("first_per_key", "A7 A12", """
SELECT ubigeoDistrito, idMesa, codigoMesa FROM (SELECT *, row_number() OVER
  (PARTITION BY ubigeoDistrito ORDER BY codigoMesa, idMesa) AS rn FROM {mesas}) x WHERE rn = 1""")
def _(t):
    rows = t("mesas").select("ubigeoDistrito", "idMesa", "codigoMesa")
    return versions.first_per_key(rows, ["ubigeoDistrito"], ["codigoMesa", "idMesa"])


@query("group_size_histogram", "A8", """
SELECT n, count(*) AS actas FROM (SELECT idActa, idEleccion, count(*) AS n FROM {votos}
  GROUP BY idActa, idEleccion) x GROUP BY n""")
def _(t):
    return dq.detail_histogram(t("votos"))


@query("violation_counters", "A9", """
SELECT count(*) FILTER (WHERE totalVotosEmitidos > totalElectoresHabiles) AS emit_gt_hab,
  count(*) FILTER (WHERE totalVotosValidos > totalVotosEmitidos) AS val_gt_emit,
  count(*) FILTER (WHERE totalAsistentes > totalElectoresHabiles) AS asis_gt_hab FROM {cab}""")
def _(t):
    col = F.col
    return t("cab").agg(
        A.count_where(col("totalVotosEmitidos") > col("totalElectoresHabiles"))
        .alias("emit_gt_hab"),
        A.count_where(col("totalVotosValidos") > col("totalVotosEmitidos")).alias("val_gt_emit"),
        A.count_where(col("totalAsistentes") > col("totalElectoresHabiles")).alias("asis_gt_hab"))


@query("share_of_group_total", "A10", """
SELECT idEleccion, ccodigo, v, CAST(sum(v) OVER (PARTITION BY idEleccion) AS BIGINT) AS total,
  round(v * 100.0::DOUBLE / sum(v) OVER (PARTITION BY idEleccion), 6) AS pct
FROM (SELECT idEleccion, ccodigo, CAST(sum(nvotos) AS BIGINT) AS v FROM {votos} GROUP BY ALL) x""")
def _(t):
    totals = t("votos").groupBy("idEleccion", "ccodigo").agg(A.total("nvotos").alias("v"))
    return ranking.share_of_group(totals, ["idEleccion"], "v", "total", "pct").withColumn(
        "pct", F.round("pct", 6))


@query("share_of_all_rows", "A11", """
SELECT codigoEstadoActa, count(*) AS n,
  round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS pct FROM {cab0}
GROUP BY codigoEstadoActa""")
def _(t):
    counts = t("cab0").groupBy("codigoEstadoActa").agg(F.count(F.lit(1)).alias("n"))
    return ranking.share_of_all(counts, "n", "pct").withColumn("pct", F.round("pct", 6))


@query("distinct_non_null", "A13", """
SELECT DISTINCT archivoId FROM {archivos} WHERE archivoId IS NOT NULL""")
def _(t):
    return t("archivos").select("archivoId").filter(F.col("archivoId").isNotNull()).distinct()


@query("geo_rollup_3_levels", "A14 F3", """
WITH d AS (SELECT substr(ubigeoDistrito, 1, 2) || '0000' AS p2,
    substr(ubigeoDistrito, 1, 4) || '00' AS p4, ubigeoDistrito AS p6, totalVotosEmitidos AS e
  FROM {cab})
SELECT CASE WHEN GROUPING(p2) = 0 THEN 'department' WHEN GROUPING(p4) = 0 THEN 'province'
    ELSE 'district' END AS level, coalesce(p2, p4, p6) AS place,
  CAST(coalesce(sum(e), 0) AS BIGINT) AS emit, count(*) AS n
FROM d GROUP BY GROUPING SETS ((p2), (p4), (p6))""")
def _(t):
    return rollups.by_place(t("cab"), {"emit": F.col("totalVotosEmitidos"), "n": F.lit(1)}).select(
        "level", "place", "emit", F.col("n").cast("bigint").alias("n"))


@query("state_matrix", "A16 R10", """
SELECT idEleccion, count(*) FILTER (WHERE codigoEstadoActa = 'C') AS "C",
  count(*) FILTER (WHERE codigoEstadoActa = 'E') AS "E",
  count(*) FILTER (WHERE codigoEstadoActa = 'P') AS "P",
  count(*) FILTER (WHERE codigoEstadoActa IN ('C', 'E', 'P')) AS total
FROM {cab0} GROUP BY idEleccion""")
def _(t):
    return rollups.state_matrix(t("cab0"))


@query("max_ratio_of_deltas", "A17 D34", """
SELECT round(coalesce(max(ratio), 0), 8) AS max_ratio FROM (
  SELECT o.idDistritoElectoral, CAST(sum(abs(c.v - o.totalVotosValidos)) AS DOUBLE) /
      CASE WHEN sum(o.totalVotosValidos) > 0 THEN sum(o.totalVotosValidos) ELSE 1 END AS ratio
  FROM {of_partidos_de} o JOIN (SELECT h.idDistritoElectoral, v.nagrupacionPolitica,
      sum(v.nvotos) AS v FROM {votos} v JOIN {cab0} h ON v.idActa = h.idActa
    WHERE NOT v.es_especial AND v.idEleccion = 13 GROUP BY ALL) c
  ON o.idDistritoElectoral = c.idDistritoElectoral
    AND CAST(o.codigoAgrupacionPolitica AS BIGINT) = c.nagrupacionPolitica
  WHERE o.idEleccion = 13 GROUP BY o.idDistritoElectoral) x""")
def _(t):
    drift = dq.party_drift_by_district(t("votos"), t("cab0"), t("of_partidos_de"))
    return drift.agg(F.round(F.coalesce(F.max("ratio"), F.lit(0.0)), 8).alias("max_ratio"))


@query("all_true", "A18", """
SELECT idEleccion, coalesce(bool_and(nvotos > 0), true) AS todas FROM {votos} GROUP BY idEleccion
""")
def _(t):
    return t("votos").groupBy("idEleccion").agg(A.all_true(F.col("nvotos") > 0).alias("todas"))


# --- versions, ranking, sorts -------------------------------------------------


@query("winner_by_department", "W2", """
SELECT dep, descripcion, v FROM (SELECT *, row_number() OVER (PARTITION BY dep
    ORDER BY v DESC, descripcion) AS rn
  FROM (SELECT c.ubigeoDepartamento AS dep, v.descripcion, CAST(sum(v.nvotos) AS BIGINT) AS v
    FROM {votos} v JOIN {cab0} c ON v.idActa = c.idActa WHERE NOT v.es_especial
    GROUP BY ALL) x) y WHERE rn = 1""")
def _(t):
    totals = (
        t("votos").filter(~F.col("es_especial")).select("idActa", "descripcion", "nvotos")
        .join(t("cab0").select("idActa", F.col("ubigeoDepartamento").alias("dep")), "idActa")
        .groupBy("dep", "descripcion").agg(A.total("nvotos").alias("v"))
    )
    return ranking.winners(totals, ["dep"], "v", "descripcion")


@query("array_positions", "W3", """
SELECT o_orderkey, CAST(g.i AS BIGINT) AS evento_idx, o_orderkey * 10 + g.i AS fecha
FROM {orders}, LATERAL (SELECT unnest(generate_series(0, o_orderkey % 4)) AS i) g""")
def _(t):
    values = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("o_orderkey") % 4),
                         lambda i: F.col("o_orderkey") * 10 + i)
    return t("orders").select("o_orderkey", F.posexplode(values).alias("evento_idx", "fecha")
                              ).withColumn("evento_idx", F.col("evento_idx").cast("bigint"))


@query("latest_snapshot", "W4 S2", """
SELECT idEleccion, snapshot_ts_ms, totalActas FROM {of_totales}
WHERE snapshot_ts_ms = (SELECT max(snapshot_ts_ms) FROM {of_totales})""")
def _(t):
    return versions.last_snapshot(t("of_totales").select(
        "idEleccion", "snapshot_ts_ms", "totalActas"))


@query("last_n_snapshots", "W5 R12", """
SELECT snapshot_ts_ms, contabilizadas, pct FROM (SELECT *, row_number() OVER (
    PARTITION BY snapshot_ts_ms ORDER BY contabilizadas, pct) AS rn
  FROM {snapshots} WHERE idEleccion = 10) x
WHERE rn = 1 ORDER BY snapshot_ts_ms DESC LIMIT 48""")
def _(t):
    rows = t("snapshots").filter(F.col("idEleccion") == 10).select(
        "snapshot_ts_ms", "contabilizadas", "pct")
    return versions.last_snapshots(rows, 48)


@query("last_record_per_key", "W6", """
SELECT user_id, event_id, ms FROM (SELECT user_id, event_id, @ms(ts) AS ms, row_number() OVER
  (PARTITION BY user_id ORDER BY @ms(ts) DESC, event_id DESC) AS rn FROM {events}) x
WHERE rn = 1""")
def _(t):
    rows = t.sql("SELECT user_id, event_id, @ms(ts) AS ms FROM {events}")
    return versions.last_record(rows, ["user_id"], "ms")


@query("sort_mixed", "O1", """
SELECT idEleccion, ccodigo, CAST(sum(nvotos) AS BIGINT) AS nvotos FROM {votos}
GROUP BY idEleccion, ccodigo ORDER BY idEleccion ASC, nvotos DESC, ccodigo""")
def _(t):
    return t("votos").groupBy("idEleccion", "ccodigo").agg(A.total("nvotos").alias("nvotos")
                                                           ).orderBy(
        F.col("idEleccion").asc(), F.col("nvotos").desc(), "ccodigo")


@query("sort_by_magnitude", "O2", """
SELECT ccodigo, CAST(sum(nvotos) - 30000 AS BIGINT) AS saldo FROM {votos} GROUP BY ccodigo
ORDER BY abs(sum(nvotos) - 30000) DESC, ccodigo""")
def _(t):
    return t("votos").groupBy("ccodigo").agg(
        (A.total("nvotos") - 30000).alias("saldo")).orderBy(F.abs("saldo").desc(), "ccodigo")


@query("top_k_global", "O3", """
SELECT ubigeoDistrito, count(*) AS n FROM {cab0} GROUP BY ubigeoDistrito
ORDER BY n DESC, ubigeoDistrito LIMIT 10""")
def _(t):
    counts = t("cab0").groupBy("ubigeoDistrito").agg(F.count(F.lit(1)).alias("n"))
    return ranking.top(counts, [F.col("n").desc(), F.col("ubigeoDistrito").asc()], 10)


@query("first_n_tasks", "O5", """
SELECT idActa, idMesaRef FROM {cab0} ORDER BY idActa LIMIT 500""")
def _(t):
    return keys.first_tasks(t("cab0").select("idActa", "idMesaRef"), 500)


@query("union_same_columns", "U1", """
SELECT s_suppkey AS id, s_name AS name FROM {supplier}
UNION ALL SELECT c_custkey, c_name FROM {customer}""")
def _(t):
    return unions.union_all([
        t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")),
        t("customer").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("id")),
    ])


@query("union_relaxed", "U2", """
SELECT CAST(s_suppkey AS VARCHAR) AS id, s_acctbal AS bal, CAST(NULL AS VARCHAR) AS seg
FROM {supplier}
UNION ALL SELECT 'C' || CAST(c_custkey AS VARCHAR), NULL, c_mktsegment FROM {customer}""")
def _(t):
    return unions.union_relaxed([
        t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("bal")),
        t("customer").select(
            F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("id"),
            F.col("c_mktsegment").alias("seg"), F.lit(None).alias("bal")),
    ])


@query("shard_cover", "U4 F8 X2", """
SELECT k % 1 + CAST((('0x' || md5(CAST(k AS VARCHAR)))::UHUGEINT) % 7 AS BIGINT) AS shard,
  count(*) AS n FROM (SELECT idMesa AS k FROM {mesas}) x GROUP BY shard""")
def _(t):
    parts = [keys.in_shard(t("mesas"), "idMesa", m, 7).select(F.lit(m).cast("bigint")
                                                              .alias("shard")) for m in range(7)]
    return unions.union_all(parts).groupBy("shard").agg(F.count(F.lit(1)).alias("n"))


@query("shard_of_key", "F8", """
SELECT o_orderkey, CAST((('0x' || md5(CAST(o_orderkey AS VARCHAR)))::UHUGEINT) % 1000003 AS BIGINT)
  AS shard FROM {orders}""")
def _(t):
    return t("orders").select("o_orderkey", S.shard_of("o_orderkey", 1_000_003).alias("shard"))


# --- scalar functions ---------------------------------------------------------


@query("acta_id", "F1", """
SELECT idMesa, CAST(lpad(CAST(idMesa AS VARCHAR), CAST(greatest(4, length(CAST(idMesa AS VARCHAR))) AS INTEGER), '0')
  || lpad(ubigeoDistrito, 6, '0') || '10' AS BIGINT) AS idActa FROM {mesas}""")
def _(t):
    return t("mesas").select("idMesa", S.acta_id("idMesa", "ubigeoDistrito", F.lit(10))
                             .alias("idActa"))


@query("place_codes", "F2 F3", """
SELECT c_custkey, lpad(CAST(coalesce(nullif(c_custkey % 4, 0) * 10101, c_custkey + 20000) AS VARCHAR),
  6, '0') AS ubigeo, substr(lpad(CAST(coalesce(nullif(c_custkey % 4, 0) * 10101,
  c_custkey + 20000) AS VARCHAR), 6, '0'), 1, 4) || '00' AS provincia FROM {customer}""")
def _(t):
    first = F.nullif(F.col("c_custkey") % 4, F.lit(0)) * 10101
    code = S.place_code(first, F.lit(None).cast("string"), F.col("c_custkey") + 20000)
    return t("customer").select("c_custkey", code.alias("ubigeo"),
                                S.place_prefix(code, "province").alias("provincia"))


@query("electoral_district", "F6 X1", """
SELECT idMesa, CAST(CASE WHEN idAmbitoGeografico = 2 THEN 27 WHEN d BETWEEN 1 AND 6 THEN d
    WHEN d BETWEEN 7 AND 13 THEN d + 1
    WHEN d = 14 THEN CASE WHEN ubigeoProvincia LIKE '1401%' THEN 15 ELSE 16 END
    WHEN d BETWEEN 15 AND 23 THEN d + 2 WHEN d = 24 THEN 7 WHEN d = 25 THEN 26 END AS BIGINT)
  AS idDistritoElectoral
FROM (SELECT *, TRY_CAST(substr(ubigeoDepartamento, 1, 2) AS INT) AS d FROM {mesas}) x""")
def _(t):
    return t("mesas").select("idMesa", S.electoral_district(
        "ubigeoDepartamento", "ubigeoProvincia", "idAmbitoGeografico")
        .alias("idDistritoElectoral"))


@query("age_bands", "F7", """
SELECT CASE WHEN Edad < 18 THEN '<18' WHEN Edad < 26 THEN '18_25' WHEN Edad < 36 THEN '26_35'
  WHEN Edad < 46 THEN '36_45' WHEN Edad < 61 THEN '46_60' ELSE '61_plus' END AS banda,
  CAST(sum(Cantidad) AS BIGINT) AS n FROM {padron_base} GROUP BY banda""")
def _(t):
    return t("padron_base").groupBy(S.age_band("Edad").alias("banda")).agg(
        A.total("Cantidad").alias("n"))


@query("valid_file_ids", "F11", """
SELECT archivoId, regexp_full_match(archivoId, '[0-9a-fA-F]{24}') AS valido
FROM {archivos} WHERE archivoId IS NOT NULL""")
def _(t):
    ids = t("archivos").filter(F.col("archivoId").isNotNull())
    return ids.select("archivoId", S.file_id_is_valid("archivoId").alias("valido"))


@query("sharded_paths", "F10", """
SELECT k, CASE WHEN length(k) < 4 THEN 'pdfs/' || k || '.pdf'
  ELSE 'pdfs/' || substr(k, 1, 2) || '/' || substr(k, 3, 2) || '/' || k || '.pdf' END AS path
FROM (SELECT CASE WHEN doc_id % 3 = 0 THEN substr(md5(CAST(doc_id AS VARCHAR)), 1, 3)
  ELSE md5(CAST(doc_id AS VARCHAR)) END AS k FROM {documents}) x""")
def _(t):
    digest = F.md5(F.col("doc_id").cast("string"))
    key = F.when(F.col("doc_id") % 3 == 0, F.substring(digest, 1, 3)).otherwise(digest)
    return t("documents").select(key.alias("k")).select("k", S.sharded_path("pdfs", "k")
                                                        .alias("path"))


@query("compact_dates", "F12", """
SELECT o_orderkey, raw, CASE WHEN length(raw) = 8 THEN substr(raw, 1, 4) || '-' ||
  substr(raw, 5, 2) || '-' || substr(raw, 7, 2) ELSE '' END AS iso
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '2026-04' ELSE
  CAST(20260000 + o_orderkey % 1300 AS VARCHAR) END AS raw FROM {orders}) x""")
def _(t):
    raw = F.when(F.col("o_orderkey") % 5 == 0, F.lit("2026-04")).otherwise(
        (F.lit(20260000) + F.col("o_orderkey") % 1300).cast("string"))
    return t("orders").select("o_orderkey", raw.alias("raw")).withColumn(
        "iso", S.compact_date_to_iso("raw"))


_DOC_NAME = """CASE o_orderkey % 7 WHEN 0 THEN 'N° ' || o_orderkey || '-2025-JNE'
  WHEN 1 THEN 'R.J. ' || o_orderkey || '/onpe/gg' WHEN 2 THEN 'RENIEC ' || o_orderkey
  WHEN 3 THEN 'N° ' || o_orderkey || '/JEE-LIMA' WHEN 4 THEN 'RJ-' || o_orderkey || '-ONPE'
  WHEN 5 THEN 'X/JNE/' || o_orderkey ELSE 'otro ' || o_orderkey END"""


@query("institutions", "F13", f"""
SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'JNE' WHEN 1 THEN 'ONPE' WHEN 2 THEN 'RENIEC'
  WHEN 3 THEN 'JEE' WHEN 4 THEN 'ONPE' WHEN 5 THEN 'JNE' ELSE '' END AS institucion,
  {_DOC_NAME} AS nombre FROM {{orders}}""")
def _(t):
    rows = t.sql(f"SELECT o_orderkey, {_DOC_NAME} AS nombre FROM {{orders}}")
    return rows.withColumn("institucion", S.institution_of("nombre"))


@query("https_urls", "F14", """
SELECT page_id, CASE WHEN url LIKE 'https://%' THEN url ELSE '' END AS url_pdf FROM {pages}""")
def _(t):
    return t("pages").select("page_id", S.https_only("url").alias("url_pdf"))


@query("operation_ids", "F15", """
SELECT doc_id, w, regexp_full_match(w, '[\\p{L}\\p{N}_.\\-]+') AS valido FROM (
  SELECT doc_id, source || '-' || doc_id AS w FROM {documents}
  UNION ALL SELECT doc_id, regexp_replace(text, '[\\t\\n\\f\\r ]+', '_', 'g') FROM {documents}) x""")
def _(t):
    words = F.array(F.concat_ws("-", "source", "doc_id"),
                    F.regexp_replace("text", r"[\t\n\f\r ]+", "_"))
    return t("documents").select("doc_id", F.explode(words).alias("w")).withColumn(
        "valido", S.operation_id_is_valid("w"))


_TITLE = """CASE doc_id % 9 WHEN 0 THEN 'Elección General 2026' WHEN 1 THEN 'Elecciones generales 20 26'
  WHEN 2 THEN 'datos EG 2026 final' WHEN 3 THEN 'Resultado de la mesa 2026'
  WHEN 4 THEN 'PRESIDENCIALES 2026' WHEN 5 THEN 'senador 2026' WHEN 6 THEN 'diputados  2026'
  WHEN 7 THEN 'congresales 2021' ELSE '' END || chr(10) || text"""


@query("title_class", "F16", f"""
SELECT doc_id, regexp_matches(t, '(?i)elecci[\\p{{L}}\\p{{N}}_]+\\s+generales?\\s+20\\s*26')
  OR regexp_matches(t, '(?i)(^|[^\\p{{L}}\\p{{N}}_])eg\\s*2026($|[^\\p{{L}}\\p{{N}}_])')
  OR regexp_matches(t, '(?i)resultados?\\s+.*\\s+2026')
  OR regexp_matches(t, '(?i)(presidenciales?|congresales?|diputados?|senadores?)\\s+2026')
  AS coincide FROM (SELECT doc_id, {_TITLE} AS t FROM {{documents}}) x""")
def _(t):
    rows = t.sql(f"SELECT doc_id, {_TITLE} AS t FROM {{documents}}")
    return rows.select("doc_id", S.title_matches("t").alias("coincide"))


@query("special_rows", "F17", """
SELECT descripcion, descripcion IN ('VOTOS EN BLANCO', 'VOTOS NULOS', 'VOTOS IMPUGNADOS') AS especial,
  count(*) AS n FROM {votos} GROUP BY descripcion""")
def _(t):
    return t("votos").groupBy("descripcion", S.is_special_row("descripcion").alias("especial")
                              ).agg(F.count(F.lit(1)).alias("n"))


@query("relative_drift", "F18 F20", """
SELECT idEleccion, round(abs(a - b) * 1.0::DOUBLE / greatest(a, 1) * 100, 6) AS drift_pct,
  greatest(10, CAST(floor(a * 0.01::DOUBLE / greatest(b, 1)) AS BIGINT)) AS tolerancia
FROM (SELECT idEleccion, CAST(sum(nvotos) AS BIGINT) AS a, count(*) AS b FROM {votos}
  GROUP BY idEleccion) x""")
def _(t):
    sums = t("votos").groupBy("idEleccion").agg(A.total("nvotos").alias("a"),
                                                F.count(F.lit(1)).alias("b"))
    return sums.select(
        "idEleccion", F.round(S.relative_drift_pct(F.col("a"), F.col("b")), 6).alias("drift_pct"),
        S.regional_tolerance(F.col("a"), F.col("b")).alias("tolerancia"))


@query("freshness", "F19 D20", """
SELECT c AS curated_ts, o AS official_ts, (c - o) / 60000.0::DOUBLE AS drift_min,
  CASE WHEN abs((c - o) / 60000.0::DOUBLE) < 60 THEN 'pass'
    WHEN abs((c - o) / 60000.0::DOUBLE) < 240 THEN 'warn' ELSE 'fail' END AS freshness
FROM (SELECT (SELECT max(snapshot_ts_ms) FROM {cab0}) AS c,
  (SELECT max(snapshot_ts_ms) FROM {of_totales}) AS o) x""")
def _(t):
    return dq.freshness(t("cab0"), t("of_totales"))


@query("messages", "F21", """
SELECT idActa, 'validos=' || totalVotosValidos || ' de ' ||
  round(porcentajeParticipacionCiudadana, 1) || '%' AS mensaje FROM {cab}""")
def _(t):
    return t("cab").select("idActa", S.message(
        "validos=", F.col("totalVotosValidos"), " de ",
        F.round("porcentajeParticipacionCiudadana", 1), "%").alias("mensaje"))


@query("content_hash", "F22", """
SELECT doc_id, sha256(text) AS sha256 FROM {documents}""")
def _(t):
    return t("documents").select("doc_id", S.content_hash("text").alias("sha256"))


@query("party_colors_and_classes", "F24", """
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN p < 50 THEN 'lt_50' WHEN p < 60 THEN 'ge_50' WHEN p < 65 THEN 'ge_60'
    WHEN p < 70 THEN 'ge_65' WHEN p < 75 THEN 'ge_70' WHEN p < 80 THEN 'ge_75' ELSE 'ge_80' END
  AS clase, CASE l_partkey % 4 WHEN 0 THEN '#ff6b35' WHEN 1 THEN '#d62828' ELSE '#95a5a6' END
  AS color FROM (SELECT *, l_quantity * 2 AS p FROM {lineitem}) x""")
def _(t):
    name = (F.when(F.col("l_partkey") % 4 == 0, "FUERZA POPULAR - LISTA")
            .when(F.col("l_partkey") % 4 == 1, "ACCIÓN POPULAR")
            .when(F.col("l_partkey") % 4 == 2, "POPULAR"))
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        S.turnout_class(F.col("l_quantity") * 2).alias("clase"),
        S.party_color(name).alias("color"))


@query("strict_codes", "F27", """
SELECT ccodigo, CAST(ccodigo AS BIGINT) AS cod, count(*) AS n FROM {votos} GROUP BY ccodigo""")
def _(t):
    return t("votos").groupBy("ccodigo").agg(F.count(F.lit(1)).alias("n")).select(
        "ccodigo", S.strict_number("ccodigo").alias("cod"), "n")


@query("clipped_percentages", "F28", """
SELECT idActa, round(least(totalVotosEmitidos * 130.0::DOUBLE / totalElectoresHabiles, 100.0), 2)
  AS pct FROM {cab}""")
def _(t):
    return t("cab").select("idActa", S.clipped_pct(S.ratio(
        F.col("totalVotosEmitidos") * F.lit(130.0), F.col("totalElectoresHabiles"))).alias("pct"))


@query("download_outcomes", "F29", """
SELECT estado, error IS NOT NULL AS con_error, coalesce(
  estado IN ('downloaded', 'skipped_existing', 'failed')
  AND ((estado = 'failed') = (error IS NOT NULL)), false) AS valido, count(*) AS n
FROM (SELECT CASE l_partkey % 4 WHEN 0 THEN 'downloaded' WHEN 1 THEN 'failed'
    WHEN 2 THEN 'skipped_existing' ELSE 'unknown' END AS estado,
  CASE WHEN l_suppkey % 3 = 0 THEN 'timeout' END AS error FROM {lineitem}) x
GROUP BY ALL""")
def _(t):
    state = (F.when(F.col("l_partkey") % 4 == 0, "downloaded")
             .when(F.col("l_partkey") % 4 == 1, "failed")
             .when(F.col("l_partkey") % 4 == 2, "skipped_existing").otherwise("unknown"))
    error = F.when(F.col("l_suppkey") % 3 == 0, "timeout")
    rows = t("lineitem").select(state.alias("estado"), error.alias("error"))
    return rows.groupBy(
        "estado", F.col("error").isNotNull().alias("con_error"),
        S.outcome_is_consistent("estado", "error").alias("valido"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("schema_violations", "P7", """
SELECT 'actas_votos' AS table_name, kind, column_name, count(*) AS filas FROM {votos}, (VALUES
  ('missing', 'cand_nombres'), ('mismatch', 'nvotos'), ('extra', 'ship_ms')) v(kind, column_name)
GROUP BY kind, column_name""")
def _(t):
    votes = t("votos")
    drifted = contract_checks.conform(votes, "actas_votos").drop("cand_nombres").withColumn(
        "nvotos", F.col("nvotos").cast("string")).withColumn("ship_ms", F.lit(0))
    report = contract_checks.contract_report(drifted, "actas_votos")
    rows = votes.select(F.count(F.lit(1)).alias("n"))
    return report.select("table_name", "kind", "column_name").withColumn("filas", rows.scalar())
