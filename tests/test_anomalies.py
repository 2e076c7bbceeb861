from __future__ import annotations

from scrutiny.plans import anomalies


def kinds(df):
    return sorted((r.tipo, r.severidad, r.idActa) for r in df.collect())


def test_single_acta_rules(spark, header):
    rows = header({}, {"totalVotosValidos": 201}, {"totalAsistentes": 301},
                  {"porcentajeParticipacionCiudadana": 100.5}, {"totalVotosEmitidos": None},
                  {"totalAsistentes": None, "porcentajeParticipacionCiudadana": None})
    assert kinds(anomalies.detect("validos_gt_emitidos", rows)) == [("validos_gt_emitidos", "CRITICAL", 2)]
    assert kinds(anomalies.detect("asistentes_gt_habiles", rows)) == [("asistentes_gt_habiles", "CRITICAL", 3)]
    assert kinds(anomalies.detect("participacion_gt_100", rows)) == [("participacion_gt_100", "CRITICAL", 4)]
    text = anomalies.detect("validos_gt_emitidos", rows).first().mensaje
    assert text == "validos=201 > emitidos=200 (imposible)"


def test_sum_mismatch_tolerates_one_vote(spark, header, votes):
    rows = header({}, {}, {}, {"codigoEstadoActa": "E"}, {})
    given = votes((1, "A", False, 199), (2, "A", False, 198), (3, "A", False, 150), (3, "VOTOS NULOS", True, 53),
                  (4, "A", False, 1))
    assert kinds(anomalies.detect("suma_votos_mismatch", rows, given)) == [
        ("suma_votos_mismatch", "HIGH", 2), ("suma_votos_mismatch", "HIGH", 3)]


def test_concentration_ignores_special_rows(spark, header, votes):
    rows = header({}, {}, {"totalVotosValidos": 0}, {})
    given = votes((1, "A", False, 171), (2, "A", False, 170), (2, "VOTOS EN BLANCO", True, 180),
                  (3, "A", False, 10), (4, "VOTOS NULOS", True, 180))
    assert kinds(anomalies.detect("concentracion_extrema", rows, given)) == [
        ("concentracion_extrema", "MEDIUM", 1)]
    assert anomalies.detect("concentracion_extrema", rows, given).first().mensaje == (
        "1 partido tomó 95.0% de válidos (>= 95%)")


def test_outliers_stay_within_their_district(spark, header):
    usual = [{"porcentajeParticipacionCiudadana": 70.0 + (i % 5) * 0.1} for i in range(60)]
    odd = [{"porcentajeParticipacionCiudadana": 20.0}]
    other = [{"porcentajeParticipacionCiudadana": 20.0, "idDistritoElectoral": 3} for _ in range(30)]
    none = [{"porcentajeParticipacionCiudadana": 0.0}, {"porcentajeParticipacionCiudadana": 101.0}]
    found = anomalies.detect_turnout_outliers(header(*usual, *odd, *other, *none))
    assert kinds(found) == [("participacion_outlier_distrito", "MEDIUM", 61)]


def roll(spark, total):
    return spark.createDataFrame([("140101", "Nacional", total), ("140101", "Extranjero", 1)],
                                 "ubigeo_reniec string, residencia string, total_electores bigint")


def test_votes_beyond_roll(spark, header):
    rows = header({}, {}, {"idEleccion": 13}, {"codigoEstadoActa": "P"}, {"idAmbitoGeografico": 2})
    found = anomalies.detect_votes_beyond_roll(rows, roll(spark, 380)).collect()
    assert [(r.idActa, r.valor_observado, r.valor_esperado_max) for r in found] == [(None, 400.0, 399.0)]
    assert found[0].mensaje == "emitidos=400 > padrón×1.05 = 399 (padrón RENIEC Q1 2026)"
    assert anomalies.detect_votes_beyond_roll(rows, roll(spark, 381)).count() == 0


def test_all_rules_together_equal_each_alone(spark, header, votes):
    rows = header({"totalVotosValidos": 201}, {"totalAsistentes": 301}, {}, {"porcentajeParticipacionCiudadana": 120.0})
    given = votes((1, "A", False, 200), (2, "A", False, 100), (3, "A", False, 180), (4, "A", False, 1))
    alone = []
    for name, rule in anomalies.acta_rules().items():
        alone += map(tuple, anomalies.detect(name, rows, given if rule.needs_votes else None).collect())
    assert sorted(map(str, alone)) == sorted(
        str(tuple(r)) for r in anomalies.detect_acta_rules(rows, given).collect())
    everything = anomalies.run_all(rows, given, roll(spark, 1))
    assert [r.severidad for r in everything.collect()] == sorted(r.severidad for r in everything.collect())
    high = anomalies.run_all(rows, given, roll(spark, 1), min_severity="HIGH")
    assert {r.severidad for r in high.collect()} == {"CRITICAL", "HIGH"}
    assert anomalies.run_all(rows, given, roll(spark, 1), election=13).count() == 0
    assert "emitidos_gt_padron_reniec" not in {
        r.tipo for r in anomalies.run_all(rows.drop("idAmbitoGeografico"), given, roll(spark, 1)).collect()}
