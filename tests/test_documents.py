from __future__ import annotations

import json

from pyspark.sql import functions as F

from scrutiny import contracts as c
from scrutiny.plans.ingest import flatten_documents, outcomes, run_ledger, run_progress
from scrutiny.sources.documents import parse_documents

TS = 1776488709960


def detail(i: int) -> dict:
    special = {38: "VOTOS EN BLANCO", 39: "VOTOS NULOS", 40: "VOTOS IMPUGNADOS"}
    row = {"descripcion": special.get(i, f"PARTIDO {i}"), "ccodigo": f"{i:08d}",
           "nposicion": i + 1, "nvotos": 102 if i == 34 else i % 3, "nagrupacionPolitica": i,
           "nporcentajeVotosValidos": 41.463, "totalCandidatos": 0, "estado": 1, "grafico": 1}
    if i < 38:
        row["candidato"] = [{"apellidoPaterno": f"AP{j}", "nombres": "N", "cdocumentoIdentidad": str(j)}
                            for j in range(1 + i % 3)]
    return row


COUNTED = {
    "id": 550704010210, "codigoMesa": "005507", "idEleccion": 10, "codigoEstadoActa": "C",
    "totalElectoresHabiles": 274, "totalVotosEmitidos": 251, "totalVotosValidos": 246,
    "porcentajeParticipacionCiudadana": 91.606, "estadoActa": "D",
    "detalle": [detail(i) for i in range(41)],
    "lineaTiempo": [{"codigoEstadoActa": "D", "fechaRegistro": 1}, {"codigoEstadoActa": "C", "fechaRegistro": 2}],
    "archivos": [{"id": "69dce34ad7b6147f63e6fe04", "tipo": 1}, {"id": "x", "tipo": 2}],
}
SENT = {**COUNTED, "id": 2, "codigoEstadoActa": "E", "totalVotosEmitidos": None, "totalVotosValidos": None}
PENDING = {"id": 3, "codigoMesa": "000003", "idEleccion": 10, "codigoEstadoActa": "P", "detalle": None,
           "lineaTiempo": [], "archivos": [{"id": "y", "tipo": 1}]}
MISSING = {"id": None, "codigoMesa": None, "detalle": None, "lineaTiempo": None, "archivos": None}
NO_ID = {**PENDING, "id": 0, "detalle": [{"descripcion": None, "nvotos": 1, "candidato": []}]}
BODIES = [(550704010210, COUNTED), (2, SENT), (3, PENDING), (4, MISSING), (55, NO_ID)]


def landed(spark, bodies=BODIES, extra=()):
    rows = [(i, i + 100, "040102", TS, json.dumps(b)) for i, b in bodies]
    rows += [(i, 0, "040102", TS, text) for i, text in extra]
    return spark.createDataFrame(
        rows, "req_acta_id bigint, req_id_mesa bigint, req_ubigeo string, snapshot_ts_ms bigint, "
        "body string")


def test_flatten_by_state(spark):
    flat = flatten_documents(parse_documents(landed(spark)))
    counts = {name: {r["idActa"]: r["n"] for r in
                     df.groupBy("idActa").agg(F.count("*").alias("n")).collect()}
              for name, df in flat.items()}
    acta = 550704010210
    assert counts["actas_cabecera"] == {acta: 1, 2: 1, 3: 1, 55: 1}
    assert counts["actas_votos"] == {acta: 41, 2: 41, 55: 1}
    assert counts["actas_linea_tiempo"] == {acta: 2, 2: 2}
    assert counts["actas_archivos"] == {acta: 2, 2: 2, 3: 1, 55: 1}
    assert counts["actas_candidatos"][acta] == sum(1 + i % 3 for i in range(38))
    for name, df in flat.items():
        assert df.schema.simpleString() == c.fact_schema(name).simpleString()


def test_header_and_vote_values(spark):
    flat = flatten_documents(parse_documents(landed(spark)))
    acta = F.col("idActa") == 550704010210
    head = flat["actas_cabecera"].filter(acta).first()
    assert (head.codigoMesa, head.totalElectoresHabiles, head.totalVotosEmitidos,
            head.totalVotosValidos) == ("005507", 274, 251, 246)
    assert (head.idMesaRef, head.ubigeoDistrito) == (550704010310, "040102")
    assert head.snapshot_lima_iso == "2026-04-18T00:05:09.960000-05:00"
    votes = flat["actas_votos"].filter(acta)
    assert votes.filter("es_especial").count() == 3
    assert votes.filter("nvotos = 102").count() == 1
    first = votes.filter("nposicion = 3").first()
    assert (first.cand_apellido_paterno, first.cand_doc, first.cargo) == ("AP0", "0", None)
    special = votes.filter("es_especial").first()
    assert special.cand_nombres is None
    blank = flat["actas_votos"].filter("idActa = 55").first()
    assert (blank.descripcion, blank.es_especial, blank.cand_nombres) == ("", False, None)


def test_candidates_keep_their_order(spark):
    rows = flatten_documents(parse_documents(landed(spark)))["actas_candidatos"].filter(
        "idActa = 2 AND partido_ccodigo = '00000002'").orderBy("candidato_idx").collect()
    assert [(r.candidato_idx, r.apellidoPaterno) for r in rows] == [(0, "AP0"), (1, "AP1"), (2, "AP2")]


def test_unreadable_answers_are_failures_not_missing_stations(spark):
    docs = parse_documents(landed(spark, extra=[(6, "<html>"), (7, None), (8, ""), (9, "null")]))
    got = {r.req_acta_id: r.outcome for r in outcomes(docs).collect()}
    assert got == {550704010210: "ok", 2: "ok", 3: "ok", 55: "ok", 4: "empty", 6: "failed",
                   7: "failed", 8: "failed", 9: "empty"}


def test_ledger_and_progress(spark):
    docs = parse_documents(landed(spark, extra=[(6, "<html>")]))
    one = run_ledger(docs, TS, 0, 20)
    two = run_ledger(docs, TS, 1, 20)
    row = run_progress(one.unionByName(two)).first()
    assert (row.completed, row.expected, row.pct) == (10, 20, 50.0)
