from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from scrutiny.operators.contract_checks import ContractError
from scrutiny.plans import dq


def results(df):
    return {r.check: r.result for r in df.collect()}


def five(header, **changes):
    return header(*[{"idActa": e, "idEleccion": e, **changes} for e in (10, 12, 13, 14, 15)])


def ballots(votes, acta=10, n=41):
    return votes(*[(acta, f"P{i}", i >= 38, 5 if i < 36 else 10 if i == 38 else 0) for i in range(n)])


def test_level_one_passes_on_coherent_data(spark, header, votes):
    head = five(header, totalVotosEmitidos=190, totalVotosValidos=180)
    report = dq.report(head, ballots(votes), level=1)
    assert results(report) == {
        "universe_by_election": "PASS", "detail_rows_per_acta": "PASS", "accounting_identities": "PASS",
        "roll_coherent_by_station": "PASS", "ranges_and_signs": "PASS"}
    assert dq.report_totals(report).first().asDict() == {"pass": 5, "fail": 0, "skip": 0, "total": 5}


def test_level_one_fails_on_each_defect(spark, header, votes):
    head = five(header, totalVotosEmitidos=190, totalVotosValidos=180)
    dup = head.unionByName(head.filter("idEleccion = 10"))
    assert results(dq.check_universe(dup).withColumn("result", F.col("passed")))["universe_by_election"] is False
    short = dq.report(head, ballots(votes, n=40), level=1)
    assert results(short)["detail_rows_per_acta"] == "FAIL"
    wrong = five(header, totalVotosEmitidos=191, totalVotosValidos=180)
    assert results(dq.report(wrong, ballots(votes), level=1))["accounting_identities"] == "FAIL"
    over = five(header, totalVotosEmitidos=301)
    assert results(dq.report(over, ballots(votes), level=1))["ranges_and_signs"] == "FAIL"
    rolls = head.withColumn("totalElectoresHabiles", F.col("idEleccion"))
    assert results(dq.report(rolls, ballots(votes), level=1))["roll_coherent_by_station"] == "FAIL"
    mixed = head.withColumn("totalElectoresHabiles", F.when(F.col("idEleccion") > 10, F.lit(300)))
    assert results(dq.report(mixed, ballots(votes), level=1))["roll_coherent_by_station"] == "FAIL"


def test_level_three_needs_an_enriched_header(spark, header, votes):
    with pytest.raises(ContractError, match="enrich"):
        dq.report(five(header).drop("idDistritoElectoral"), ballots(votes), level=3)
    odd = five(header, idDistritoElectoral=27)
    assert results(dq.report(odd, ballots(votes), level=3)) == {
        "scope_matches_district": "FAIL", "universe_abroad": "FAIL"}


def test_level_four_skips_without_publication(spark, header, votes):
    assert set(results(dq.report(five(header), ballots(votes), level=4)).values()) == {"SKIP"}
    official = ballots(votes).filter("NOT es_especial").select(
        "idEleccion", "ubigeoDistrito", "ccodigo", F.col("nvotos").alias("votos"))
    head = five(header)
    assert set(results(dq.report(head, ballots(votes), official=official, level=4)).values()) == {"PASS"}
    off = official.withColumn("votos", F.col("votos") + 2)
    assert results(dq.report(head, ballots(votes), official=off, level=4))["reconciliation"] == "FAIL"


def test_stale_and_newest_aggregates(spark, header, votes):
    head = five(header)
    totals = spark.createDataFrame(
        [(e, ts, n, 200, 180) for e in (10, 12, 13, 14, 15) for ts, n in ((1, 9), (2, 1))],
        "idEleccion bigint, snapshot_ts_ms bigint, totalActas bigint, totalVotosEmitidos bigint, "
        "totalVotosValidos bigint")
    got = results(dq.report(head, ballots(votes), {"totales": totals}, level=2))
    assert got == {"actas_by_election": "PASS", "presidential_votes_drift": "PASS"}


def test_unmatched_official_rows_fail(spark, header, votes):
    parties = spark.createDataFrame(
        [(10, 1, f"{i:08d}", 5) for i in range(36)] + [(10, 1, "00000099", 1)],
        "idEleccion bigint, snapshot_ts_ms bigint, codigoAgrupacionPolitica string, totalVotosValidos bigint")
    found = dq.check_parties(ballots(votes), parties).first()
    assert (found.passed, found.detail) == (False, "matched=36/37 drift_pct=0.0")
    good = dq.check_parties(ballots(votes), parties.filter("codigoAgrupacionPolitica < '00000099'")).first()
    assert good.passed


def test_reread_buckets(spark):
    missing = spark.createDataFrame([(i, "m", "u", 10, "D") for i in range(1, 6)],
                                    "idActa bigint, codigoMesa string, ubigeoDistrito string, idEleccion bigint, estadoActa string")
    docs = spark.createDataFrame(
        [(1, True, [1], "C", "D", None), (2, True, None, "C", "N", "s"), (3, True, [], "P", "D", None),
         (4, False, None, None, None, None)],
        "req_acta_id bigint, parsed boolean, detalle array<int>, codigoEstadoActa string, estadoActa string, "
        "descripcionSubEstadoActa string")
    got = {r.idActa: r.bucket for r in dq.classify_reread(missing, docs).collect()}
    assert got == {1: "resolved", 2: "mesa_no_instalada", 3: "other", 4: "error", 5: "error"}
