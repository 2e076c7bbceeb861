"""Plans have the shape that holds at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from scrutiny.harness.fixtures import Tables
from scrutiny.operators import filters, versions
from scrutiny.plans import anomalies, curate, dq, export, ingest
from scrutiny.session import scratch_path
from scrutiny.sinks.tables import write_table
from scrutiny.sources.documents import parse_documents


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    """Header and votes as stored tables, the way jobs read them."""
    t = Tables(spark, "/root/testdata/sf0.001")
    out = {}
    for name in ("cab", "votos"):
        path = scratch_path(spark, f"plan-{name}")
        write_table(t(name), path)
        out[name] = spark.read.parquet(path)
    return out


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_last_run_is_one_aggregate_and_one_semi_join(stored, no_broadcast):
    text = plan(versions.keep_runs(stored["votos"], versions.latest_runs(stored["votos"])))
    assert "LeftSemi" in text and "Window" not in text
    assert "partial_max(run_ts_ms" in text


def test_filters_and_columns_reach_both_scans(stored):
    df = export.export_long(stored["votos"], stored["cab"],
                            filters.selection(elections=[10], state="C")).select(
        "idActa", "partido", "nvotos")
    text = plan(df)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(codigoEstadoActa,C\)", text)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(idEleccion,10\)", text) or "In(idEleccion" in text
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert all(s.count(":") <= 4 for s in schemas), schemas


def test_acta_rules_read_each_table_once(stored):
    text = plan(anomalies.detect_acta_rules(stored["cab"], stored["votos"]))
    assert text.count("FileScan parquet") == 2


def test_enrichment_has_no_python_and_one_join(spark, stored):
    mesas = Tables(spark, "/root/testdata/sf0.001")("mesas")
    text = plan(curate.enrich_header(stored["cab"], mesas))
    assert "Python" not in text and len(re.findall(r"Join ", text)) == 1


def test_documents_are_parsed_once(spark):
    landed = spark.createDataFrame([], "req_acta_id bigint, req_id_mesa bigint, req_ubigeo string, "
                                   "snapshot_ts_ms bigint, body string")
    path = scratch_path(spark, "landed")
    landed.write.parquet(path)
    votes = ingest.flatten_documents(parse_documents(spark.read.parquet(path)).filter("parsed"))
    assert plan(votes["actas_votos"]).count("from_json(") == 1


def test_a_hot_key_is_split(spark, tmp_path, no_broadcast):
    """One acta with a third of all rows: its partition is split, the result is whole."""
    rows = spark.range(600_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000 + 1).alias("idActa"),
        F.lit(7).cast("bigint").alias("run_ts_ms"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    path = str(tmp_path / "hot")
    rows.repartition(16).write.parquet(path)
    facts = spark.read.parquet(path)
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        kept = versions.keep_runs(facts, versions.latest_runs(facts))
        assert len(kept.collect()) == 600_000
        assert "skew=true" in plan(kept)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_last_record_and_winner_on_a_hot_key(spark):
    rows = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97).alias("k"),
        (F.col("id") % 1000).alias("snapshot_ts_ms"), F.col("id").alias("v"))
    got = {r.k: (r.snapshot_ts_ms, r.v) for r in versions.last_record(rows, ["k"]).collect()}
    brute: dict = {}
    for i in range(90_000):
        key = 0 if i % 3 == 0 else i % 97
        brute[key] = max(brute.get(key, (-1, -1)), (i % 1000, i))
    assert got == brute


def test_the_report_reads_votes_through_two_cubes(stored):
    cab, votes = stored["cab"], stored["votos"]
    files = set(votes.inputFiles())
    official = votes.filter("NOT es_especial").groupBy("idEleccion", "ubigeoDistrito", "ccodigo").agg(
        F.sum("nvotos").alias("votos"))
    parties = votes.groupBy("idEleccion", F.lit(1).cast("bigint").alias("snapshot_ts_ms"),
                            F.col("ccodigo").alias("codigoAgrupacionPolitica")).agg(
        F.sum("nvotos").alias("totalVotosValidos"))
    assert plan(dq.acta_cube(votes)).count("FileScan parquet") == 1
    assert len(set(dq.place_cube(votes, cab).inputFiles()) & files) == len(files)
    report = dq.report(cab, votes, level=1)
    assert not set(report.inputFiles()) & files  # only the stored cubes
    two = cab.unionByName(cab.limit(5))  # some actas stand twice in the header
    acta, place = dq.acta_cube(votes), dq.place_cube(votes, two)
    for with_cube, direct in (
        (dq.check_votes(votes, cab, acta), dq.check_votes(votes, cab)),
        (dq.check_parties(votes, parties, acta), dq.check_parties(votes, parties)),
        (dq.reconcile_with_official(votes, two, official, place),
         dq.reconcile_with_official(votes, two, official)),
    ):
        assert sorted(map(str, with_cube.collect())) == sorted(map(str, direct.collect()))
    by_district = parties.withColumn("idDistritoElectoral", F.lit(15).cast("bigint"))
    assert sorted(map(str, dq.party_drift_by_district(votes, two, by_district, place).collect())) == sorted(
        map(str, dq.party_drift_by_district(votes, two, by_district).collect()))


def test_distinct_actas_need_no_shuffle_of_their_own(stored, no_broadcast):
    text = plan(export.export_district_summary(stored["votos"], stored["cab"]))
    exchanges = re.findall(r"Exchange (\w+)\(([^\n]*)", text)
    assert "Expand" not in text
    # One for each side of the join; the counts by place come after a partial count.
    assert sum(kind == "hashpartitioning" and keys.startswith("idActa#") for kind, keys in exchanges) == 2
    assert not any("idActa#" in keys.split(", ENSURE")[0] for kind, keys in exchanges
                   if not keys.startswith("idActa#"))
