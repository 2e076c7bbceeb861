"""What grew faster than its input in the third round: joins, landings, series, deliveries."""

from __future__ import annotations

import math
import os

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from scrutiny.functions import scalars
from scrutiny.harness import landing, logs
from scrutiny.operators import versions
from scrutiny.plans import export
from scrutiny.sinks import tables as sinks
from scrutiny.sources import documents, tables
from scrutiny.streaming import ingest

RUN = 1_700_000_000_000
DAY = 86_400_000


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_keys_of_actas_are_not_broadcast(spark):
    facts = spark.range(9).selectExpr("id % 3 AS idActa", "id AS run_ts_ms")
    kept = versions.keep_runs(facts, versions.latest_runs(facts))
    assert sorted(r[1] for r in kept.collect()) == [6, 7, 8] and "Broadcast" not in plan_of(kept)
    landed = spark.range(4).selectExpr("id AS req_acta_id")
    again = ingest.refresh_stream(landed, spark.range(2, 9).selectExpr("id AS idActa"))
    assert sorted(r[0] for r in again.collect()) == [2, 3] and "Broadcast" not in plan_of(again)


def test_documents_without_a_key_are_parsed_once(spark):
    raw = spark.createDataFrame(
        [(1, 1, "14", 5, "{}"), (1, 1, "14", 9, "x"), (2, 1, "14", 5, "x"), (3, 1, "14", 5, "{}"),
         (None, 1, "14", 5, "{}"), (None, 1, "14", 5, "{}"), (4, 1, "14", 5, "x")], ingest.LANDED_DDL)
    done = spark.createDataFrame(
        [(2, "failed"), (3, "ok"), (4, "failed"), (4, "empty"), (9, "ok")],
        "req_acta_id bigint, outcome string")
    parsed = documents.parse_documents(raw)
    best = ingest.best_documents(parsed)
    assert best.columns == parsed.columns
    assert best.explain() is None and plan_of(best).count("Generate inline") <= 1

    def keys(frame):
        return sorted((r["req_acta_id"] or 0, r["parsed"]) for r in frame.collect())

    assert keys(best) == [(0, True), (0, True), (1, True), (2, False), (3, True), (4, False)]
    assert keys(ingest.best_documents(parsed, done)) == [(0, True), (0, True), (1, True)]


def test_a_ratio_over_zero_is_no_error(spark):
    rows = spark.createDataFrame(
        [(1, 3, 0), (2, 0, 0), (3, -3, 0), (4, None, 0), (5, 1, 4), (6, 1, None)],
        "id bigint, a bigint, b bigint")
    found = dict(rows.select("id", scalars.ratio(F.col("a") * F.lit(1.0), F.col("b"))).collect())
    assert math.isnan(found.pop(2))
    assert found == {1: math.inf, 3: -math.inf, 4: None, 5: 0.25, 6: None}
    clipped = rows.where("id <= 3").select(
        scalars.clipped_pct(scalars.ratio(F.col("a") * F.lit(1.0), F.col("b"))))
    assert [r[0] for r in clipped.collect()] == [100.0, 100.0, -math.inf]


def test_folders_of_a_series_are_days_not_snapshots(spark, lake):
    many = spark.range(500).selectExpr("id", f"{RUN} + id * 1000 AS snapshot_ts_ms")
    path = sinks.append_snapshot(many, lake, "totales")
    assert len([n for n in os.listdir(path) if n.startswith("snapshot_date=")]) == 1
    days = [d for d, _, names in os.walk(path) if any(n.endswith(".parquet") for n in names)]
    assert len(days) == 1
    assert tables.read_series(spark, path).count() == 500


def test_the_last_copy_of_a_snapshot_counts(spark, lake):
    ddl = "id bigint, snapshot_ts_ms bigint"
    first = [(1, RUN), (2, RUN), (3, RUN + 1), (4, RUN + 5 * DAY), (5, None)]
    sinks.append_snapshot(spark.createDataFrame(first, ddl), lake, "totales")
    path = sinks.append_snapshot(spark.createDataFrame([(6, RUN), (7, None)], ddl), lake, "totales")
    rows = tables.read_series(spark, path)
    assert sorted(r["id"] for r in rows.collect()) == [3, 4, 6, 7]
    assert set(rows.columns) == {"id", "snapshot_ts_ms", "snapshot_date"}

    def newest(n):
        return sorted(r["id"] for r in tables.read_newest(spark, path, n).collect())

    assert [newest(n) for n in (1, 2, 3, 9)] == [[4], [3, 4], [3, 4, 6], [3, 4, 6]]


def test_landed_files_are_compressed_and_bounded(spark, tmp_path):
    rows = spark.range(100_001).coalesce(1).selectExpr("id AS req_acta_id", "'{}' AS body")
    landing._land(rows, f"{tmp_path}/in")
    names = [n for n in os.listdir(f"{tmp_path}/in") if n.startswith("part-")]
    assert len(names) == 2 and all(n.endswith(".json.gz") for n in names)
    assert spark.read.schema(ingest.LANDED_DDL).json(f"{tmp_path}/in").count() == 100_001


def test_a_delivery_is_one_batch_of_many_files(spark, tmp_path):
    seen = []

    class Given:
        pass

    t = Given()
    t.spark = spark
    parts = [spark.range(40).repartition(4), spark.range(40, 60).repartition(2)]
    logs._deliver(t, parts, f"{tmp_path}/in", "id bigint", lambda source: source.writeStream.foreachBatch(
        lambda batch, i: seen.append((i, batch.count()))).option(
        "checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start())
    assert seen == [(0, 40), (1, 20)]
    assert len([n for n in os.listdir(f"{tmp_path}/in/part0") if n.endswith(".parquet")]) == 4


def test_a_task_of_the_summary_holds_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(export, "ROWS_PER_TASK", 50)
    votes = spark.range(2000).selectExpr(
        "if(id < 20, null, id div 4) AS idActa", "10L AS idEleccion", "'140101' AS ubigeoDistrito",
        "concat('P', id % 3) AS descripcion", "lpad(id % 3, 8, '0') AS ccodigo", "false AS es_especial",
        "if(id % 9 = 0, null, id) AS nvotos", "0D AS nporcentajeVotosValidos", "0D AS nporcentajeVotosEmitidos")
    header = spark.range(600).selectExpr(
        "if(id = 599, 7, id) AS idActa", "'1' AS codigoMesa", "'L' AS nombreLocalVotacion",
        "if(id % 5 = 0, null, id) AS totalElectoresHabiles", "id AS totalVotosEmitidos",
        "id AS totalVotosValidos", "id AS totalAsistentes", "1D AS porcentajeParticipacionCiudadana",
        "'C' AS codigoEstadoActa", "'140000' AS ubigeoDepartamento", "'140100' AS ubigeoProvincia",
        "if(id % 2 = 0, null, 'LIMA') AS nombreDistrito", "1L AS idAmbitoGeografico",
        "15L AS idDistritoElectoral")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = export.export_district_summary(votes, header)
        plain = export.export_district_summary(votes, header, clustered=True)
        rows = dealt.collect()
        assert rows == plain.collect() and len(rows) == 6 and sum(r["actas"] for r in rows) > 495
        assert plan_of(dealt).count(", 40), REPARTITION_BY_NUM") and "hashpartitioning(idActa" in plan_of(dealt)
        assert "REPARTITION_BY_NUM" not in plan_of(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_of_few_folders_are_written_unsorted(spark, tmp_path, monkeypatch):
    setting, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: (
        seen.append(spark.conf.get(setting, None)), write(self, *a, **b))[1])
    rows = spark.range(900).selectExpr("id", "nullif(id % 50, 49) AS run_ts_ms", "'d' AS snapshot_date")
    sinks.write_by_folder(rows, f"{tmp_path}/facts", "snapshot_date", "run_ts_ms")
    assert seen == ["32"] and spark.conf.get(setting, None) is None
    stored = spark.read.parquet(f"{tmp_path}/facts").select("id", "run_ts_ms", "snapshot_date")
    assert sorted(r["id"] for r in stored.collect()) == list(range(900))  # 50 folders, more than are open at once
    assert not stored.where("NOT run_ts_ms <=> nullif(id % 50, 49)").head(1)
    spark.conf.set(setting, "5")
    try:
        sinks.write_by_folder(rows, f"{tmp_path}/again", "run_ts_ms")
        assert seen[1:] == ["5"] and spark.conf.get(setting) == "5"
    finally:
        spark.conf.unset(setting)
