"""Runs and ledgers, logs with a compacted base, late rows, commits, one parse, clustered tables."""

from __future__ import annotations

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from scrutiny.operators.versions import keep_runs, latest_runs
from scrutiny.plans import curate, ingest as ingest_plans
from scrutiny.sinks import clustered, commits
from scrutiny.sinks import tables as sinks
from scrutiny.sources import documents, files, pages, tables
from scrutiny.streaming import common, ingest, late, log, merged, progress
from tests.test_documents import BODIES, landed

RUN, LATER = 1_700_000_000_000, 1_700_000_900_000


def body(acta: int, state: str) -> dict:
    return {"id": acta, "codigoMesa": f"{acta:06d}", "idEleccion": 10, "codigoEstadoActa": state}


def run(spark, tmp_path, run_ts: int, docs: list, volatile=None):
    rows = [(acta, acta, "140101", 5, d if isinstance(d, str) else json.dumps(d)) for acta, d in docs]
    spark.createDataFrame(rows, ingest.LANDED_DDL).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
    query = ingest.ingest_stream(
        spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck", run_ts, volatile=volatile)
    common.run_available(query)
    return query


def header(spark, tmp_path):
    return spark.read.parquet(f"{tmp_path}/out/actas_cabecera")


def last_states(spark, tmp_path) -> dict:
    rows = header(spark, tmp_path)
    return {r.idActa: (r.codigoEstadoActa, r.run_ts_ms)
            for r in keep_runs(rows, latest_runs(rows)).collect()}


# --- runs ----------------------------------------------------------------------


def test_a_second_run_on_one_checkpoint_brings_newer_documents(spark, tmp_path):
    query = run(spark, tmp_path, RUN, [(1, body(1, "P")), (2, body(2, "C")), (3, "<html>")])
    assert not any(p.get("stateOperators") for p in query.recentProgress)  # no state at all
    run(spark, tmp_path, LATER, [(1, body(1, "C")), (3, body(3, "P"))])
    assert last_states(spark, tmp_path) == {1: ("C", LATER), 2: ("C", RUN), 3: ("P", LATER)}
    assert header(spark, tmp_path).count() == 4  # both versions of acta 1
    assert tuple(ingest.run_accounting(spark, f"{tmp_path}/out", RUN).first()) == (2, 0, 1)
    assert tuple(ingest.run_accounting(spark, f"{tmp_path}/out", LATER).first()) == (2, 0, 0)


def test_inside_a_run_an_acta_is_done_once_it_could_be_read(spark, tmp_path):
    run(spark, tmp_path, RUN, [(1, "<html>"), (1, body(1, "P")), (2, "<html>"), (2, "<html>")])
    run(spark, tmp_path, RUN, [(1, body(1, "C")), (2, "<html>"), (2, body(2, "E"))])
    run(spark, tmp_path, RUN, [(2, body(2, "C")), (1, "<html>")])
    assert last_states(spark, tmp_path) == {1: ("P", RUN), 2: ("E", RUN)}
    assert spark.read.parquet(f"{tmp_path}/out/_quarantine").count() == 1
    assert tuple(ingest.run_accounting(spark, f"{tmp_path}/out", RUN).first()) == (2, 0, 0)


def test_a_refresh_takes_volatile_actas_only(spark, tmp_path):
    run(spark, tmp_path, RUN, [(1, body(1, "P")), (2, body(2, "C"))])
    volatile = header(spark, tmp_path).where("codigoEstadoActa IN ('P', 'E')").select("idActa")
    run(spark, tmp_path, LATER, [(1, body(1, "C")), (2, body(2, "P"))], volatile)
    assert last_states(spark, tmp_path) == {1: ("C", LATER), 2: ("C", RUN)}


def test_the_newest_readable_document_of_a_batch_counts(spark):
    rows = [(1, 1, "x", ts, json.dumps(body(1, s))) for ts, s in ((5, "P"), (9, "C"), (7, "E"))]
    rows += [(None, 1, "x", 5, json.dumps(body(4, "P")))] * 2 + [(2, 2, "x", None, "{bad")]
    best = ingest.best_documents(documents.parse_documents(
        spark.createDataFrame(rows, ingest.LANDED_DDL)))
    assert sorted((str(r.req_acta_id), r.codigoEstadoActa) for r in best.collect()) == [
        ("1", "C"), ("2", None), ("None", "P"), ("None", "P")]


# --- merge on read -------------------------------------------------------------

DDL = "idActa bigint, run_ts_ms bigint, x string"


def versions(spark, path):
    return sorted(map(tuple, merged.read_merged(spark, path, DDL).collect()))


def test_merge_on_read_equals_the_batch_before_and_after_compaction(spark, tmp_path):
    path = str(tmp_path / "table")
    parts = [[(1, 5, "a"), (1, 5, "b"), (2, 7, "c"), (3, 1, "d"), (None, 1, "no key"), (9, None, "no run")],
             [(1, 4, "old"), (2, 8, "e"), (2, 8, "f")], [(1, 5, "tie"), (4, 1, "g")], []]
    frames = [spark.createDataFrame(p, DDL) for p in parts]
    for i, frame in enumerate(frames):
        merged.append_facts(frame, i, path)
    whole = spark.createDataFrame(sum(parts, []), DDL).where("idActa IS NOT NULL AND run_ts_ms IS NOT NULL")
    want = sorted(map(tuple, keep_runs(whole, latest_runs(whole)).collect()))
    assert versions(spark, path) == want
    merged.compact(spark, path, DDL)
    assert versions(spark, path) == want and log.mark(spark, f"{path}/facts") == 3
    merged.append_facts(frames[2], 2, path)  # a replay of a batch that the base holds
    assert versions(spark, path) == want
    merged.append_facts(spark.createDataFrame([(3, 2, "new")], DDL), 4, path)
    assert versions(spark, path) == sorted([r for r in want if r[0] != 3] + [(3, 2, "new")])


def test_a_batch_of_one_key_touches_its_own_files_only(spark, tmp_path):
    path = str(tmp_path / "table")

    def listing():
        return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f))
                for d, _, names in os.walk(path) for f in names}

    merged.append_facts(spark.range(500).selectExpr("id AS idActa", "1L AS run_ts_ms", "'a' AS x"), 0, path)
    merged.compact(spark, path, DDL)
    before = listing()
    merged.append_facts(spark.createDataFrame([(7, 2, "b")], DDL), 1, path)
    after = listing()
    assert all(after[f] == t for f, t in before.items())
    assert all("batch_id=1" in f for f in set(after) - set(before))


def test_a_stream_compacts_and_its_log_stays_short(spark, tmp_path):
    for i in range(13):
        spark.createDataFrame([(i % 4, i, str(i))], DDL).coalesce(1).write.mode("append").parquet(
            f"{tmp_path}/in")
    source = common.file_stream(spark, f"{tmp_path}/in", DDL, max_files=1)
    common.run_available(merged.merged_stream(source, f"{tmp_path}/t", f"{tmp_path}/ck", every=3))
    assert [r[:2] for r in versions(spark, f"{tmp_path}/t")] == [(0, 12), (1, 9), (2, 10), (3, 11)]
    assert len(log.batches(spark, f"{tmp_path}/t/facts")) <= 6
    assert len([n for n in os.listdir(f"{tmp_path}/t/facts/base") if n.startswith("data-")]) <= 2


# --- late rows -----------------------------------------------------------------


def snapshots(spark, rows):
    return spark.createDataFrame(rows, "idEleccion bigint, seconds bigint, contabilizadas bigint").select(
        "idEleccion", F.timestamp_seconds("seconds").cast("timestamp_ntz").alias("snapshot_ts"),
        "contabilizadas", F.lit(9).cast("bigint").alias("totalActas"), F.lit(0.5).alias("pct"))


def rows_of(frame):
    return sorted(map(str, frame.select(*KEYS, "contabilizadas", "totalActas", "pct", "n").collect()))


KEYS = late.KEYS
T0 = 1_700_000_000


def test_rows_three_hours_late_count_in_their_windows(spark, tmp_path):
    on_time = [(10 + i % 2, T0 + i * 300, i) for i in range(100)]
    behind = [(10, T0 + 97 * 300 - 3 * 3600 + i, 1000 + i) for i in range(5)] + [(11, T0 - 900, 7)]
    path = str(tmp_path / "t")
    for i, part in enumerate((on_time[:60], on_time[60:], behind)):
        late.store_batch(snapshots(spark, part), i, path, every=2)
    whole = progress.progress_windows(snapshots(spark, on_time + behind))
    assert rows_of(late.read_windows(spark, path)) == rows_of(whole)
    assert late.late_rows(spark, path).count() == len(behind)
    late.store_batch(snapshots(spark, behind), 2, path, every=2)  # replayed
    assert rows_of(late.read_windows(spark, path)) == rows_of(whole)
    assert late.late_rows(spark, path).count() == len(behind)


def test_repeated_snapshots_collapse_however_late(spark, tmp_path):
    path, rows = str(tmp_path / "t"), [(10, T0 + i * 60, i) for i in range(50)]
    for i, part in enumerate((rows, rows[:10] + rows[:5], [], rows + [(10, T0 - 86400 * 9, 99)])):
        late.store_batch(snapshots(spark, part), i, path, unique=("idEleccion", "snapshot_ts"))
    assert late.read_snapshots(spark, path).count() == 51
    assert late.read_windows(spark, path).agg(F.sum("n")).first()[0] == 51


# --- commits -------------------------------------------------------------------


def test_only_a_committed_version_is_read(spark, lake):
    commits.publish(spark.range(3), lake)
    (folder,) = (n for n in os.listdir(lake) if n.startswith("data-"))
    spark.range(99).write.parquet(f"{lake}/data-left-behind")  # killed before its pointer
    with open(f"{lake}/_commits/000000000007.json", "w") as f:
        f.write('{"folder": "data-le')  # killed while writing it
    assert commits.read_current(spark, lake).count() == 3
    doubled = commits.read_current(spark, lake).union(spark.range(2))
    assert commits.publish(doubled, lake) == 8  # reads what it replaces
    assert commits.read_current(spark, lake).count() == 5
    assert os.path.isdir(f"{lake}/{folder}")  # readers of the old version go on
    commits.publish(spark.range(1), lake)
    assert set(commits.vacuum(spark, lake, keep=2)) == {folder, "data-left-behind"}
    assert commits.read_current(spark, lake).count() == 1


def test_of_two_writers_one_fails(spark, lake, monkeypatch):
    commits.publish(spark.range(1), lake)
    monkeypatch.setattr(commits, "_pointers", lambda *a: [0])  # has not seen the other's commit
    with pytest.raises(Exception, match="(?i)exist"):
        commits.publish(spark.range(2), lake)


def test_a_killed_migration_is_finished_by_the_next(spark, lake):
    good = spark.range(4).selectExpr("id AS idActa", "'2026' AS snapshot_date", "1L AS run_ts_ms")
    good.write.partitionBy("snapshot_date", "run_ts_ms").parquet(lake)
    fixed = good.withColumn("x", F.lit("fixed"))
    commits.publish(fixed, f"{lake}.migration", ("snapshot_date", "run_ts_ms"),
                    keys=["snapshot_date", "run_ts_ms"], ddl=fixed.schema.json())
    shutil.rmtree(f"{lake}/snapshot_date=2026")  # killed in the middle of the swap
    sinks.migrate_null_types(spark, lake, dry_run=False)
    assert spark.read.parquet(lake).where("x = 'fixed'").count() == 4
    assert not os.path.exists(f"{lake}.migration")


def test_a_snapshot_appended_again_is_there_once(spark, lake):
    one = spark.createDataFrame([(10, RUN), (11, RUN)], "idEleccion bigint, snapshot_ts_ms bigint")
    for frame in (one, one, one.withColumn("snapshot_ts_ms", F.col("snapshot_ts_ms") + 1)):
        path = sinks.append_snapshot(frame, lake, "totales")
    assert tables.read_series(spark, path).count() == 4
    newest = tables.read_newest(spark, path)
    assert newest.select("snapshot_ts_ms").distinct().collect()[0][0] == RUN + 1
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and len(newest.inputFiles()) <= len(
        spark.read.parquet(path).inputFiles())
    scanned = newest._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scanned.selectedPartitions().partitionCount() == 1


# --- one parse, clustered tables, lossless types ---------------------------------


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().toString()


def test_documents_are_parsed_once_for_all_tables(spark, tmp_path):
    raw = landed(spark, extra=[(6, "<html>")])
    staged = documents.stage_documents(raw, str(tmp_path / "parsed"))
    direct = ingest_plans.flatten_documents(documents.parse_documents(raw).filter("parsed"))
    for name, frame in ingest_plans.flatten_documents(staged.filter("parsed")).items():
        assert "from_json" not in plan_of(frame)
        assert sorted(map(str, frame.collect())) == sorted(map(str, direct[name].collect()))
    ledger = ingest_plans.ingest_run(raw, str(tmp_path / "base"), RUN, 9)
    assert ledger.first().failed == 1
    assert spark.read.parquet(f"{tmp_path}/base/actas_cabecera").count() == direct["actas_cabecera"].count()


def test_aggregates_are_parsed_once_for_all_tables(spark, tmp_path):
    payloads = {
        "totales": ['{"totalActas": 5, "contabilizadas": "7", "actasContabilizadas": 1.5}', None, "{broken", "[]"],
        "mapa_calor": ['[{"actasContabilizadas": 12, "ubigeoNivel01": 10000}, {"actasContabilizadas": null}]'],
        "participantes_de": ['[{"codigoAgrupacionPolitica": "00000007", "totalVotosValidos": 3}]'],
        "unknown": ['{"id": 1}'],
    }
    rows = [(t, 10, 3, RUN, p) for t, ps in payloads.items() for p in ps]
    raw = spark.createDataFrame(rows, "table_name string, idEleccion bigint, idDistritoElectoral bigint, "
                                      "snapshot_ts_ms bigint, payload string")
    documents.stage_aggregates(raw, str(tmp_path / "staged"))
    staged = documents.staged_aggregate_tables(spark, str(tmp_path / "staged"))
    for name, want in documents.aggregate_tables(raw).items():
        assert staged[name].dtypes == want.dtypes and "from_json" not in plan_of(staged[name])
        assert sorted(map(str, staged[name].collect())) == sorted(map(str, want.collect()))


def test_clustered_tables_join_without_a_shuffle(spark, tmp_path):
    votes = spark.range(4000).selectExpr(
        "id % 100 AS idActa", "10L AS idEleccion", "'140101' AS ubigeoDistrito", "'x' AS descripcion",
        "'1' AS ccodigo", "false AS es_especial", "id AS nvotos")
    context = spark.range(100).selectExpr(
        "id AS idActa", "'m' AS codigoMesa", "1L AS idAmbitoGeografico", "1L AS idDistritoElectoral",
        "'14' AS ubigeoDepartamento", "'1401' AS ubigeoProvincia", "'d' AS nombreDistrito",
        "'C' AS codigoEstadoActa", "1L AS totalVotosEmitidos", "1L AS totalVotosValidos",
        "1L AS totalElectoresHabiles")
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        a = clustered.write_clustered(votes, "t_votes", f"{tmp_path}/votes", buckets=8)
        clustered.write_clustered(context, "t_context", f"{tmp_path}/context", buckets=8)
        b = clustered.attach_clustered(spark, "t_context", f"{tmp_path}/context", context.schema, buckets=8)
        tidy = curate.tidy_votes(a, b)
        assert tidy.count() == 4000
        assert "Exchange" not in tidy._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        for name in ("t_votes", "t_context"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_types_give_every_value_back(spark, tmp_path):
    columns = {
        "code": ["007", "012"], "money": ["0.10", "12.00"], "mixed": ["9007199254740993", "1.5"],
        "float": ["1.5", "2"], "int": ["-3", "0"], "minus": ["-0", "1"], "plus": ["+1", "2"],
        "uneven": ["0.10", "1.5"], "flag": ["true", "false"], "Flag": ["True", "false"], "exp": ["1e3", "2"],
        "wide": ["1" * 40, "2"], "none": ["", ""],
    }
    path = tmp_path / "x.csv"
    path.write_text(",".join(f"{n}{i}" for i, n in enumerate(columns)) + "\n" + "\n".join(
        ",".join(v[r] for v in columns.values()) for r in range(2)) + "\n")
    frame = files.read_official_csv(spark, str(path))
    kinds = {n.rstrip("0123456789"): k for n, k in frame.dtypes}
    assert [kinds[n] for n in ("code", "money", "mixed", "float", "int", "minus", "plus", "uneven", "flag",
                               "Flag", "exp", "wide", "none")] == [
        "string", "decimal(4,2)", "decimal(17,1)", "double", "bigint", "string", "string", "string",
        "boolean", "string", "string", "string", "string"]
    shown = frame.select(*[F.col(c).cast("string") for c in frame.columns]).collect()
    assert sorted(r[0] for r in shown) == ["007", "012"] and sorted(r[1] for r in shown) == ["0.10", "12.00"]
    assert {r[2] for r in shown} == {"9007199254740993.0", "1.5"}


@pytest.mark.parametrize("text, good", [
    ('{"a":1}', True), (' {"a":1} \n', True), ('{"a":1} xx', False), ('{"a":1}, 2', False),
    ('{"a":1}{"b":2}', False), ('{"a":1}]', False), ('{"a":', False), ("[1, 2]", True), ("1], [2", False),
    ("null", True), ("", False)])
def test_json_is_one_value_and_nothing_else(spark, text, good):
    assert spark.createDataFrame([(text,)], "t string").select(pages.is_json(F.col("t"))).first()[0] is good


def test_an_address_is_reported_once_over_a_hundred_batches(spark, tmp_path):
    from scrutiny.streaming import alerts

    ddl = "page_id bigint, title string, url string"
    previous = spark.createDataFrame([(0, "old", "/old")], ddl)
    path, want = str(tmp_path / "t"), []
    for i in range(12):
        rows = [(i, f"t{i}", f"/{i // 2}"), (100 + i, "again", "/0"), (i, "old", "/old"), (i, "none", None)]
        alerts.alert_batch(spark.createDataFrame(rows, ddl), i, path, previous, every=3)
        want += [(i, f"/{i // 2}")] if i % 2 == 0 else []
        if i in (4, 9):  # replayed
            alerts.alert_batch(spark.createDataFrame(rows, ddl), i, path, previous, every=3)
        assert len(log.batches(spark, f"{path}/known")) <= 6  # files read stay the same
    found = alerts.read_alerts(spark, path, ddl + ", matches boolean").collect()
    assert sorted((r.page_id, r.url) for r in found) == want
