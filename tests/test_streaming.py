from __future__ import annotations

import json

from pyspark.sql import functions as F

from scrutiny.operators.versions import keep_runs, latest_runs
from scrutiny.streaming import common, curated, ingest, progress
from tests.test_documents import BODIES, TS, landed

RUN = 1_700_000_000_000


def counts(spark, base):
    return {t: spark.read.parquet(f"{base}/{t}").count()
            for t in ("actas_cabecera", "actas_votos", "_quarantine")}


def test_ingest_resumes_and_skips_what_is_done(spark, tmp_path):
    source, base, check = (str(tmp_path / x) for x in ("in", "out", "ck"))
    landed(spark, extra=[(6, "<html>")]).write.json(source)
    common.run_available(ingest.ingest_stream(spark, source, base, check, RUN, 10))
    first = counts(spark, base)
    assert first == {"actas_cabecera": 4, "actas_votos": 83, "_quarantine": 1}
    # Again the same documents, and a good answer for the one that failed.
    better = {"id": 6, "codigoMesa": "000006", "idEleccion": 10, "codigoEstadoActa": "P"}
    landed(spark, [*BODIES, (6, better)]).write.mode("append").json(source)
    common.run_available(ingest.ingest_stream(spark, source, base, check, RUN, 10))
    assert counts(spark, base) == {"actas_cabecera": 5, "actas_votos": 83, "_quarantine": 1}


def test_a_replayed_ingest_batch_changes_nothing(spark, tmp_path):
    from scrutiny.sources.documents import parse_documents

    batch = parse_documents(landed(spark, extra=[(6, "<html>")]))
    base = str(tmp_path / "out")
    for _ in range(2):
        ingest.ingest_batch(batch, 0, base, RUN)
    assert counts(spark, base) == {"actas_cabecera": 4, "actas_votos": 83, "_quarantine": 1}
    assert spark.read.json(f"{base}/_ledger").count() == 1


def merged(spark, path):
    return sorted(map(tuple, curated.read_curated(spark, path).select("idActa", "run_ts_ms", "x").collect()))


def test_continuous_merge_equals_the_batch(spark, tmp_path):
    ddl = "idActa bigint, run_ts_ms bigint, x string"
    batches = [
        spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, 7, "c"), (3, 1, "d")], ddl),
        spark.createDataFrame([(1, 4, "old"), (2, 8, "e"), (2, 8, "f")], ddl),
        spark.createDataFrame([(1, 5, "tie"), (4, 1, "g")], ddl),
    ]
    path = str(tmp_path / "table")
    for i, batch in enumerate(batches):
        curated.merge_batch(batch, i, path, buckets=4)
    whole = batches[0].union(batches[1]).union(batches[2])
    expected = sorted(map(tuple, keep_runs(whole, latest_runs(whole)).collect()))
    assert merged(spark, path) == expected
    # The last batch replayed, as after a failure before its commit.
    curated.merge_batch(batches[2], 2, path, buckets=4)
    assert merged(spark, path) == expected


def test_a_half_replaced_table_is_mended_by_the_replay(spark, tmp_path):
    import shutil

    ddl = "idActa bigint, run_ts_ms bigint, x string"
    path = str(tmp_path / "table")
    curated.merge_batch(spark.createDataFrame([(i, 1, "a") for i in range(40)], ddl), 0, path, buckets=4)
    newer = spark.createDataFrame([(i, 2, "b") for i in range(20)], ddl)
    curated.merge_batch(newer, 1, path, buckets=4)
    expected = merged(spark, path)
    shutil.rmtree(f"{path}/bucket=1")
    curated.merge_batch(newer, 1, path, buckets=4)
    assert merged(spark, path) == expected


def test_progress_stream_equals_batch(spark, tmp_path):
    rows = spark.range(500).select(
        (F.lit(10) + F.col("id") % 3).alias("idEleccion"),
        (F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 37)).alias("snapshot_ts"),
        F.col("id").alias("contabilizadas"), F.lit(9).cast("bigint").alias("totalActas"),
        (F.col("id") / 7).alias("pct"))
    source = str(tmp_path / "in")
    rows.repartition(4).write.parquet(source)
    stream = common.file_stream(spark, source, rows.schema, max_files=10)
    common.run_available(progress.write_updates(
        progress.progress_windows(stream), str(tmp_path / "out"), str(tmp_path / "ck")))
    got = common.newest_per_key(spark, str(tmp_path / "out"), ["window_start", "idEleccion"])
    batch = progress.progress_windows(rows)
    assert sorted(map(str, got.select(*batch.columns).collect())) == sorted(map(str, batch.collect()))


def test_refresh_only_lets_volatile_actas_through(spark, tmp_path):
    source = str(tmp_path / "in")
    landed(spark).write.json(source)
    stream = common.file_stream(spark, source, ingest.LANDED_DDL, "json")
    volatile = spark.createDataFrame([(2,), (3,), (3,)], "idActa bigint")
    common.run_available(progress.append_stream(
        ingest.refresh_stream(stream, volatile), str(tmp_path / "out"), str(tmp_path / "ck")))
    assert sorted(r.req_acta_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [2, 3]


def test_an_address_is_reported_once(spark, tmp_path):
    from scrutiny.streaming import common, progress

    ddl = "page_id bigint, position bigint, title string, url string"
    previous = spark.createDataFrame([(0, 0, "old", "/old")], ddl)
    deliveries = [[(1, 0, "Uno", "/1"), (2, 0, "Uno otra vez", "/1"), (3, 0, "viejo", "/old")],
                  [(4, 0, "Uno tarde", "/1"), (5, 0, "Dos", "/2")]]
    for rows in deliveries:
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = common.file_stream(spark, f"{tmp_path}/in", ddl)
        common.run_available(progress.monitor_stream(
            source, previous, f"{tmp_path}/out", f"{tmp_path}/ck"))
    out = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted((r.page_id, r.url) for r in out) == [(1, "/1"), (5, "/2")]
