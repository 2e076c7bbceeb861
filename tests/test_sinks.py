from __future__ import annotations

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from scrutiny.plans import export
from scrutiny.sinks import tables as sinks
from scrutiny.sources import files


def test_replace_a_table_that_is_being_read(spark, lake):
    sinks.write_table(spark.range(10).toDF("x"), lake)
    sinks.replace_table(spark.read.parquet(lake).filter("x < 4"), lake)
    sinks.replace_table(spark.read.parquet(lake).withColumn("x", F.col("x") + 1), lake)
    assert sorted(r.x for r in spark.read.parquet(lake).collect()) == [1, 2, 3, 4]
    assert os.listdir(os.path.dirname(lake)) == ["lake"]


def test_verified_write_counts(spark, lake):
    assert sinks.verified_write(spark.range(7).toDF("x"), lake) == 7


def test_a_replayed_batch_replaces_itself(spark, lake):
    from scrutiny.operators.contract_checks import conform

    df = conform(spark.range(3).select(F.col("id").alias("idActa")), "actas_archivos")
    for _ in range(2):
        sinks.write_run({"actas_archivos": df}, lake, 1_700_000_000_000, batch_id=4)
    sinks.write_run({"actas_archivos": df}, lake, 1_700_000_000_000, batch_id=5)
    assert spark.read.parquet(f"{lake}/actas_archivos").count() == 6


def test_manifest_and_checksums(spark, tmp_path):
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "a.csv").write_bytes(b"hola")
    (tmp_path / "README.md").write_bytes(b"x" * 10)
    (tmp_path / "CHECKSUMS.txt").write_bytes(b"old")
    manifest = files.file_manifest(spark, str(tmp_path))
    rows = [tuple(r) for r in export.checksum_manifest(manifest).collect()]
    assert rows == [(hashlib.sha256(b"x" * 10).hexdigest(), "README.md"),
                    (hashlib.sha256(b"hola").hexdigest(), "csv/a.csv")]
    summary = {r.folder: (r.files, r.bytes) for r in export.package_summary(manifest).collect()}
    assert summary == {".": (2, 13), "csv": (1, 4), "total": (3, 17)}


def test_release_refuses_missing_tables(spark, lake):
    sinks.write_dim(spark.range(1).toDF("x"), f"{lake}/curated", "actas_cabecera")
    with pytest.raises(export.IncompleteRelease, match="curated/actas_votos"):
        export.assemble_release(spark, lake, f"{lake}/out")
    for layer, name in (("curated", "actas_votos"), ("dim", "mesas"), ("dim", "distritos_electorales")):
        sinks.write_dim(spark.range(1).toDF("x"), f"{lake}/{layer}", name)
    names = sorted(p.rsplit("/", 1)[1] for p in export.assemble_release(spark, lake, f"{lake}/out"))
    assert names == ["actas_cabecera", "actas_votos", "dim_distritos_electorales", "dim_mesas"]
    assert export.missing_required(export.release_plan(spark, lake)).count() == 0


def test_unreadable_ledger_lines_are_left_out(spark, tmp_path):
    (tmp_path / "l.json").write_text(
        '{"run_ts_ms": 1, "batch_id": 0, "expected": 4, "ok": 2, "empty": 0, "failed": 0}\nnot json\n{}\n')
    assert files.read_ledger(spark, str(tmp_path)).count() == 1


def test_csv_export_sizes(spark, lake):
    df = spark.range(1000).select(F.lit("x" * 50).alias("a"))
    plain, packed = sinks.write_csv(df, f"{lake}/p"), sinks.write_csv(df, f"{lake}/g", "gzip")
    assert packed < plain / 10
    assert files.read_csv_typed(spark, f"{lake}/g").count() == 1000
