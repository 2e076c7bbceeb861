from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from scrutiny import contracts as c
from scrutiny.operators.contract_checks import conform
from scrutiny.plans import curate
from scrutiny.plans.ingest import task_universe
from scrutiny.operators import keys
from scrutiny.sinks import tables as sinks
from scrutiny.sources import tables as sources

MESAS = "idMesa bigint, ubigeoDistrito string, idAmbitoGeografico bigint, " \
    "ubigeoDepartamento string, ubigeoProvincia string, nombreDistrito string"


def write(spark, base, table, run, rows, ddl):
    df = conform(spark.createDataFrame(rows, ddl), table)
    sinks.write_run({table: df}, base, run)


def facts(spark, base):
    head = "idActa bigint, idMesaRef bigint, ubigeoDistrito string, codigoEstadoActa string"
    vote = "idActa bigint, descripcion string, es_especial boolean, nvotos bigint"
    r1, r2, r3 = 1_700_000_000_000, 1_700_000_100_000, 1_700_100_000_000
    write(spark, base, "actas_cabecera", r1, [(1, 1, "140101", "P"), (2, 2, "140101", "E")], head)
    write(spark, base, "actas_votos", r1, [(1, "A", False, 1), (2, "A", False, 5), (2, "B", False, 6)], vote)
    write(spark, base, "actas_cabecera", r2, [(1, 1, "140101", "C")], head)
    write(spark, base, "actas_votos", r2, [(1, "A", False, 10), (1, "B", False, 20)], vote)
    # The newest run of acta 2 has no detail.
    write(spark, base, "actas_cabecera", r3, [(2, 2, "140101", "P")], head)


def test_last_run_wins_and_children_follow_the_header(spark, lake):
    facts(spark, f"{lake}/facts")
    mesas = spark.createDataFrame([(1, "140101", 1, "140000", "140100", "LIMA"),
                                   (2, "140101", 1, "140000", "140100", "LIMA")], MESAS)
    out = curate.build_curated(spark, f"{lake}/facts", f"{lake}/curated", mesas)
    head = {r.idActa: (r.codigoEstadoActa, r.idDistritoElectoral)
            for r in spark.read.parquet(out["actas_cabecera"]).collect()}
    assert head == {1: ("C", 15), 2: ("P", 15)}
    votes = spark.read.parquet(out["actas_votos"])
    assert sorted((r.idActa, r.nvotos) for r in votes.collect()) == [(1, 10), (1, 20)]
    assert not {"run_ts_ms", "snapshot_date"} & set(votes.columns)
    assert "actas_archivos" not in out
    assert spark.read.parquet(out["actas_votos_tidy"]).columns[10:12] == ["partido", "ccodigo"]
    assert len(spark.read.parquet(out["actas_cabecera"]).columns) == 33
    # Running it again changes nothing.
    again = curate.build_curated(spark, f"{lake}/facts", f"{lake}/curated", mesas)
    assert spark.read.parquet(again["actas_votos"]).count() == 2
    row = curate.coherence(spark.read.parquet(out["actas_cabecera"]),
                           spark.read.parquet(out["actas_votos"])).first()
    assert tuple(row) == (2, 2, 1, 1)


def test_all_rows_of_the_winning_run_are_kept(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c")], "idActa bigint, run_ts_ms bigint, x string")
    assert sorted(r.x for r in curate.curate_header(df).collect()) == ["a", "b"]


def test_missing_facts_raise(spark, lake):
    with pytest.raises(FileNotFoundError):
        sources.read_relaxed(spark, f"{lake}/none", "actas_votos")


def test_enrichment_is_idempotent_and_keeps_rows(spark):
    header = spark.createDataFrame([(1, 7, "140101"), (2, 8, "920101"), (3, 9, "010101")],
                                   "idActa bigint, idMesaRef bigint, ubigeoDistrito string")
    mesas = spark.createDataFrame([(7, "140101", 1, "140000", "140100", "LIMA"),
                                   (8, "920101", 2, "920000", "920100", "X"),
                                   (6, "010101", 1, "010000", "010100", "Y"),
                                   (6, "010101", 1, "010000", "010100", "Y")], MESAS)
    once = curate.enrich_header(header, mesas)
    twice = curate.enrich_header(once, mesas)
    assert once.columns == twice.columns
    assert {r.idActa: r.idDistritoElectoral for r in twice.collect()} == {1: 15, 2: 27, 3: None}
    nulls = curate.enrichment_nulls(twice).first()
    assert tuple(nulls) == (3, 1, 1)


def test_duplicated_station_that_a_header_meets_fails(spark):
    header = spark.createDataFrame([(1, 7, "140101")], "idActa bigint, idMesaRef bigint, ubigeoDistrito string")
    row = (7, "140101", 1, "140000", "140100", "LIMA")
    with pytest.raises(PySparkException, match="several stations"):
        curate.enrich_header(header, spark.createDataFrame([row, row], MESAS)).collect()


def test_drifted_files_are_read_together_and_migrated(spark, lake):
    def put(run, name, table):
        folder = f"{lake}/snapshot_date=2026-04-18/run_ts_ms={run}"
        import os
        os.makedirs(folder, exist_ok=True)
        pq.write_table(table, f"{folder}/{name}.parquet")

    put(1, "a", pa.table({"idActa": [1, 2], "nvotos": pa.nulls(2), "cargo": pa.nulls(2)}))
    put(1, "b", pa.table({"idActa": [3], "nvotos": [7]}))
    put(2, "c", pa.table({"idActa": [4], "nvotos": ["8"], "cargo": ["X"]}))

    def rows():
        df = sources.read_relaxed(spark, lake, "actas_votos")
        assert dict(df.dtypes)["nvotos"] == "bigint"
        return sorted((r.idActa, r.nvotos, r.cargo, r.run_ts_ms) for r in df.collect())

    before = rows()
    assert before == [(1, None, None, 1), (2, None, None, 1), (3, 7, None, 1), (4, 8, "X", 2)]
    assert tuple(sinks.migrate_null_types(spark, lake, "actas_votos").first()) == (3, 1, 0)
    done = sinks.migrate_null_types(spark, lake, "actas_votos", dry_run=False).first()
    assert tuple(done) == (3, 1, 1)
    assert tuple(sinks.migrate_null_types(spark, lake, "actas_votos").first())[1] == 0
    assert rows() == before


def test_migration_leaves_other_batches_of_the_run_alone(spark, lake):
    import os

    for batch, values in ((0, pa.nulls(2)), (1, pa.array([7, 8]))):
        folder = f"{lake}/snapshot_date=2026-04-18/run_ts_ms=1/batch_id={batch}"
        os.makedirs(folder)
        pq.write_table(pa.table({"idActa": [batch, batch], "nvotos": values}), f"{folder}/a.parquet")
    done = sinks.migrate_null_types(spark, lake, "actas_votos", dry_run=False).first()
    assert tuple(done) == (2, 1, 1)
    rows = sources.read_facts(spark, lake, "actas_votos").collect()
    assert sorted((r.idActa, r.nvotos or 0, r.run_ts_ms, r.snapshot_date) for r in rows) == [
        (0, 0, 1, "2026-04-18")] * 2 + [(1, 7, 1, "2026-04-18"), (1, 8, 1, "2026-04-18")]
    both = sources.read_relaxed(spark, lake, "actas_votos")
    assert sorted({r.batch_id for r in both.collect()}) == [0, 1]
    assert "batch_id" not in curate.curate_header(both).columns


def test_drift_stops_the_run_before_anything_is_written(spark, lake):
    good = conform(spark.range(1).select(F.col("id").alias("idActa")), "actas_archivos")
    bad = conform(spark.range(1).select(F.col("id").alias("idActa")), "actas_votos").drop("nvotos")
    with pytest.raises(ValueError, match="missing: nvotos"):
        sinks.write_run({"actas_archivos": good, "actas_votos": bad}, lake, 1_700_000_000_000)
    assert not sinks.path_exists(spark, lake)


def test_tasks(spark):
    mesas = spark.createDataFrame([(5507, "040102"), (1, "010101")], "idMesa bigint, ubigeoDistrito string")
    tasks = keys.station_tasks(mesas)
    assert tasks.count() == 10
    assert tasks.filter("idMesa = 5507 AND idEleccion = 10").first().idActa == 550704010210
    assert keys.station_tasks(mesas, []).count() == 0
    done = tasks.filter("idEleccion = 10")
    assert task_universe(mesas, done=done).count() == 8
    assert task_universe(mesas, limit=3).count() == 3


def test_shards_are_disjoint_and_complete(spark):
    ids = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    parts = [set(r.k for r in keys.in_shard(ids, "k", m, 4).collect()) for m in range(4)]
    assert sum(map(len, parts)) == 5000 and len(set().union(*parts)) == 5000
    assert all(abs(len(p) - 1250) < 1250 * 0.15 for p in parts)
    for bad in ((-1, 3), (3, 3), (0, 0)):
        with pytest.raises(ValueError):
            keys.in_shard(ids, "k", *bad)


def test_station_universe(spark):
    venues = spark.createDataFrame([("140101", "2", 1), ("140101", "1", 1), ("920101", "9", 2)],
                                   "ubigeoDistrito string, codigoLocalVotacion string, idAmbitoGeografico bigint")
    districts = spark.createDataFrame([("140101", "140100", "140000", "LIMA", 1), ("920101", "920100", "920000", "X", 2)],
                                      "ubigeo string, ubigeoProvincia string, ubigeoDepartamento string, nombre string, idAmbitoGeografico bigint")
    listing = spark.createDataFrame([(1, "000001", "140101"), (1, "000001", "140101"), (2, "000002", "920101")],
                                    "idMesa bigint, codigoMesa string, ubigeoDistrito string")
    assert curate.trigger_venues(venues).filter("ubigeoDistrito = '140101'").first().codigoLocalGatillo == "1"
    assert curate.station_universe(listing, venues, districts).count() == 2
    assert curate.station_universe(listing, venues, districts, [1]).count() == 1


def test_relaxed_reads_every_parquet_type(spark, lake):
    import datetime
    import os


    at = datetime.datetime(2026, 4, 12, 8, 30, 15, 123456)
    kinds = {
        "i8": (pa.int8(), 1), "u16": (pa.uint16(), 65535), "u32": (pa.uint32(), 2 ** 32 - 1),
        "f": (pa.float32(), 0.5), "dec": (pa.decimal128(12, 3), 7), "day": (pa.date32(), at.date()),
        "ns": (pa.timestamp("ns"), at), "us": (pa.timestamp("us"), at), "raw": (pa.binary(), b"x"),
        "list": (pa.list_(pa.int32()), [1, 2]), "st": (pa.struct([("a", pa.int64())]), {"a": 3}),
    }
    os.makedirs(f"{lake}/snapshot_date=2026-04-12/run_ts_ms=1")
    pq.write_table(pa.table({n: pa.array([v], k) for n, (k, v) in kinds.items()}),
                   f"{lake}/snapshot_date=2026-04-12/run_ts_ms=1/a.parquet")
    row = sources.read_relaxed(spark, lake).first().asDict(recursive=True)
    assert row["run_ts_ms"] == 1 and bytes(row.pop("raw")) == b"x"
    assert {n: row[n] for n in row if n in kinds} == {n: v for n, (_, v) in kinds.items() if n != "raw"}


def test_curation_keeps_columns_beyond_the_contract(spark, lake):

    facts = spark.range(3).select(
        F.col("id").alias("idActa"), F.lit(1).alias("nuevo"), F.lit("C").alias("codigoEstadoActa"))
    facts.write.parquet(f"{lake}/facts/actas_cabecera/snapshot_date=2026-04-12/run_ts_ms=1")
    spark.range(3).select(F.col("id").alias("idActa"), F.lit(5).alias("nvotos"), F.lit("x").alias("otro")
                          ).write.parquet(f"{lake}/facts/actas_votos/snapshot_date=2026-04-12/run_ts_ms=1")
    out = curate.build_curated(spark, f"{lake}/facts", f"{lake}/curated")
    assert "nuevo" in spark.read.parquet(out["actas_cabecera"]).columns
    assert "otro" in spark.read.parquet(out["actas_votos"]).columns


def test_widening():
    from pyspark.sql import types as T

    from scrutiny.operators.unions import supertype

    def wide(*names):
        return supertype([T._parse_datatype_string(n) for n in names]).simpleString()

    assert wide("smallint", "bigint") == "bigint" and wide("tinyint", "smallint") == "smallint"
    assert wide("int", "float") == "double" and wide("float", "double") == "double"
    assert wide("date", "timestamp") == "timestamp" and wide("decimal(5,2)", "int") == "decimal(12,2)"
    assert wide("array<int>", "array<bigint>") == "array<bigint>" and wide("void", "date") == "date"
    assert wide("string", "bigint") == "string" and wide("decimal(9,4)", "double") == "double"


def test_no_local_scratch_on_a_cluster(monkeypatch):
    from scrutiny import session

    class Conf:
        @staticmethod
        def get(key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(type("S", (), {"conf": Conf}))
