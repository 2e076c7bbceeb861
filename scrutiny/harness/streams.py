"""Streaming queries: each works off what is there and must equal its batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from scrutiny.harness.landing import _ENTRIES, _OK, RUN_MS, _BASE, _catalogue_pages, _land, _landed
from scrutiny.harness.registry import query
from scrutiny.operators import filters
from scrutiny.session import scratch_path
from scrutiny.sources import documents, files, pages
from scrutiny.streaming import common, curated, ingest, progress


def _event_stream(t):
    """The events table as a stream of snapshots."""
    events = common.file_stream(t.spark, t.path("events"), t("events").schema)
    election = F.element_at(F.array(*[F.lit(x) for x in (10, 12, 13, 14, 15)]),
                            (F.col("event_id") % 5 + 1).cast("int")).cast("bigint")
    return events.select(
        election.alias("idEleccion"), F.col("ts").alias("snapshot_ts"),
        F.col("event_id").alias("contabilizadas"), F.lit(20000).cast("bigint").alias("totalActas"),
        F.col("value").alias("pct"))


_WINDOWS = """SELECT strftime(time_bucket(INTERVAL 15 MINUTE, snapshot_ts), '%Y-%m-%d %H:%M:%S')
    AS window_start, idEleccion, max_by(contabilizadas, snapshot_ts) AS contabilizadas,
  max_by(totalActas, snapshot_ts) AS "totalActas", max_by(pct, snapshot_ts) AS pct, count(*) AS n
FROM {snapshots} GROUP BY time_bucket(INTERVAL 15 MINUTE, snapshot_ts), idEleccion"""


def _shown(df):
    return df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query("progress_15min", "T3", _WINDOWS)
def _(t):
    rows = t("snapshots").select("idEleccion", "snapshot_ts", "contabilizadas", "totalActas", "pct")
    return _shown(progress.progress_windows(rows))


@query("progress_15min_stream", "T3 R12", _WINDOWS)
def _(t):
    out = scratch_path(t.spark, "progress")
    common.run_available(progress.write_updates(
        progress.progress_windows(_event_stream(t)), f"{out}/rows", f"{out}/checkpoint"))
    return _shown(common.newest_per_key(t.spark, f"{out}/rows", ["window_start", "idEleccion"]))


@query("unique_snapshots_stream", "T4", """
SELECT idEleccion, contabilizadas, pct FROM {snapshots}""")
def _(t):
    out = scratch_path(t.spark, "unique")
    # Every snapshot arrives twice.
    twice = _event_stream(t).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    common.run_available(progress.append_stream(
        progress.unique_snapshots(twice), f"{out}/rows", f"{out}/checkpoint"))
    return t.spark.read.parquet(f"{out}/rows").select("idEleccion", "contabilizadas", "pct")


def _landed_files(t) -> str:
    path = scratch_path(t.spark, "landed")
    _land(_landed(t), path)
    return path


@query("ingest_stream", "T1 T7 B01 B17 K3", f"""
SELECT 'actas_cabecera' AS tabla, count(*) AS filas FROM {{orders}} WHERE {_OK}
UNION ALL SELECT 'actas_votos', CAST(sum(o_orderkey % 7) AS BIGINT) FROM {{orders}}
  WHERE {_OK} AND o_orderstatus <> 'P'
UNION ALL SELECT 'actas_linea_tiempo', CAST(sum(o_orderkey % 4) AS BIGINT) FROM {{orders}} WHERE {_OK}
UNION ALL SELECT 'actas_archivos', CAST(sum(o_orderkey % 3) AS BIGINT) FROM {{orders}} WHERE {_OK}
UNION ALL SELECT 'cuarentena', count(*) FROM {{orders}} WHERE o_orderkey % 37 = 0
UNION ALL SELECT 'completas', count(*) FROM {{orders}} WHERE o_orderkey % 37 <> 0""")
def _(t):
    from scrutiny.operators.unions import union_all

    spark, landed = t.spark, _landed_files(t)
    out = scratch_path(spark, "ingest")
    # The same documents land twice: the second copy must change nothing.
    landed_again = f"{landed}/again"
    _land(spark.read.schema(ingest.LANDED_DDL).json(landed), landed_again)
    common.run_available(ingest.ingest_stream(
        spark, f"{landed}/{{*,again/*}}.json*", out, f"{out}/_checkpoint", RUN_MS))
    counts = [
        spark.read.parquet(f"{out}/{name}").agg(F.count(F.lit(1)).alias("filas")).select(
            F.lit(name).alias("tabla"), "filas")
        for name in ("actas_cabecera", "actas_votos", "actas_linea_tiempo", "actas_archivos")
    ]
    counts.append(spark.read.parquet(f"{out}/_quarantine").agg(
        F.count(F.lit(1)).alias("filas")).select(F.lit("cuarentena").alias("tabla"), "filas"))
    counts.append(files.read_ledger(spark, f"{out}/_ledger").agg(
        F.sum(F.col("ok") + F.col("empty")).alias("filas")).select(
        F.lit("completas").alias("tabla"), "filas"))
    return union_all(counts)


@query("curated_stream", "T2", """
SELECT f.idActa, f.nposicion, f.nvotos, f.run_ts_ms FROM {votos} f
JOIN (SELECT idActa, max(run_ts_ms) AS m FROM {votos} GROUP BY idActa) w
ON f.idActa = w.idActa AND f.run_ts_ms = w.m""")
def _(t):
    spark = t.spark
    out = scratch_path(spark, "curated-stream")
    votes = t("votos").select("idActa", "nposicion", "nvotos", "run_ts_ms")
    # Facts arrive in three deliveries, newer and older runs mixed.
    for part in range(3):
        votes.filter(F.pmod("nposicion", F.lit(3)) == part).write.parquet(f"{out}/facts/part{part}")
    schema = "idActa bigint, nposicion bigint, nvotos bigint, run_ts_ms bigint"
    source = common.file_stream(spark, f"{out}/facts/*", schema, max_files=8)
    common.run_available(curated.curated_stream(
        source, f"{out}/table", f"{out}/checkpoint", buckets=16))
    return curated.read_curated(spark, f"{out}/table")


@query("refresh_stream", "T5 P12", """
SELECT o_orderkey AS req_acta_id FROM {orders} WHERE o_orderstatus IN ('P', 'O')""")
def _(t):
    spark = t.spark
    out = scratch_path(spark, "refresh")
    source = common.file_stream(spark, _landed_files(t), ingest.LANDED_DDL, "json")
    volatile = filters.in_states(t.sql("""SELECT o_orderkey AS idActa, CASE o_orderstatus
        WHEN 'F' THEN 'C' WHEN 'O' THEN 'E' ELSE 'P' END AS codigoEstadoActa FROM {orders}"""))
    common.run_available(progress.append_stream(
        ingest.refresh_stream(source, volatile), f"{out}/rows", f"{out}/checkpoint"))
    return spark.read.parquet(f"{out}/rows").select("req_acta_id")


@query("catalogue_stream", "T6 J13 F16", f"""
SELECT page_id, title, url, false AS matches FROM ({_ENTRIES}) e WHERE page_id % 2 = 1""")
def _(t):
    spark = t.spark
    out = scratch_path(spark, "catalogue")
    _catalogue_pages(t).write.parquet(f"{out}/pages")
    source = common.file_stream(spark, f"{out}/pages", "page_id bigint, html string")
    previous = pages.catalogue_entries(_catalogue_pages(t), _BASE).filter("page_id % 2 = 0")
    common.run_available(progress.monitor_stream(
        pages.catalogue_entries(source, _BASE), previous, f"{out}/rows", f"{out}/checkpoint"))
    return spark.read.parquet(f"{out}/rows").select("page_id", "title", "url", "matches")


@query("quarantined_documents", "T7 S6", """
SELECT o_orderkey AS req_acta_id, 'no answer' AS body FROM {orders} WHERE o_orderkey % 37 = 0""")
def _(t):
    parsed = documents.parse_documents(_landed(t))
    return parsed.filter(~F.col("parsed")).select("req_acta_id", "body")
