"""Time the compute-bound jobs at the published size: ~450 thousand actas, ~18.5 million votes.

The input is made from the given tables: every order stands for three actas with 41 vote
rows each, and the actas that are not terminal have a second run. It is written as
versioned facts first; the times are those of the jobs over stored files, each including
the write of its result. Prints one JSON line. ``BENCH_WORK`` names a folder for the
files (about 2 GB), by default a fresh one under the session's shared folder.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from scrutiny.harness.fixtures import Tables
from scrutiny.operators.contract_checks import conform
from scrutiny.plans import anomalies, curate, dq
from scrutiny.session import build, scratch_path
from scrutiny.sinks.tables import write_dim, write_run, write_table

#: Official aggregates the report compares with, stored beforehand.
OFFICIAL = {"mesa_totales": "of_mesas", "totales": "of_totales", "mapa_calor": "of_mapa",
            "participantes": "of_partidos", "totales_de": "of_totales_de",
            "participantes_de": "of_partidos_de"}
RUNS = (1_776_400_000_000, 1_776_500_000_000)


def facts(t: Tables, run: int, states: tuple[str, ...]):
    """Header and votes of one run, for the actas in the given states."""
    copies = F.explode(F.array(*[F.lit(k).cast("bigint") for k in range(3)]))
    header = t("cab0").withColumn("k", copies).withColumns({
        "idActa": F.col("idActa") * 3 + F.col("k"),
        "totalElectoresHabiles": F.lit(300).cast("bigint"),
        "totalVotosEmitidos": F.lit(41 * 5).cast("bigint"),
        "totalVotosValidos": F.lit(38 * 5).cast("bigint"),
        "totalAsistentes": F.lit(41 * 5).cast("bigint"),
        "porcentajeParticipacionCiudadana": F.lit(60.0) + F.col("idActa") % 17,
        "snapshot_ts_ms": F.lit(run).cast("bigint"),
    }).filter(F.col("codigoEstadoActa").isin(*states)).repartition(32)
    position = F.posexplode(F.sequence(F.lit(0), F.lit(40)))
    votes = header.select("idActa", "idEleccion", "ubigeoDistrito", position.alias("i", "p")).select(
        "idActa", "idEleccion", "ubigeoDistrito",
        F.concat(F.lit("PARTIDO "), F.col("p").cast("string")).alias("descripcion"),
        (F.col("p") >= 38).alias("es_especial"),
        F.lpad(F.col("p").cast("string"), 8, "0").alias("ccodigo"),
        F.col("p").cast("bigint").alias("nposicion"), F.lit(5).cast("bigint").alias("nvotos"),
        F.col("p").cast("bigint").alias("nagrupacionPolitica"))
    return {"actas_cabecera": conform(header, "actas_cabecera"),
            "actas_votos": conform(votes, "actas_votos")}


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build(f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(4 * int(cpus)),
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "20g"),
    })
    spark.sparkContext.setLogLevel("OFF")
    work = os.environ.get("BENCH_WORK") or scratch_path(spark, "bench")
    t = Tables(spark, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"))
    write_run(facts(t, RUNS[0], ("C", "E", "P")), f"{work}/facts", RUNS[0])
    write_run(facts(t, RUNS[1], ("P",)), f"{work}/facts", RUNS[1])
    mesas = spark.read.parquet(write_dim(t("mesas"), f"{work}/dim", "mesas"))
    official = {name: spark.read.parquet(write_dim(t(view), f"{work}/official", name))
                for name, view in OFFICIAL.items()}
    seconds: dict[str, float] = {}

    def timed(name: str, job) -> None:
        start = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - start, 2)

    timed("build_curated_with_enrichment_and_tidy",
          lambda: curate.build_curated(spark, f"{work}/facts", f"{work}/curated", mesas))
    header = spark.read.parquet(f"{work}/curated/actas_cabecera")
    votes = spark.read.parquet(f"{work}/curated/actas_votos")
    timed("enrich_header",
          lambda: write_table(curate.enrich_header(header, mesas), f"{work}/enriched"))
    timed("dq_report", lambda: dq.report(header, votes, official).collect())
    timed("anomalies", lambda: write_table(anomalies.run_all(header, votes), f"{work}/anomalias"))
    print(json.dumps({
        "headers": header.count(), "votes": votes.count(), "cpus": int(cpus), "seconds": seconds,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
