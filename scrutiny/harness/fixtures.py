"""Election-shaped inputs derived from the given tables.

Each view is one SQL text that Spark and DuckDB both run; ``@ms(x)`` (epoch milliseconds
of a timestamp) is the only place where their dialects differ. All integers are bigint.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from scrutiny.session import scratch_path

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

#: What ``cab`` has beyond ``cab0``.
FIGURES = ("totalVotosEmitidos", "totalVotosValidos", "totalAsistentes", "totalElectoresHabiles",
           "porcentajeParticipacionCiudadana")

_ELECTION = ("CAST(CASE {k} % 5 WHEN 0 THEN 10 WHEN 1 THEN 12 WHEN 2 THEN 13 WHEN 3 THEN 14 "
             "ELSE 15 END AS BIGINT)")


def _election(key: str) -> str:
    return _ELECTION.replace("{k}", key)


VIEWS: dict[str, str] = {
    "mesas": """
SELECT c_custkey AS idMesa, lpad(CAST(c_custkey AS STRING), 6, '0') AS codigoMesa,
  CAST(CASE WHEN c_custkey % 36 = 0 THEN 2 ELSE 1 END AS BIGINT) AS idAmbitoGeografico,
  u AS ubigeoDistrito, concat(substr(u, 1, 2), '0000') AS ubigeoDepartamento,
  concat(substr(u, 1, 4), '00') AS ubigeoProvincia, concat('DISTRITO ', u) AS nombreDistrito
FROM (SELECT c_custkey, concat(
    CASE WHEN c_custkey % 36 = 0 THEN '92' ELSE lpad(CAST(c_nationkey + 1 AS STRING), 2, '0') END,
    lpad(CAST(c_custkey % 4 + 1 AS STRING), 2, '0'),
    lpad(CAST(c_custkey % 5 + 1 AS STRING), 2, '0')) AS u
  FROM {customer}) t""",
    # Vote rows; several rows per acta and position, told apart by their run.
    "votos": f"""
SELECT l_orderkey AS idActa, {_election('l_orderkey')} AS idEleccion,
  CAST(l_linenumber AS BIGINT) AS nposicion, l_partkey % 41 AS nagrupacionPolitica,
  lpad(CAST(l_partkey % 41 AS STRING), 8, '0') AS ccodigo,
  CASE l_partkey % 41 WHEN 38 THEN 'VOTOS EN BLANCO' WHEN 39 THEN 'VOTOS NULOS'
    WHEN 40 THEN 'VOTOS IMPUGNADOS'
    ELSE concat('PARTIDO ', lpad(CAST(l_partkey % 41 AS STRING), 2, '0')) END AS descripcion,
  (l_partkey % 41) >= 38 AS es_especial, CAST(l_quantity AS BIGINT) AS nvotos,
  l_discount AS nporcentajeVotosValidos, l_tax AS nporcentajeVotosEmitidos,
  concat(lpad(CAST(l_orderkey % 25 + 1 AS STRING), 2, '0'),
    lpad(CAST(l_orderkey % 4 + 1 AS STRING), 2, '0'),
    lpad(CAST(l_orderkey % 3 + 1 AS STRING), 2, '0')) AS ubigeoDistrito,
  1700000000000 + CAST(year(l_shipdate) AS BIGINT) * 86400000 AS run_ts_ms,
  @ms(l_shipdate) AS ship_ms
FROM {{lineitem}}""",
    "votos_sum": """
SELECT idActa, CAST(sum(nvotos) AS BIGINT) AS st,
  CAST(sum(CASE WHEN NOT es_especial THEN nvotos ELSE 0 END) AS BIGINT) AS sv
FROM {votos} GROUP BY idActa""",
    # Header without figures: enough for counts, states and places.
    "cab0": f"""
SELECT o_orderkey AS idActa, {_election('o_orderkey')} AS idEleccion, o_custkey AS idMesaRef,
  m.codigoMesa, m.idAmbitoGeografico, m.ubigeoDistrito, m.ubigeoDepartamento,
  m.ubigeoProvincia, m.nombreDistrito,
  CASE o_orderstatus WHEN 'F' THEN 'C' WHEN 'O' THEN 'E' ELSE 'P' END AS codigoEstadoActa,
  CASE WHEN o_orderkey % 7 = 0 THEN 'N' ELSE 'D' END AS estadoActa,
  concat('LOCAL ', substr(m.ubigeoDistrito, 1, 4)) AS nombreLocalVotacion,
  concat('CIUDAD ', m.ubigeoDistrito) AS ubigeoNivel03,
  @ms(o_orderdate) AS snapshot_ts_ms,
  CAST(CASE WHEN idAmbitoGeografico = 2 THEN 27 WHEN dep BETWEEN 1 AND 6 THEN dep
    WHEN dep BETWEEN 7 AND 13 THEN dep + 1
    WHEN dep = 14 THEN CASE WHEN substr(ubigeoProvincia, 1, 4) = '1401' THEN 15 ELSE 16 END
    WHEN dep BETWEEN 15 AND 23 THEN dep + 2 WHEN dep = 24 THEN 7 WHEN dep = 25 THEN 26
    END AS BIGINT) AS idDistritoElectoral
FROM {{orders}} JOIN (SELECT *, CAST(substr(ubigeoDistrito, 1, 2) AS INT) AS dep FROM {{mesas}}) m
  ON o_custkey = m.idMesa""",
    "cab": """
SELECT *, CAST(totalVotosEmitidos AS DOUBLE) * 100 / nullif(totalElectoresHabiles, 0)
    AS porcentajeParticipacionCiudadana
FROM (SELECT c.*,
    CAST(CASE WHEN c.idActa % 97 = 0 THEN t.st + 7 ELSE t.st END AS BIGINT) AS totalVotosEmitidos,
    CAST(CASE WHEN c.idActa % 211 = 0 THEN t.st + 9 ELSE t.sv END AS BIGINT) AS totalVotosValidos,
    CAST(CASE WHEN c.idActa % 401 = 0 THEN t.st + 200 ELSE t.st END AS BIGINT) AS totalAsistentes,
    CAST(CASE WHEN c.idActa % 307 = 0 THEN t.st - 3 ELSE t.st + 40 + c.idActa % 60 END AS BIGINT)
      AS totalElectoresHabiles
  FROM {cab0} c LEFT JOIN {votos_sum} t ON c.idActa = t.idActa) x""",
    # Header facts with runs: the runs of the detail, a later run without detail for some
    # actas, and a second row in the same run for others.
    "cab_runs": """
SELECT idActa, run_ts_ms, CAST(1 AS BIGINT) AS copia FROM {votos} GROUP BY idActa, run_ts_ms
UNION ALL SELECT idActa, max(run_ts_ms) + 1000, CAST(2 AS BIGINT) FROM {votos}
  WHERE idActa % 13 = 0 GROUP BY idActa
UNION ALL SELECT idActa, run_ts_ms, CAST(3 AS BIGINT) FROM {votos}
  WHERE idActa % 17 = 0 GROUP BY idActa, run_ts_ms""",
    "cab_facts": f"""
SELECT r.idActa, r.run_ts_ms, r.copia, {_election('r.idActa')} AS idEleccion,
  o_custkey AS idMesaRef, m.ubigeoDistrito, m.codigoMesa,
  CASE o_orderstatus WHEN 'F' THEN 'C' WHEN 'O' THEN 'E' ELSE 'P' END AS codigoEstadoActa
FROM {{cab_runs}} r JOIN {{orders}} ON r.idActa = o_orderkey JOIN {{mesas}} m
  ON o_custkey = m.idMesa""",
    "padron_base": """
SELECT CASE WHEN idAmbitoGeografico = 2 THEN 'Extranjero' ELSE 'Nacional' END AS Residencia,
  lpad(CAST(idMesa % 9 AS STRING), 4, '0') AS CodPais,
  concat('PAIS ', CAST(idMesa % 9 AS STRING)) AS Pais,
  ubigeoDistrito AS UBIGEO_RENIEC, concat('9', ubigeoDistrito) AS UBIGEO_INEI,
  ubigeoDepartamento AS Departamento, ubigeoProvincia AS Provincia, nombreDistrito AS Distrito,
  CASE WHEN idMesa % 2 = 0 THEN 'Hombre' ELSE 'Mujer' END AS Sexo,
  CASE WHEN idMesa % 3 = 0 THEN 'DNI electrónico' ELSE 'DNI convencional' END AS TipoDNI,
  CASE WHEN idMesa % 11 = 0 THEN 'Caducado' ELSE 'Vigente' END AS Caducado,
  idMesa % 90 AS Edad, idMesa % 7 + 1 AS Cantidad
FROM {mesas}""",
    # The validity file misses some places.
    "padron_vigencia": """
SELECT * FROM {padron_base} WHERE substr(UBIGEO_RENIEC, 1, 2) <> '03'""",
    "padron": """
SELECT UBIGEO_RENIEC AS ubigeo_reniec, 'Nacional' AS residencia, 'Perú' AS pais_nombre,
  CAST(sum(Cantidad) AS BIGINT) * 12 AS total_electores
FROM {padron_base} WHERE Residencia = 'Nacional' AND Edad >= 18 GROUP BY UBIGEO_RENIEC""",
    "snapshots": f"""
SELECT {_election('event_id')} AS idEleccion, ts AS snapshot_ts, @ms(ts) AS snapshot_ts_ms,
  event_id AS contabilizadas, CAST(20000 AS BIGINT) AS totalActas, value AS pct,
  value AS actasContabilizadas
FROM {{events}}""",
    "archivos": """
SELECT doc_id AS idActa, doc_id % 5 + 1 AS tipo,
  CASE WHEN doc_id % 50 = 0 THEN concat('bad-', CAST(doc_id AS STRING))
    WHEN doc_id % 77 = 0 THEN NULL
    ELSE substr(md5(CAST(doc_id % 900 AS STRING)), 1, 24) END AS archivoId
FROM {documents}""",
    # Official aggregates: two snapshots each, the newer one close to the curated data.
    "of_totales_now": """
SELECT idEleccion, count(*) AS n,
  CAST(sum(CASE WHEN codigoEstadoActa = 'C' THEN totalVotosEmitidos ELSE 0 END) AS BIGINT) AS e,
  CAST(sum(CASE WHEN codigoEstadoActa = 'C' THEN totalVotosValidos ELSE 0 END) AS BIGINT) AS v
FROM {cab} GROUP BY idEleccion""",
    "of_totales": """
SELECT idEleccion, CAST(1700000000000 AS BIGINT) AS snapshot_ts_ms, n - 5 AS totalActas,
  e - 900 AS totalVotosEmitidos, v - 700 AS totalVotosValidos FROM {of_totales_now}
UNION ALL SELECT idEleccion, CAST(1700000900000 AS BIGINT), n, e + 3, v + 1
FROM {of_totales_now}""",
    "of_mesas": """
SELECT CAST(1700000000000 AS BIGINT) AS snapshot_ts_ms,
  CAST(sum(CASE WHEN idMesa % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS mesasInstaladas,
  CAST(sum(CASE WHEN idMesa % 3 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS mesasNoInstaladas,
  CAST(sum(CASE WHEN idMesa % 3 = 2 THEN 1 ELSE 0 END) AS BIGINT) AS mesasPendientes
FROM {mesas}""",
    "of_mapa": """
SELECT idEleccion, CAST(1700000000000 AS BIGINT) AS snapshot_ts_ms,
  CAST(substr(ubigeoDistrito, 1, 2) AS BIGINT) * 10000 AS ubigeoNivel01,
  count(*) + CAST(substr(ubigeoDistrito, 1, 2) AS BIGINT) % 3 AS actasContabilizadas
FROM {cab0} WHERE codigoEstadoActa = 'C'
GROUP BY idEleccion, CAST(substr(ubigeoDistrito, 1, 2) AS BIGINT)""",
    "of_partidos": """
SELECT idEleccion, CAST(1700000000000 AS BIGINT) AS snapshot_ts_ms,
  ccodigo AS codigoAgrupacionPolitica,
  CAST(sum(nvotos) AS BIGINT) + max(nagrupacionPolitica) % 4 AS totalVotosValidos
FROM {votos} WHERE NOT es_especial GROUP BY idEleccion, ccodigo""",
    "of_totales_de": """
SELECT idEleccion, idDistritoElectoral, CAST(1700000000000 AS BIGINT) AS snapshot_ts_ms,
  count(*) - 1 AS totalActas FROM {cab0} GROUP BY idEleccion, idDistritoElectoral
UNION ALL SELECT idEleccion, idDistritoElectoral, CAST(1700000900000 AS BIGINT), count(*)
FROM {cab0} GROUP BY idEleccion, idDistritoElectoral""",
    "of_partidos_de": """
SELECT c.idEleccion, c.idDistritoElectoral, v.ccodigo AS codigoAgrupacionPolitica,
  CAST(1700000000000 AS BIGINT) AS snapshot_ts_ms,
  CAST(sum(v.nvotos) AS BIGINT) + max(v.nagrupacionPolitica) % 2 AS totalVotosValidos
FROM {votos} v JOIN {cab0} c ON v.idActa = c.idActa
WHERE NOT v.es_especial AND c.idDistritoElectoral IS NOT NULL
GROUP BY c.idEleccion, c.idDistritoElectoral, v.ccodigo""",
    "of_publicacion": """
SELECT idEleccion, ubigeoDistrito, ccodigo,
  CAST(sum(nvotos) AS BIGINT) + max(nagrupacionPolitica) % 3 AS votos
FROM {votos} WHERE NOT es_especial GROUP BY idEleccion, ubigeoDistrito, ccodigo""",
}

_NAME = re.compile(r"\{(" + "|".join([*BASE_TABLES, *VIEWS]) + r")\}")
_MS = re.compile(r"@ms\(([^)]*)\)")


def dependencies(name: str) -> list[str]:
    return list(dict.fromkeys(_NAME.findall(VIEWS[name])))


def _dialect(sql: str, engine: str) -> str:
    if engine == "spark":
        return _MS.sub(
            r"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', \1)", sql)
    return _MS.sub(r"(epoch_us(\1) // 1000)", sql)


class Tables:
    """Given tables and the views over them, as DataFrames of one session."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._known: dict[str, DataFrame] = {}
        self._stored: set[str] = set()

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __call__(self, name: str) -> DataFrame:
        if name not in self._known:
            if name in BASE_TABLES:
                self._known[name] = self.spark.read.parquet(self.path(name))
            else:
                inputs = {d: self(d) for d in dependencies(name)}
                self._known[name] = self.spark.sql(_dialect(VIEWS[name], "spark"), **inputs)
        return self._known[name]

    def stored(self, name: str, *columns: str) -> DataFrame:
        """The given columns of a view, written once to the shared folder.

        For jobs that read it several times, as they read curated tables in practice.
        Views made from it afterwards read the stored table too.
        """
        if name not in self._stored:
            path = scratch_path(self.spark, name)
            self(name).select(*columns).write.option("compression", "zstd").parquet(path)
            self._known[name] = self.spark.read.parquet(path)
            self._stored.add(name)
            if name == "cab":
                self._known["cab0"] = self._known["cab"].drop(*FIGURES)
        return self._known[name]

    def sql(self, text: str, *names: str) -> DataFrame:
        """Run SQL over tables and views named in braces."""
        found = dict.fromkeys(_NAME.findall(text))
        return self.spark.sql(_dialect(text, "spark"), **{n: self(n) for n in found})


@cache
def _needed(names: tuple[str, ...]) -> tuple[str, ...]:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in BASE_TABLES or name in order:
            return
        for dep in dependencies(name):
            visit(dep)
        order.append(name)

    for name in names:
        visit(name)
    return tuple(order)


def oracle(sql: str) -> str:
    """DuckDB text of a query that names its tables and views in braces."""
    used = tuple(dict.fromkeys(n for n in _NAME.findall(sql) if n in VIEWS))
    views = [
        f"{name} AS ({_NAME.sub(r'\1', _dialect(VIEWS[name], 'duckdb')).strip()})"
        for name in _needed(used)
    ]
    body = _NAME.sub(r"\1", _dialect(sql, "duckdb")).strip()
    if not views:
        return body
    head = "WITH " + ",\n".join(views)
    if body.upper().startswith("WITH "):
        return f"{head},\n{body[5:]}"
    return f"{head}\n{body}"
