"""Landed JSON: acta documents, aggregate payloads, geography, maps, registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutiny import contracts as c
from scrutiny.functions.scalars import feature_id, lima_iso, place_code

#: What the ingest adds to each landed document: the request it answers.
REQUEST_DDL = "req_acta_id bigint, req_id_mesa bigint, req_ubigeo string, snapshot_ts_ms bigint"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Landed acta documents as JSON lines, with the request columns."""
    return spark.read.schema(c.DOCUMENT_DDL + ", " + REQUEST_DDL).json(path)


def parse_documents(raw: DataFrame, body: str = "body") -> DataFrame:
    """Documents held as text next to the request columns.

    Text that does not parse gives nulls everywhere; ``parsed`` tells it apart from a
    station that does not exist. The document is unpacked by a generator over a
    one-element array: filters on its fields stay above it, so the text is parsed once
    per row (over a plain projection each pushed-down filter would parse it again).
    """
    # A missing or blank answer is as unreadable as one that is not JSON.
    # The text "null" is an answer: there is no such station.
    text = F.coalesce(F.nullif(F.trim(body), F.lit("")), F.lit("no answer"))
    text = F.when(text == "null", F.lit("{}")).otherwise(text)
    doc = F.from_json(text, c.schema(c.DOCUMENT_DDL + ", _bad string"),
                      {"columnNameOfCorruptRecord": "_bad"})
    keep = [f.name for f in c.schema(REQUEST_DDL).fields]
    names = [f.name for f in c.schema(c.DOCUMENT_DDL).fields]
    return raw.select(*keep, F.col(body).alias("body"), F.inline(F.array(doc))).select(
        *names, *keep,
        F.col("_bad").isNull().alias("parsed"), "body",
    )


def stage_documents(raw: DataFrame, path: str, body: str = "body") -> DataFrame:
    """Parse landed documents once into nested Parquet, read back.

    Each fact table then reads just the nested columns it is made of; no text is parsed or
    scanned again, however many tables there are.
    """
    parsed = parse_documents(raw, body)
    parsed.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return raw.sparkSession.read.schema(parsed.schema).parquet(path)


# --- aggregate payloads -------------------------------------------------------

# Fields of each aggregate payload.
_TOTALS = (
    "actasContabilizadas:double,contabilizadas:bigint,totalActas:bigint,"
    "participacionCiudadana:double,actasEnviadasJee:double,enviadasJee:bigint,"
    "actasPendientesJee:double,pendientesJee:bigint,fechaActualizacion:bigint,"
    "totalVotosEmitidos:bigint,totalVotosValidos:bigint,porcentajeVotosEmitidos:double,"
    "porcentajeVotosValidos:double,idUbigeoDepartamento:bigint,idUbigeoProvincia:bigint,"
    "idUbigeoDistrito:bigint,idUbigeoDistritoElectoral:bigint"
)
_PARTIES = (
    "nombreAgrupacionPolitica:string,codigoAgrupacionPolitica:string,"
    "nombreCandidato:string,dniCandidato:string,totalVotosValidos:bigint,"
    "porcentajeVotosValidos:double,porcentajeVotosEmitidos:double"
)
AGGREGATE_FIELDS = {
    "resumen_elecciones": "id:bigint,nombre:string,actasContabilizadas:bigint,"
    "porcentajeActasContabilizadas:double,actasObservadasEnviadas:bigint,"
    "actasPendientes:bigint",
    "mesa_totales": "mesasInstaladas:bigint,mesasNoInstaladas:bigint,mesasPendientes:bigint",
    "ultima_fecha": "fechaProceso:bigint,servicioFirma:boolean,cdescripcion:string",
    "totales": _TOTALS,
    "totales_de": _TOTALS,
    "participantes": _PARTIES,
    "participantes_de": _PARTIES,
    "mapa_calor": "ambitoGeografico:bigint,ubigeoNivel01:bigint,ubigeoNivel02:bigint,"
    "ubigeoNivel03:bigint,distritoElectoral:bigint,"
    "porcentajeActasContabilizadas:double,actasContabilizadas:bigint",
}
_STAMPS = {
    "resumen_elecciones": (), "mesa_totales": (), "ultima_fecha": (),
    "totales": ("idEleccion",), "participantes": ("idEleccion",), "mapa_calor": ("idEleccion",),
    "totales_de": ("idEleccion", "idDistritoElectoral"),
    "participantes_de": ("idEleccion", "idDistritoElectoral"),
}


def stamp(df: DataFrame, ts_ms: Column | int, **extra: Column | int | str) -> DataFrame:
    """Add the snapshot's time, its local ISO text and constants to every row."""
    ts = ts_ms if isinstance(ts_ms, Column) else F.lit(ts_ms).cast("bigint")
    constants = {k: v if isinstance(v, Column) else F.lit(v) for k, v in extra.items()}
    return df.withColumns({"snapshot_ts_ms": ts, "snapshot_lima_iso": lima_iso(ts), **constants})


def aggregate_table(landed: DataFrame, table: str) -> DataFrame:
    """Rows of one of the eight aggregate tables.

    ``landed`` has ``table_name``, ``idEleccion``, ``idDistritoElectoral``,
    ``snapshot_ts_ms`` and the payload text. A payload is an object or an array; null
    ones (no content for that combination) give no rows.
    """
    rows = F.from_json("payload", f"array<struct<{AGGREGATE_FIELDS[table]}>>")
    flat = (
        landed.filter((F.col("table_name") == table) & F.col("payload").isNotNull())
        .select(F.explode(rows).alias("r"), *_STAMPS[table], "snapshot_ts_ms")
        .select("r.*", *_STAMPS[table], "snapshot_ts_ms")
    )
    return stamp(flat, F.col("snapshot_ts_ms"))


def aggregate_tables(landed: DataFrame) -> dict[str, DataFrame]:
    return {name: aggregate_table(landed, name) for name in c.AGGREGATE_TABLES}


def _all_fields() -> dict[str, str]:
    """Every field of any aggregate payload; text where the tables differ in its type."""
    types: dict[str, str] = {}
    for fields in AGGREGATE_FIELDS.values():
        for name, kind in (f.split(":") for f in fields.split(",")):
            types[name] = kind if types.get(name, kind) == kind else "string"
    return types


def stage_aggregates(landed: DataFrame, path: str) -> None:
    """Parse every landed payload once and write its rows, a partition for each table.

    One schema holds the fields of all tables, so one parse serves whatever table a payload
    is for; a column that a table doesn't have is null there and costs nothing in Parquet.
    Payloads of tables that are not known, and null ones, give no rows.
    """
    ddl = ",".join(f"{name}:{kind}" for name, kind in _all_fields().items())
    rows = (
        landed.filter(F.col("table_name").isin(*c.AGGREGATE_TABLES) & F.col("payload").isNotNull())
        .select("table_name", F.col("idEleccion").alias("_idEleccion"),
                F.col("idDistritoElectoral").alias("_idDistritoElectoral"), "snapshot_ts_ms",
                F.explode(F.from_json("payload", f"array<struct<{ddl}>>")).alias("r"))
        .select("table_name", "_idEleccion", "_idDistritoElectoral", "snapshot_ts_ms", "r.*")
    )
    (rows.write.mode("overwrite").partitionBy("table_name").option("compression", "zstd")
     .parquet(path))


def staged_aggregate_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The eight tables from what ``stage_aggregates`` wrote: each reads its own partition and
    columns, and a table without any payload is empty."""
    types = _all_fields()
    ddl = ("table_name string, _idEleccion bigint, _idDistritoElectoral bigint, snapshot_ts_ms bigint, "
           + ", ".join(f"{name} {kind}" for name, kind in types.items()))
    staged = spark.read.schema(ddl).parquet(path)
    out = {}
    for table in c.AGGREGATE_TABLES:
        fields = [f.split(":") for f in AGGREGATE_FIELDS[table].split(",")]
        rows = staged.filter(F.col("table_name") == table).select(
            *[F.col(n).try_cast(k).alias(n) if types[n] != k else F.col(n) for n, k in fields],
            *[F.col(f"_{n}").alias(n) for n in _STAMPS[table]], "snapshot_ts_ms")
        out[table] = stamp(rows, F.col("snapshot_ts_ms"))
    return out


# --- geography ----------------------------------------------------------------

GEOGRAPHY_DDL = (
    "idAmbitoGeografico bigint, departamentos array<struct<ubigeo:string,nombre:string,"
    "provincias:array<struct<ubigeo:string,nombre:string,"
    "distritos:array<struct<ubigeo:string,nombre:string,"
    "locales:array<struct<codigoLocalVotacion:string,nombreLocalVotacion:string>>>>>>>>"
)


def geography_tables(payloads: DataFrame) -> dict[str, DataFrame]:
    """Nested places to four flat tables; every row carries all its parents' codes.

    ``payloads`` follows ``GEOGRAPHY_DDL``: one row per scope (or per department of
    it, which keeps rows small). Scopes need no union: they are rows of one frame.
    """
    scope = "idAmbitoGeografico"
    dep = payloads.select(scope, F.explode("departamentos").alias("d")).select(
        scope, place_code("d.ubigeo").alias("ubigeoDepartamento"), "d"
    )
    prov = dep.select(scope, "ubigeoDepartamento", F.explode("d.provincias").alias("p")).select(
        scope, "ubigeoDepartamento", place_code("p.ubigeo").alias("ubigeoProvincia"), "p"
    )
    dist = prov.select(
        scope, "ubigeoDepartamento", "ubigeoProvincia", F.explode("p.distritos").alias("t")
    ).select(
        scope, "ubigeoDepartamento", "ubigeoProvincia",
        place_code("t.ubigeo").alias("ubigeoDistrito"), "t",
    )
    venue = dist.select(
        scope, "ubigeoDepartamento", "ubigeoProvincia", "ubigeoDistrito",
        F.explode("t.locales").alias("l"),
    )
    return {
        "departamentos": dep.select(
            F.col("ubigeoDepartamento").alias("ubigeo"), F.col("d.nombre").alias("nombre"), scope
        ),
        "provincias": prov.select(
            F.col("ubigeoProvincia").alias("ubigeo"), F.col("p.nombre").alias("nombre"),
            "ubigeoDepartamento", scope,
        ),
        "distritos": dist.select(
            F.col("ubigeoDistrito").alias("ubigeo"), F.col("t.nombre").alias("nombre"),
            "ubigeoProvincia", "ubigeoDepartamento", scope,
        ),
        "locales": venue.select(
            "l.codigoLocalVotacion", "l.nombreLocalVotacion",
            "ubigeoDistrito", "ubigeoProvincia", "ubigeoDepartamento", scope,
        ),
    }


# --- map features -------------------------------------------------------------

FEATURES_DDL = (
    "type string, features array<struct<type:string,id:string,geometry:string,"
    "properties:map<string,string>>>"
)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature of GeoJSON files; the geometry stays JSON text."""
    return explode_features(
        spark.read.schema(FEATURES_DDL).option("multiLine", True).json(path)
        .withColumn("source", F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1))
    )


def explode_features(collections: DataFrame) -> DataFrame:
    """Rows of a valid collection; another ``type`` is an error."""
    checked = collections.withColumn(
        "features",
        F.when(F.col("type") == "FeatureCollection", F.col("features")).otherwise(
            F.raise_error(F.concat(F.lit("not a FeatureCollection: "),
                                   F.coalesce(F.col("type"), F.lit("null"))))
            .cast("array<struct<type:string,id:string,geometry:string,"
                  "properties:map<string,string>>>")
        ),
    )
    return checked.select("source", F.explode("features").alias("f")).select(
        "source", F.col("f.id").alias("own_id"), F.col("f.properties").alias("properties"),
        F.col("f.geometry").alias("geometry"),
    )


def feature_count_check(features: DataFrame, minimum: int = 20) -> DataFrame:
    """Per file: number of features and whether it reaches the minimum."""
    return features.groupBy("source").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "passed", F.col("n") >= minimum
    )


def with_feature_id(features: DataFrame, level: str) -> DataFrame:
    props = F.col("properties")
    return features.withColumn(
        "feature_id",
        feature_id(F.try_element_at(props, F.lit("ID")), F.try_element_at(props, F.lit("id")),
                   F.col("own_id"), level),
    )


# --- registry -----------------------------------------------------------------

REGISTRY_ENTRY = (
    "struct<op:string,tag_proceso:string,tag_categoria:string,notas:string,"
    "fecha_publicacion:string,institucion:string,tipo_dispositivo:string,"
    "nombre_dispositivo:string,sumilla:string>"
)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Curated registry (JSON): a root list whose entries all name an operation."""
    return registry_entries(
        spark.read.schema(f"resoluciones array<{REGISTRY_ENTRY}>")
        .option("multiLine", True).json(path)
    )


def registry_entries(root: DataFrame) -> DataFrame:
    entries = F.when(F.col("resoluciones").isNotNull(), F.col("resoluciones")).otherwise(
        F.raise_error(F.lit("registry without a list of entries")).cast(f"array<{REGISTRY_ENTRY}>")
    )
    rows = root.select(F.explode(entries).alias("e")).select("e.*")
    return rows.withColumn(
        "op",
        F.when(F.col("op").isNotNull(), F.col("op")).otherwise(
            F.raise_error(F.lit("registry entry without 'op'")).cast("string")
        ),
    )
