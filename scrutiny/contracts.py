"""Table contracts and domain constants shared by every job."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values -------------------------------------------------------------
# Codes, thresholds and column contracts that the published tables are defined by.

ELECTION_PRESIDENT = 10
ELECTION_ANDEAN_PARLIAMENT = 12
ELECTION_DEPUTIES = 13
ELECTION_SENATE_REGIONAL = 14
ELECTION_SENATE_NATIONAL = 15
NATIONAL_ELECTIONS = (10, 12, 15)
REGIONAL_ELECTIONS = (13, 14)
ELECTIONS = (10, 12, 13, 14, 15)

SCOPE_HOME = 1
SCOPE_ABROAD = 2
ABROAD_DISTRICT = 27

STATE_COUNTED = "C"
VOLATILE_STATES = ("P", "E")

SPECIAL_ROWS = ("VOTOS EN BLANCO", "VOTOS NULOS", "VOTOS IMPUGNADOS")

STATION_UNIVERSE = 92_766
ACTA_UNIVERSE = 463_830
ABROAD_UNIVERSE = 2_543
DETAIL_ROWS_PER_ACTA = 41
MIN_VOTING_AGE = 18

SEVERITY_RANK = {"CRITICAL": 0, "HIGH": 1, "MEDIUM": 2}
UNKNOWN_SEVERITY_RANK = 99
OUTLIER_Z = 3.0
SUM_TOLERANCE = 1
CONCENTRATION_RATIO = 0.95
ROLL_MARGIN = 0.05

LIMA_UTC_OFFSET_HOURS = -5

ENRICH_COLUMNS = (
    "idAmbitoGeografico",
    "ubigeoDepartamento",
    "ubigeoProvincia",
    "nombreDistrito",
    "idDistritoElectoral",
)

_STAMP = "snapshot_ts_ms bigint, snapshot_lima_iso string"
_CHILD_KEY = "idActa bigint, idEleccion bigint, ubigeoDistrito string"

FACT_DDL = {
    "actas_cabecera": (
        "id bigint, codigoMesa string, descripcionMesa string, idEleccion bigint, "
        "ubigeoNivel01 string, ubigeoNivel02 string, ubigeoNivel03 string, "
        "centroPoblado string, nombreLocalVotacion string, "
        "totalElectoresHabiles bigint, totalVotosEmitidos bigint, "
        "totalVotosValidos bigint, totalAsistentes bigint, "
        "porcentajeParticipacionCiudadana double, estadoActa string, "
        "estadoComputo string, codigoEstadoActa string, descripcionEstadoActa string, "
        "estadoActaResolucion string, estadoDescripcionActaResolucion string, "
        "descripcionSubEstadoActa string, codigoSolucionTecnologica bigint, "
        "descripcionSolucionTecnologica string, idActa bigint, idMesaRef bigint, "
        "ubigeoDistrito string, " + _STAMP
    ),
    "actas_votos": (
        _CHILD_KEY + ", descripcion string, es_especial boolean, ccodigo string, "
        "nposicion bigint, nvotos bigint, nagrupacionPolitica bigint, "
        "nporcentajeVotosValidos double, nporcentajeVotosEmitidos double, "
        "estado bigint, grafico bigint, cargo string, sexo string, "
        "totalCandidatos bigint, cand_apellido_paterno string, "
        "cand_apellido_materno string, cand_nombres string, cand_doc string, " + _STAMP
    ),
    "actas_linea_tiempo": (
        _CHILD_KEY + ", evento_idx bigint, codigoEstadoActa string, "
        "descripcionEstadoActa string, descripcionEstadoActaResolucion string, "
        "fechaRegistro bigint, " + _STAMP
    ),
    "actas_archivos": (
        _CHILD_KEY + ", archivoId string, tipo bigint, nombre string, "
        "descripcion string, daudFechaCreacion bigint, " + _STAMP
    ),
    "actas_candidatos": (
        _CHILD_KEY + ", partido_ccodigo string, candidato_idx bigint, "
        "apellidoPaterno string, apellidoMaterno string, nombres string, "
        "cdocumentoIdentidad string, " + _STAMP
    ),
}

_CANDIDATE_DDL = (
    "struct<apellidoPaterno:string,apellidoMaterno:string,nombres:string,"
    "cdocumentoIdentidad:string>"
)

# The landed document: header fields plus three arrays.
DOCUMENT_DDL = (
    "id bigint, codigoMesa string, descripcionMesa string, idEleccion bigint, "
    "ubigeoNivel01 string, ubigeoNivel02 string, ubigeoNivel03 string, "
    "centroPoblado string, nombreLocalVotacion string, "
    "totalElectoresHabiles bigint, totalVotosEmitidos bigint, "
    "totalVotosValidos bigint, totalAsistentes bigint, "
    "porcentajeParticipacionCiudadana double, estadoActa string, "
    "estadoComputo string, codigoEstadoActa string, descripcionEstadoActa string, "
    "estadoActaResolucion string, estadoDescripcionActaResolucion string, "
    "descripcionSubEstadoActa string, codigoSolucionTecnologica bigint, "
    "descripcionSolucionTecnologica string, "
    "detalle array<struct<descripcion:string,estado:bigint,grafico:bigint,"
    "cargo:string,sexo:string,totalCandidatos:bigint,ccodigo:string,"
    "nposicion:bigint,nvotos:bigint,nagrupacionPolitica:bigint,"
    "nporcentajeVotosValidos:double,nporcentajeVotosEmitidos:double,"
    f"candidato:array<{_CANDIDATE_DDL}>>>, "
    "lineaTiempo array<struct<codigoEstadoActa:string,descripcionEstadoActa:string,"
    "descripcionEstadoActaResolucion:string,fechaRegistro:bigint>>, "
    "archivos array<struct<id:string,tipo:bigint,nombre:string,descripcion:string,"
    "daudFechaCreacion:bigint>>"
)

AGGREGATE_TABLES = (
    "resumen_elecciones",
    "mesa_totales",
    "ultima_fecha",
    "totales",
    "totales_de",
    "participantes",
    "participantes_de",
    "mapa_calor",
)

# Ordered: the first prefix that matches a party name wins.
PARTY_COLORS = (
    ("FUERZA POPULAR", "#ff6b35"),
    ("JUNTOS POR EL PERÚ", "#e63946"),
    ("RENOVACIÓN POPULAR", "#118ab2"),
    ("PARTIDO DEL BUEN GOBIERNO", "#06a77d"),
    ("PARTIDO CÍVICO OBRAS", "#ffd166"),
    ("PARTIDO PAÍS PARA TODOS", "#8338ec"),
    ("AHORA NACIÓN - AN", "#a78bfa"),
    ("PRIMERO LA GENTE", "#ef476f"),
    ("PARTIDO SICREO", "#264653"),
    ("PARTIDO FRENTE DE LA ESPERANZA 2021", "#2a9d8f"),
    ("VOTEMOS PERÚ", "#f77f00"),
    ("ALIANZA PARA EL PROGRESO", "#fca311"),
    ("ACCIÓN POPULAR", "#d62828"),
)
DEFAULT_COLOR = "#95a5a6"
TURNOUT_CLASSES = ((80, "ge_80"), (75, "ge_75"), (70, "ge_70"), (65, "ge_65"),
                   (60, "ge_60"), (50, "ge_50"))

# Release package: (layer, table, required).
RELEASE_TABLES = (
    ("curated", "actas_cabecera", True),
    ("curated", "actas_votos", True),
    ("curated", "actas_votos_tidy", False),
    ("curated", "actas_candidatos", False),
    ("curated", "actas_linea_tiempo", False),
    ("curated", "actas_archivos", False),
    ("dim", "mesas", True),
    ("dim", "distritos_electorales", True),
    ("dim", "distritos", False),
    ("dim", "departamentos", False),
    ("dim", "provincias", False),
    ("dim", "locales", False),
    ("dim", "padron", False),
    ("dim", "resoluciones", False),
    ("analytics", "anomalias", False),
)
# --- End of fixed values ------------------------------------------------------


def schema(ddl: str) -> T.StructType:
    """Parse a DDL column list (a session must be running)."""
    return T.StructType.fromDDL(ddl)


def fact_schema(table: str) -> T.StructType:
    """The contract of one fact table; unknown names raise ``KeyError``."""
    return schema(FACT_DDL[table])

