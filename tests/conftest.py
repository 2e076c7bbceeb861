from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from scrutiny.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build(
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.driver.extraJavaOptions": "-Duser.timezone=UTC",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny() -> str:
    return "/root/testdata/sf0.001"


@pytest.fixture
def lake(tmp_path) -> str:
    return str(tmp_path / "lake")


HEADER = {
    "idActa": 1, "idEleccion": 10, "codigoMesa": "000001", "codigoEstadoActa": "C",
    "ubigeoDistrito": "140101", "idDistritoElectoral": 15, "idAmbitoGeografico": 1,
    "totalElectoresHabiles": 300, "totalVotosEmitidos": 200, "totalVotosValidos": 180,
    "totalAsistentes": 200, "porcentajeParticipacionCiudadana": 66.67,
}
HEADER_DDL = (
    "idActa bigint, idEleccion bigint, codigoMesa string, codigoEstadoActa string, "
    "ubigeoDistrito string, idDistritoElectoral bigint, idAmbitoGeografico bigint, "
    "totalElectoresHabiles bigint, totalVotosEmitidos bigint, totalVotosValidos bigint, "
    "totalAsistentes bigint, porcentajeParticipacionCiudadana double"
)
VOTES_DDL = (
    "idActa bigint, idEleccion bigint, descripcion string, es_especial boolean, nvotos bigint, "
    "nagrupacionPolitica bigint, ccodigo string, ubigeoDistrito string"
)


@pytest.fixture
def header(spark):
    """Header rows from partial dicts over sensible defaults."""

    def make(*rows: dict):
        names = list(HEADER)
        data = [tuple({**HEADER, "idActa": i + 1, **row}[n] for n in names)
                for i, row in enumerate(rows)]
        return spark.createDataFrame(data, HEADER_DDL)

    return make


@pytest.fixture
def votes(spark):
    """Vote rows (acta, description, special, votes) with the rest filled in."""

    def make(*rows: tuple):
        data = [(acta, 10, text, special, n, i, f"{i:08d}", "140101")
                for i, (acta, text, special, n) in enumerate(rows)]
        return spark.createDataFrame(data, VOTES_DDL)

    return make
