from __future__ import annotations

import pytest

from scrutiny.plans import padron
from scrutiny.sinks.tables import write_csv
from scrutiny.sources.files import read_csv_typed, read_official_csv, read_roll

BASE = """Residencia,Cod_continente,Continente,CodPais,Pais,UBIGEO_RENIEC,UBIGEO_INEI,Departamento,Provincia,Distrito,TipoDNI,Sexo,Edad,Cantidad
Nacional,1,AMERICA,9233,PERU,140101,150101,LIMA,LIMA,LIMA,DNI electrónico,Hombre,18,2
Nacional,1,AMERICA,9233,PERU,140101,150101,LIMA,LIMA,LIMA,DNI convencional,Hombre,25,1
Nacional,1,AMERICA,9233,PERU,140101,150101,LIMA,LIMA,LIMA,DNI electrónico,Mujer,61,5
Nacional,1,AMERICA,9233,PERU,140101,150101,LIMA,LIMA,LIMA,DNI electrónico,Mujer,17,50
Nacional,1,AMERICA,9233,PERU,010101,010101,AMAZONAS,CHACHAPOYAS,CHACHAPOYAS,DNI convencional,Mujer,40,7
Extranjero,2,AMERICA,0301,ARGENTINA, , , , , ,DNI electrónico,Mujer,30,4
"""
VALIDITY = """Residencia,Cod_continente,Continente,CodPais,Pais,UBIGEO_RENIEC,UBIGEO_INEI,Departamento,Provincia,Distrito,Sexo,Edad,Caducado,Cantidad
Nacional,1,AMERICA,9233,PERU,140101,150101,LIMA,LIMA,LIMA,Hombre,20,Vigente,6
Nacional,1,AMERICA,9233,PERU,140101,150101,LIMA,LIMA,LIMA,Mujer,70,Caducado,2
Nacional,1,AMERICA,9233,PERU,140101,150101,LIMA,LIMA,LIMA,Mujer,3,Caducado,9
Extranjero,2,AMERICA,0301,ARGENTINA, , , , , ,Mujer,30,Vigente,4
"""


@pytest.fixture
def rolls(spark, tmp_path):
    for name, text in (("base", BASE), ("validity", VALIDITY)):
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    return [read_roll(spark, str(tmp_path / f"{n}.csv")) for n in ("base", "validity")]


def test_roll(spark, rolls):
    base, validity = rolls
    table = padron.build_roll(base, validity, "2026_03")
    by_place = {r.ubigeo_reniec or r.pais_codigo: r for r in table.collect()}
    lima = by_place["140101"]
    assert (lima.total_electores, lima.hombres, lima.mujeres) == (8, 3, 5)
    assert (lima.rango_18_25, lima.rango_61_plus, lima.dni_electronico, lima.dni_convencional) == (3, 5, 7, 1)
    assert (lima.vigentes, lima.caducados, lima.pais_nombre) == (6, 2, "Perú")
    away = by_place["0301"]
    assert (away.residencia, away.total_electores, away.distrito, away.vigentes) == ("Extranjero", 4, "ARGENTINA", 4)
    empty = by_place["010101"]
    assert (empty.vigentes, empty.caducados) == (0, 0)
    for r in by_place.values():
        assert sum(r[f"rango_{b}"] for b in padron.BANDS) == r.total_electores == r.hombres + r.mujeres
    assert padron.unmatched_places(padron.roll_by_place(base), padron.validity_by_place(validity)).first()[0] == 1
    summary = padron.roll_summary(table, "2026_03", 19).first()
    assert tuple(summary) == ("2026_03", 19, 15, 4, 2, 1, 0)


def test_official_csv_in_either_encoding(spark, tmp_path):
    for encoding in ("utf-8", "utf-8-sig", "latin-1"):
        path = tmp_path / f"{encoding}.csv"
        path.write_bytes("año,votos\nñandú,3\nx,\n".encode(encoding))
        df = read_official_csv(spark, str(path))
        assert df.columns == ["año", "votos"]
        assert [tuple(r) for r in df.collect()] == [("ñandú", 3), ("x", None)]


def test_late_values_of_another_type_are_kept(spark, tmp_path):
    path = tmp_path / "late.csv"
    path.write_text("n,x,b,t\n" + "1,1.5,true,a\n" * 60_000 + "A0,2,no,b\n", encoding="utf-8")
    df = read_official_csv(spark, str(path))
    assert [k for _, k in df.dtypes] == ["string", "double", "string", "string"]
    assert tuple(df.filter("t = 'b'").first()) == ("A0", 2.0, "no", "b")


def test_files_of_a_folder_may_differ(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("id,texto\n1,ñandú\n".encode("latin-1"))
    (tmp_path / "b.csv").write_bytes("texto,id\nñu,2\n".encode())
    (tmp_path / "c.csv").write_bytes('id,texto\n3,"dos\nlíneas, ""así"""\n4, \n5,"  x "\n'.encode())
    rows = {r.id: r.texto for r in read_official_csv(spark, str(tmp_path)).collect()}
    assert rows == {1: "ñandú", 2: "ñu", 3: 'dos\nlíneas, "así"', 4: " ", 5: "  x "}


def test_csv_comes_back_as_written(spark, lake):
    rows = [(1, ""), (2, None), (3, " "), (4, 'say "hi", ok'), (5, "a\nb\n"), (6, "\\"), (7, '\\"'),
            (8, "  x  "), (9, '"'), (10, ",")]
    write_csv(spark.createDataFrame(rows, "id bigint, t string"), lake)
    back = read_csv_typed(spark, lake, {"id": "bigint"})
    assert sorted(map(tuple, back.collect())) == rows
