from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from scrutiny import contracts as c
from scrutiny.operators import contract_checks as cc
from scrutiny.operators.unions import union_relaxed


def conforming(spark, table="actas_votos"):
    return spark.createDataFrame([], c.fact_schema(table))


def test_contract_sizes(spark):
    assert {t: len(c.fact_schema(t)) for t in c.FACT_DDL} == {
        "actas_cabecera": 28, "actas_votos": 22, "actas_linea_tiempo": 10, "actas_archivos": 10,
        "actas_candidatos": 11}


@pytest.mark.parametrize("table", list(c.FACT_DDL))
def test_conforming_frames_pass(spark, table):
    assert cc.contract_violations(conforming(spark, table), table) == []


def test_missing_and_mismatch_are_raised(spark):
    df = conforming(spark).drop("nvotos").withColumn("nposicion", F.lit("x"))
    with pytest.raises(cc.ContractError) as error:
        cc.contract_violations(df, "actas_votos")
    assert error.value.table == "actas_votos"
    assert sorted(v.split(":")[0] for v in error.value.violations) == ["mismatch", "missing"]
    assert len(cc.contract_violations(df, "actas_votos", strict=False)) == 2


def test_extra_columns_only_warn(spark, caplog):
    df = conforming(spark).withColumn("nuevo", F.lit(1))
    assert cc.contract_violations(df, "actas_votos") == []
    assert "nuevo" in caplog.text


def test_allowed_null_columns(spark):
    df = conforming(spark).withColumn("cargo", F.lit(None))
    assert cc.contract_violations(df, "actas_votos", allowed_null=["cargo"]) == []
    assert cc.contract_violations(df, "actas_votos", strict=False) != []


def test_unknown_table(spark):
    with pytest.raises(KeyError):
        cc.contract_violations(conforming(spark), "nope")


def test_coercion_uses_the_contract_then_text(spark):
    df = spark.range(1).select(F.lit(None).alias("nvotos"), F.lit(None).alias("es_especial"),
                               F.lit(None).alias("otra"), F.lit(1).alias("x"))
    kinds = dict(cc.coerce_null_columns(df, "actas_votos").dtypes)
    assert kinds == {"nvotos": "bigint", "es_especial": "boolean", "otra": "string", "x": "int"}
    assert dict(cc.coerce_null_columns(df).dtypes)["nvotos"] == "string"


def test_required_columns(spark):
    with pytest.raises(cc.ContractError, match="idDistritoElectoral"):
        cc.require_columns(spark.range(1), ["idDistritoElectoral"], "enrich first")


def test_relaxed_union_keeps_text(spark):
    numbers = spark.createDataFrame([(1,)], "v bigint")
    texts = spark.createDataFrame([("01", 2)], "v string, w bigint")
    out = union_relaxed([numbers, texts])
    assert dict(out.dtypes) == {"v": "string", "w": "bigint"}
    assert sorted(map(tuple, out.collect()), key=str) == [("01", 2), ("1", None)]
