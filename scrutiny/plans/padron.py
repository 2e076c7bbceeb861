"""Voter-roll demographics: totals per district at home and per country abroad."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutiny import contracts as c
from scrutiny.functions.aggregates import total, total_where
from scrutiny.functions.scalars import age_band
from scrutiny.operators.unions import union_all

# Columns of the roll table and the words used in its sources.
HOME, ABROAD = "Nacional", "Extranjero"
PLACE_COLUMNS = ("ubigeo_reniec", "ubigeo_inei", "residencia", "pais_codigo", "pais_nombre",
                 "departamento", "provincia", "distrito")
BANDS = ("18_25", "26_35", "36_45", "46_60", "61_plus")
MEASURES = ("total_electores", "hombres", "mujeres", "dni_electronico", "dni_convencional",
            *(f"rango_{b}" for b in BANDS))


def _voters(roll: DataFrame) -> DataFrame:
    return roll.filter(F.col("Edad") >= c.MIN_VOTING_AGE)


def _measures() -> list[Column]:
    amount = F.col("Cantidad")
    return [
        total(amount).alias("total_electores"),
        total_where(F.col("Sexo") == "Hombre", amount).alias("hombres"),
        total_where(F.col("Sexo") == "Mujer", amount).alias("mujeres"),
        total_where(F.col("TipoDNI") == "DNI electrónico", amount).alias("dni_electronico"),
        total_where(F.col("TipoDNI") == "DNI convencional", amount).alias("dni_convencional"),
        *[total_where(F.col("_band") == b, amount).alias(f"rango_{b}") for b in BANDS],
    ]


def roll_by_place(base: DataFrame) -> DataFrame:
    """Voters of age by district (home) and by country (abroad): 18 columns."""
    voters = _voters(base).withColumn("_band", age_band("Edad"))
    blank = F.lit("")
    home = (
        voters.filter(F.col("Residencia") == HOME)
        .groupBy("UBIGEO_RENIEC", "UBIGEO_INEI", "Departamento", "Provincia", "Distrito")
        .agg(*_measures())
        .select(
            F.col("UBIGEO_RENIEC").alias("ubigeo_reniec"),
            F.col("UBIGEO_INEI").alias("ubigeo_inei"),
            F.lit(HOME).alias("residencia"), blank.alias("pais_codigo"),
            F.lit("Perú").alias("pais_nombre"), F.col("Departamento").alias("departamento"),
            F.col("Provincia").alias("provincia"), F.col("Distrito").alias("distrito"), *MEASURES,
        )
    )
    abroad = (
        voters.filter(F.col("Residencia") == ABROAD)
        .groupBy("CodPais", "Pais")
        .agg(*_measures())
        .select(
            blank.alias("ubigeo_reniec"), blank.alias("ubigeo_inei"),
            F.lit(ABROAD).alias("residencia"), F.col("CodPais").alias("pais_codigo"),
            F.col("Pais").alias("pais_nombre"), blank.alias("departamento"),
            blank.alias("provincia"), F.col("Pais").alias("distrito"), *MEASURES,
        )
    )
    return union_all([home, abroad])


def validity_by_place(validity: DataFrame) -> DataFrame:
    """Valid and expired documents of voters by district (home) and country (abroad)."""
    home = F.col("Residencia") == HOME
    amount = F.col("Cantidad")
    return (
        _voters(validity).filter(F.col("Residencia").isin(HOME, ABROAD))
        .groupBy(
            F.when(home, F.col("UBIGEO_RENIEC")).otherwise(F.lit("")).alias("ubigeo_reniec"),
            F.when(home, F.lit("")).otherwise(F.col("CodPais")).alias("pais_codigo"),
            F.col("Residencia").alias("_residence"),
        )
        .agg(
            total_where(F.col("Caducado") == "Vigente", amount).alias("vigentes"),
            total_where(F.col("Caducado") == "Caducado", amount).alias("caducados"),
        )
        .drop("_residence")
    )


def merge_validity(roll: DataFrame, validity: DataFrame) -> DataFrame:
    """Every roll row with its validity figures, 0 where the second file has none."""
    joined = roll.join(validity, ["ubigeo_reniec", "pais_codigo"], "left")
    return joined.select(
        *roll.columns,
        F.coalesce("vigentes", F.lit(0)).alias("vigentes"),
        F.coalesce("caducados", F.lit(0)).alias("caducados"),
    )


def unmatched_places(roll: DataFrame, validity: DataFrame) -> DataFrame:
    """One row: places without validity figures (their zeros may not be real)."""
    missing = roll.join(validity, ["ubigeo_reniec", "pais_codigo"], "left_anti")
    return missing.agg(F.count(F.lit(1)).alias("unmatched"))


def roll_summary(roll: DataFrame, label: str, base_total: Column | int) -> DataFrame:
    """One row of totals at home and abroad and the difference to a base total."""
    home, abroad = F.col("residencia") == HOME, F.col("residencia") == ABROAD
    base = base_total if isinstance(base_total, Column) else F.lit(base_total)
    sums = roll.agg(
        total_where(home, "total_electores").alias("total_peru"),
        total_where(abroad, "total_electores").alias("total_extranjero"),
        F.count_if(home).alias("distritos_peru"),
        F.count_if(abroad).alias("paises_extranjero"),
    )
    whole = F.col("total_peru") + F.col("total_extranjero")
    return sums.select(
        F.lit(label).alias("trimestre"), whole.alias("total_electores"), "total_peru",
        "total_extranjero", "distritos_peru", "paises_extranjero",
        (whole - base).alias("delta_vs_base"),
    )


def build_roll(base: DataFrame, validity: DataFrame, label: str) -> DataFrame:
    """The roll table: demographics, validity and the label of its source."""
    return merge_validity(roll_by_place(base), validity_by_place(validity)).withColumn(
        "fuente_trimestre", F.lit(label)
    )
