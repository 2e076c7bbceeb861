"""Row filters that carry a rule of their own."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutiny import contracts as c
from scrutiny.functions.scalars import severity_rank


def selection(
    *,
    elections: Iterable[int] | None = None,
    districts: Iterable[int] | None = None,
    departments: Iterable[str] | None = None,
    provinces: Iterable[str] | None = None,
    places: Iterable[str] | None = None,
    parties: Iterable[str] | None = None,
    scope: int | None = None,
    state: str | None = None,
) -> list[Column]:
    """Predicates for up to eight optional filters; an absent one adds nothing."""
    lists = {
        "idEleccion": elections,
        "idDistritoElectoral": districts,
        "ubigeoDepartamento": departments,
        "ubigeoProvincia": provinces,
        "ubigeoDistrito": places,
        "ccodigo": parties,
    }
    predicates = [F.col(name).isin(*values) for name, values in lists.items() if values]
    if scope:
        predicates.append(F.col("idAmbitoGeografico") == scope)
    if state:
        predicates.append(F.col("codigoEstadoActa") == state)
    return predicates


def apply_selection(df: DataFrame, predicates: list[Column]) -> DataFrame:
    return df.filter(reduce(and_, predicates)) if predicates else df


def in_states(df: DataFrame, states: Iterable[str] = c.VOLATILE_STATES) -> DataFrame:
    return df.filter(F.col("codigoEstadoActa").isin(*states))


def in_scopes(df: DataFrame, scopes: Iterable[int] = (1, 2)) -> DataFrame:
    """Keep the given scopes; a catalogue from before scopes existed is all home."""
    if "idAmbitoGeografico" not in df.columns:
        return df.withColumn("idAmbitoGeografico", F.lit(c.SCOPE_HOME).cast("bigint"))
    return df.filter(F.col("idAmbitoGeografico").isin(*scopes))


def at_least_severity(df: DataFrame, minimum: str) -> DataFrame:
    return df.filter(severity_rank("severidad") <= c.SEVERITY_RANK[minimum])


def drop_run_columns(df: DataFrame) -> DataFrame:
    """Without the partition columns; absent ones are no error."""
    return df.drop("snapshot_date", "run_ts_ms", "batch_id")


def drop_legacy(df: DataFrame) -> DataFrame:
    """Without the station column of old files, which was never filled."""
    return df.drop("idMesa")
