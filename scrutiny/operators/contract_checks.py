"""Schema contract: null-type coercion, violations, required columns."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrutiny import contracts as c

log = logging.getLogger(__name__)


class ContractError(ValueError):
    """A frame does not meet its table's contract."""

    def __init__(self, table: str, violations: Sequence[str]) -> None:
        super().__init__(f"table {table!r}: {len(violations)} violation(s): " + "; ".join(violations))
        self.table = table
        self.violations = list(violations)


def coerce_null_columns(df: DataFrame, table: str | None = None) -> DataFrame:
    """Give every untyped (all-null) column the contract's type, else string."""
    target = {f.name: f.dataType for f in c.fact_schema(table)} if table else {}
    return df.select(
        *[
            F.col(f"`{f.name}`").cast(target.get(f.name, T.StringType())).alias(f.name)
            if isinstance(f.dataType, T.NullType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def contract_violations(
    df: DataFrame, table: str, *, strict: bool = True, allowed_null: Iterable[str] = ()
) -> list[str]:
    """Compare a frame's columns with the contract; metadata only, nothing runs.

    Missing columns and other types are violations (raised when ``strict``); columns
    beyond the contract are only logged.
    """
    wanted = {f.name: f.dataType for f in c.fact_schema(table)}
    found = {f.name: f.dataType for f in df.schema.fields}
    nulls_ok = set(allowed_null)
    violations = [f"missing: {name}" for name in wanted if name not in found]
    for name, kind in wanted.items():
        have = found.get(name)
        if have is None or have == kind:
            continue
        if isinstance(have, T.NullType) and name in nulls_ok:
            continue
        violations.append(
            f"mismatch: {name} expected {kind.simpleString()} got {have.simpleString()}"
        )
    extra = [name for name in found if name not in wanted]
    if extra:
        log.warning("table %s: columns beyond the contract: %s", table, extra)
    if violations and strict:
        raise ContractError(table, violations)
    return violations


def contract_report(df: DataFrame, table: str) -> DataFrame:
    """The same comparison as rows: kind (missing, mismatch, extra), column, types."""
    wanted = {f.name: f.dataType.simpleString() for f in c.fact_schema(table)}
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for name in {**wanted, **found}:
        want, have = wanted.get(name), found.get(name)
        if want == have:
            continue
        kind = "missing" if have is None else "extra" if want is None else "mismatch"
        rows.append((table, kind, name, want, have))
    spark: SparkSession = df.sparkSession
    return spark.createDataFrame(
        rows, "table_name string, kind string, column_name string, expected string, found string"
    )


def conform(df: DataFrame, table: str) -> DataFrame:
    """Cast to the contract's columns, in its order; absent ones become typed nulls."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in c.fact_schema(table)
        ]
    )


def require_columns(df: DataFrame, columns: Iterable[str], hint: str = "") -> DataFrame:
    """The frame itself, or a clear error naming what is missing."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ContractError("input", [f"missing: {m}" for m in missing] + ([hint] if hint else []))
    return df


def is_enriched(df: DataFrame) -> bool:
    return {"idDistritoElectoral", "idAmbitoGeografico"} <= set(df.columns)
