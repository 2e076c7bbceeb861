"""Roll-ups by place and pivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutiny.functions.scalars import place_prefix

LEVELS = ("department", "province", "district")


def by_place(df: DataFrame, sums: Mapping[str, Column], extra: Sequence[str] = (),
             code: str = "ubigeoDistrito") -> DataFrame:
    """Add up measures at department, province and district level in one pass.

    The rows are first added up per district (map-side combined, so a hot district is
    reduced before the shuffle); only that small result is expanded to three levels.
    Every measure must be a sum or a count of rows given as a column to add up.
    """
    district = df.groupBy(F.substring(code, 1, 6).alias("_place"), *extra).agg(
        *[F.coalesce(F.sum(col), F.lit(0)).alias(name) for name, col in sums.items()]
    )
    return up_from_district(district, list(sums), extra, "_place")


def up_from_district(district: DataFrame, measures: Sequence[str], extra: Sequence[str],
                     place: str) -> DataFrame:
    levels = F.explode(
        F.array(
            *[
                F.struct(F.lit(level).alias("level"), place_prefix(place, level).alias("place"))
                for level in LEVELS
            ]
        )
    )
    return (
        district.select(levels.alias("_l"), *extra, *measures)
        .select("_l.level", "_l.place", *extra, *measures)
        .groupBy("level", "place", *extra)
        .agg(*[F.sum(name).alias(name) for name in measures])
    )


def state_matrix(header: DataFrame, states: Sequence[str] = ("C", "E", "P")) -> DataFrame:
    """Actas per election (rows) and state (columns), 0 where there are none."""
    wide = header.groupBy("idEleccion").pivot("codigoEstadoActa", list(states)).agg(
        F.count(F.lit(1))
    )
    filled = [F.coalesce(F.col(s), F.lit(0)).alias(s) for s in states]
    total = sum((F.coalesce(F.col(s), F.lit(0)) for s in states), F.lit(0).cast("bigint"))
    return wide.select("idEleccion", *filled, total.alias("total"))
