"""Key universes: tasks, shards, what is left to do, what is new."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutiny import contracts as c
from scrutiny.functions.scalars import acta_id, shard_of


def station_tasks(stations: DataFrame, elections: Iterable[int] = c.ELECTIONS) -> DataFrame:
    """Every station times every election, with the acta id.

    The elections are a short constant list, so each row is exploded in place: no join.
    """
    codes = F.array(*[F.lit(e).cast("bigint") for e in elections])
    return (
        stations.select(
            F.col("idMesa").cast("bigint").alias("idMesa"),
            F.col("ubigeoDistrito").cast("string").alias("ubigeoDistrito"),
            F.explode(codes).alias("idEleccion"),
        )
        .withColumn("idActa", acta_id("idMesa", "ubigeoDistrito", "idEleccion"))
        .select("idActa", "idMesa", "ubigeoDistrito", "idEleccion")
    )


def in_shard(df: DataFrame, key: str | Column, shard: int, shards: int) -> DataFrame:
    """Rows of one shard. Shards are disjoint and together complete."""
    if not 0 <= shard < shards:
        raise ValueError(f"shard {shard}/{shards}: must be 0 <= shard < shards")
    return df.filter(shard_of(key, shards) == shard)


def first_tasks(tasks: DataFrame, n: int, order: Sequence[str] = ("idActa",)) -> DataFrame:
    return tasks.orderBy(*order).limit(n)


def pending(tasks: DataFrame, done: DataFrame, keys: Sequence[str] = ("idActa",)) -> DataFrame:
    """Tasks that are not done yet.

    The other side is made distinct first, here and below: it is combined map-side, so a
    key that was recorded very often does not weigh on the join.
    """
    return tasks.join(done.select(*keys).distinct(), list(keys), "left_anti")


def not_in(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not known yet (set difference of keys)."""
    return df.join(known.select(key).distinct(), key, "left_anti")


def only_in(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key another table holds; ids are never collected."""
    return df.join(ids.select(key).distinct(), key, "left_semi")
