"""Winners, top-k, shares of a total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def winners(totals: DataFrame, keys: Sequence[str], votes: str, tie_break: str) -> DataFrame:
    """Row with most votes per key; equal votes go to the smaller tie-break value, and rows
    equal in that too to the one whose other columns come first.

    Written as an aggregate (combined map-side), not as a sorted window.
    """
    rest = [name for name in totals.columns if name not in keys]
    order = F.struct((-F.col(votes)).alias("neg"), F.col(tie_break).alias("tie"),
                     *[F.col(name).alias(f"rest_{name}") for name in rest])
    return (
        totals.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), order).alias("row"))
        .select(*keys, *[F.col("row")[name].alias(name) for name in rest])
    )


def top_per_group(totals: DataFrame, keys: Sequence[str], order: Sequence[Column],
                  k: int) -> DataFrame:
    """Top ``k`` rows per key with their rank.

    The filter on the rank lets Spark cut every group to ``k`` rows before the shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return totals.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def top(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Global top ``k``: each task keeps ``k`` rows, the driver merges them."""
    return df.orderBy(*order).limit(k)


def share_of_group(totals: DataFrame, keys: Sequence[str], value: str, total: str,
                   pct: str) -> DataFrame:
    """Add the group's total and each row's percentage of it.

    Meant for frames that are aggregated already, where a group is as long as the list
    of parties. A group without votes has no share.
    """
    window = Window.partitionBy(*keys)
    out = totals.withColumn(total, F.sum(value).over(window))
    return out.withColumn(pct, F.try_divide(F.col(value) * F.lit(100.0), F.col(total)))


def share_of_all(counts: DataFrame, value: str, pct: str) -> DataFrame:
    """Each row's percentage of the whole frame (a small aggregated frame)."""
    whole = counts.select(F.sum(value).alias("whole"))
    return counts.withColumn(
        pct, F.try_divide(F.col(value) * F.lit(100.0), whole.scalar())
    )
