"""Which version of a row counts: last run, last snapshot, last record, last N."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def latest_runs(facts: DataFrame, key: str = "idActa", run: str = "run_ts_ms") -> DataFrame:
    """One row per key with its newest run.

    A plain maximum: partial aggregation reduces a hot key inside each task before
    anything is shuffled.
    """
    return facts.groupBy(key).agg(F.max(run).alias(run))


def keep_runs(facts: DataFrame, winners: DataFrame, key: str = "idActa",
              run: str = "run_ts_ms") -> DataFrame:
    """All rows of the winning run, several if the run holds several.

    A left-semi join rather than a window: a key with a third of the rows is one sort
    group for a window, while adaptive execution splits the probe side of this join.
    Winners are as many as there are keys: a compressed scan may look small enough to be
    broadcast, which would bring all of them to the driver, so the join is a merge.
    """
    return facts.join(winners.select(key, run).hint("merge"), [key, run], "left_semi")


def last_snapshot(df: DataFrame, ts: str = "snapshot_ts_ms") -> DataFrame:
    """Rows of the newest snapshot only; the maximum is a scalar subquery."""
    newest = df.select(F.max(ts).alias("newest"))
    return df.filter(F.col(ts) == newest.scalar())


def last_snapshots(df: DataFrame, n: int, ts: str = "snapshot_ts_ms") -> DataFrame:
    """The newest ``n`` snapshots in time order, one row per timestamp."""
    rest = [name for name in df.columns if name != ts]
    one_each = df.groupBy(ts).agg(
        F.min(F.struct(*rest)).alias("row")
    ).select(ts, *[F.col("row")[name].alias(name) for name in rest])
    return one_each.orderBy(F.col(ts).desc()).limit(n).orderBy(F.col(ts).asc())


def last_record(df: DataFrame, keys: Sequence[str], ts: str = "snapshot_ts_ms") -> DataFrame:
    """The newest record of each key; equal timestamps fall back to the largest row.

    The maximum of a struct is combined map-side, so repeated snapshots of one key
    never meet in a single task.
    """
    rest = [name for name in df.columns if name not in keys and name != ts]
    return (
        df.groupBy(*keys)
        .agg(F.max(F.struct(ts, *rest)).alias("row"))
        .select(*keys, F.col("row")[ts].alias(ts),
                *[F.col("row")[name].alias(name) for name in rest])
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first record of each key in a stated order, nulls last."""
    rest = [name for name in df.columns if name not in keys]
    ranked = [F.col(name) for name in order]
    # min() of a struct puts nulls first; the flags in front put them last.
    flagged = [x for col in ranked for x in (col.isNull(), col)]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*flagged, F.struct(*rest))).alias("row"))
        .select(*keys, *[F.col("row")[name].alias(name) for name in rest])
    )
