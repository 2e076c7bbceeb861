"""Parquet sources: curated tables, snapshot series, versioned facts, drifted files."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrutiny import contracts as c
from scrutiny.operators.unions import union_relaxed

#: Run-versioned facts: partition columns, pinned so that dates stay text.
RUN_PARTITIONS = "snapshot_date string, run_ts_ms bigint"

#: Time of a snapshot in a time series once more, under a name that does not depend on the table.
SNAPSHOT = "snapshot"

#: Number of the append that wrote a snapshot: a partition below the day's. A later append of the
#: same snapshot counts instead of the earlier one.
APPEND = "append"
#: Folder in a series with a file for each append.
APPENDS = "_appends"

_FOOTERS_PER_TASK = 256


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One table; only the named columns reach the scan."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_series(spark: SparkSession, base: str, merge: bool = False) -> DataFrame:
    """All snapshots of a time-series fact. ``merge`` adds columns of newer files.

    Of a snapshot that was appended again only the last copy counts.
    """
    from scrutiny.sinks.commits import folder_names

    df = _series(spark, base, merge)
    if APPEND in df.columns and len(folder_names(spark, f"{base.rstrip('/')}/{APPENDS}")) != 1:
        times = df.groupBy(F.col(SNAPSHOT).alias("_time")).agg(
            F.min(APPEND).alias("_first"), F.max(APPEND).alias("_last"))
        again = times.where("_first < _last").hint("merge")
        df = df.join(again, F.col(SNAPSHOT).eqNullSafe(F.col("_time"))
                     & (F.col(APPEND) < F.col("_last")), "left_anti")
    return df.drop(SNAPSHOT, APPEND)


def _series(spark: SparkSession, base: str, merge: bool = False) -> DataFrame:
    reader = spark.read.option("mergeSchema", str(merge).lower())
    df = reader.parquet(base)
    if "snapshot_date" in df.columns:
        df = df.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))
    return df


def read_newest(spark: SparkSession, base: str, n: int = 1) -> DataFrame:
    """Rows of the newest ``n`` snapshots of a series written by ``append_snapshot``.

    The newest days are known from folder names, and which of their snapshots count from one
    narrow aggregate over them; the scan opens the partitions of those only.
    """
    from scrutiny.sinks.commits import folder_names

    df = _series(spark, base)
    days = [d.partition("=")[2] for d in reversed(folder_names(spark, base.rstrip("/")))
            if re.fullmatch(r"snapshot_date=[-+\d]+", d)]
    found, take = [], max(n, 1)
    while len(found) < n:  # a day has one snapshot at least, unless its write was broken off
        found = (df.where(F.col("snapshot_date").isin(days[:take]) & F.col(SNAPSHOT).isNotNull())
                 .groupBy("snapshot_date", SNAPSHOT).agg(F.max(APPEND).alias(APPEND))
                 .orderBy(F.col(SNAPSHOT).desc()).limit(n).collect())
        if take >= len(days):
            break
        take *= 2
    wanted: dict[tuple[str, int], list[int]] = {}
    for row in found:
        wanted.setdefault((row["snapshot_date"], row[APPEND]), []).append(row[SNAPSHOT])
    match = F.lit(False)
    for (_, append), times in wanted.items():
        match = match | ((F.col(APPEND) == append) & F.col(SNAPSHOT).isin(times))
    return df.where(
        F.col("snapshot_date").isin([d for d, _ in wanted]) & F.col(APPEND).isin([a for _, a in wanted])
        & match).drop(SNAPSHOT, APPEND)


def read_facts(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Versioned facts whose files meet the contract (all that this package wrote)."""
    fields = c.fact_schema(table).fields + c.schema(RUN_PARTITIONS).fields
    return spark.read.schema(T.StructType(fields)).parquet(base)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether any Parquet file lies at or under a path."""
    return bool(list_files(spark, path).limit(1).head(1))


def list_files(spark: SparkSession, base: str, pattern: str = "*.parquet") -> DataFrame:
    """Files under a folder with size and time; contents are not read."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(base)
        .select("path", "length", "modificationTime")
    )


#: Parquet types whose Spark type has another name than the Arrow library's.
_UNSIGNED = {"uint8": "smallint", "uint16": "int", "uint32": "bigint", "uint64": "decimal(20,0)"}
_NANOS = "timestamp[ns"


def _footers():
    """The footer reader; made here so that it travels to the executors by value."""

    def spark_type(kind, physical: str | None) -> str:
        from pyspark.sql.pandas.types import from_arrow_type

        text = str(kind)
        if text == "null":
            return "void"
        if physical == "INT96":  # Spark's own timestamps
            return "timestamp"
        if text.startswith(nanos):
            return "nanos_utc" if "tz=" in text else "nanos"
        if text in unsigned:
            return unsigned[text]
        return from_arrow_type(kind, prefer_timestamp_ntz=True).simpleString()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        for batch in batches:
            rows = []
            for path in batch["path"]:
                filesystem, inner = pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
                with filesystem.open_input_file(inner) as handle:
                    file = pq.ParquetFile(handle)
                    stored = (file.schema.column(i) for i in range(len(file.schema)))
                    physical = {column.path: column.physical_type for column in stored}
                    schema = file.schema_arrow
                rows.append(json.dumps(
                    [[field.name, spark_type(field.type, physical.get(field.name))] for field in schema]))
            yield pd.DataFrame({"path": batch["path"], "columns_json": rows})

    unsigned, nanos = dict(_UNSIGNED), str(_NANOS)
    return read


def file_schemas(spark: SparkSession, base: str) -> DataFrame:
    """One row per file: ``path`` and its columns as JSON ``[[name, Spark type], …]``."""
    files = list_files(spark, base).select("path")
    tasks = max(1, -(-files.count() // _FOOTERS_PER_TASK))
    return files.repartition(tasks).mapInPandas(_footers(), "path string, columns_json string")


def partition_keys(path: str, base: str) -> Column:
    """Names of the ``name=value`` folders of a path below the base, outermost first."""
    name = base.rstrip("/").rsplit("/", 1)[-1]
    below = F.substring_index(path, f"/{name}/", -1)
    return F.regexp_extract_all(below, F.lit(r"([^/=]+)=[^/]*/"), 1)


def read_relaxed(spark: SparkSession, base: str, table: str | None = None,
                 schemas: DataFrame | None = None) -> DataFrame:
    """Versioned facts whose files drifted apart over time.

    Columns are matched by name, missing ones are null; columns beyond the contract stay. Spark cannot read files
    together whose types differ, so files are grouped by their exact schema (a handful
    of groups, whatever the number of files), each group is one scan, and the groups are
    cast to the contract (or, without one, to a common type) and put together.
    ``schemas`` narrows the read to some of the files of ``file_schemas``.
    """
    files = (file_schemas(spark, base) if schemas is None else schemas).withColumn(
        "folder", F.regexp_replace("path", r"/[^/]*$", ""))
    # A folder whose files agree is named as a whole, so the driver learns folders, not files.
    folders = files.groupBy("folder", partition_keys("path", base).alias("keys")).agg(
        F.collect_set("columns_json").alias("kinds"),
        F.collect_list(F.struct("columns_json", "path")).alias("files"))
    places = folders.select("keys", F.explode(F.when(
        F.size("kinds") == 1, F.array(F.struct(F.col("kinds")[0].alias("columns_json"),
                                               F.col("folder").alias("path")))
    ).otherwise(F.col("files"))).alias("p"))
    groups = (places.groupBy("p.columns_json", "keys")
              .agg(F.collect_list("p.path").alias("paths")).collect())
    if not groups:
        raise FileNotFoundError(f"no Parquet files under {base}")
    wanted = {f.name: f.dataType for f in c.fact_schema(table)} if table else {}
    frames = []
    for group in groups:
        columns = json.loads(group["columns_json"])
        # A column without any value has no usable physical type: leave it out of the
        # scan; the union fills it with nulls of the right type.
        nanos = {n: t for n, t in columns if t.startswith("nanos")}
        if nanos:  # Spark reads them as whole numbers, and only under this setting
            spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
        fields = [f"`{n}` {'bigint' if n in nanos else t}" for n, t in columns if t != "void"]
        more = [f"{k} bigint" for k in group["keys"] if k not in ("snapshot_date", "run_ts_ms")]
        schema = ", ".join([*fields, RUN_PARTITIONS, *more])
        part = (
            spark.read.schema(schema)
            .option("basePath", base)
            .parquet(*group["paths"])
        )
        for n, t in nanos.items():
            at = F.timestamp_micros(F.expr(f"(`{n}` - pmod(`{n}`, 1000)) div 1000"))
            # Local times count from the epoch in UTC, whatever the session's time zone.
            local = F.convert_timezone(F.current_timezone(), F.lit("UTC"), at.cast("timestamp_ntz"))
            part = part.withColumn(n, at if t == "nanos_utc" else local)
        empty = [n for n, t in columns if t == "void"]
        part = part.select(
            *[
                F.col(n).cast(wanted[n]).alias(n) if n in wanted else F.col(f"`{n}`")
                for n in part.columns
            ],
            *[F.lit(None).cast(wanted.get(n, T.NullType())).alias(n) for n in empty],
        )
        frames.append(part)
    out = union_relaxed(frames)
    return out.withColumns({
        n: F.lit(None).cast(kind) for n, kind in wanted.items() if n not in out.columns})
