"""Sinks: dimensions, versioned facts, staged replacement, exports, verification."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrutiny.functions.scalars import lima_date
from scrutiny.operators.contract_checks import coerce_null_columns, contract_violations
from scrutiny.operators.unions import union_all
from scrutiny.sources.files import CSV_FORMAT, read_official_csv
from scrutiny.sources.tables import APPEND, APPENDS, SNAPSHOT, file_schemas, partition_keys, read_relaxed

#: Folders that a task of a partitioned write keeps open at once.
OPEN_FOLDERS = 32
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _fs(spark, path)
    return bool(fs.exists(hadoop))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hadoop = _fs(spark, path)
    if fs.exists(hadoop):
        fs.delete(hadoop, True)


def write_dim(df: DataFrame, base: str, name: str) -> str:
    """Overwrite a dimension."""
    path = f"{base.rstrip('/')}/{name}"
    coerce_null_columns(df).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def write_table(df: DataFrame, path: str) -> None:
    """Write a large result straight from its tasks."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_by_folder(df: DataFrame, path: str, *keys: str) -> None:
    """Write rows to a folder for each value of the keys, straight from their tasks.

    By itself Spark sorts the rows of a task by folder, to have one file open at a time; a task
    that reads much then spills all it reads. Runs are few, so a task keeps a file open for each
    of them, and only rows of folders beyond ``OPEN_FOLDERS`` are sorted. A session that sets
    the number of open files keeps its own.
    """
    conf = df.sparkSession.conf
    own = conf.get(_WRITERS, None)
    if own is None:
        conf.set(_WRITERS, str(OPEN_FOLDERS))
    try:
        df.write.partitionBy(*keys).option("compression", "zstd").parquet(path)
    finally:
        if own is None:
            conf.unset(_WRITERS)


def append_snapshot(df: DataFrame, base: str, table: str, ts: str = "snapshot_ts_ms") -> str:
    """Append a snapshot, or many of them, partitioned by local date and number of the append.

    Folders are as many as days and appends, however many snapshots an append brings. What is
    there is not touched: appending a snapshot again (a retry) adds a later copy, and readers
    take the last copy of each snapshot.
    """
    path = f"{base.rstrip('/')}/{table}"
    number = _next_append(df.sparkSession, path)
    (
        coerce_null_columns(df)
        .withColumns({"snapshot_date": lima_date(ts), SNAPSHOT: F.col(ts), APPEND: F.lit(number)})
        .write.mode("append").partitionBy("snapshot_date", APPEND)
        .option("compression", "zstd").parquet(path)
    )
    return path


def _next_append(spark: SparkSession, path: str) -> int:
    """Claim a number larger than those of all appends before."""
    fs, folder = _fs(spark, f"{path}/{APPENDS}")
    taken = [int(x.getPath().getName()) for x in fs.listStatus(folder)] if fs.exists(folder) else []
    number = max(taken, default=0) + 1
    _, claim = _fs(spark, f"{path}/{APPENDS}/{number:012d}")
    fs.create(claim, False).close()  # fails if another writer was first
    return number


def write_run(tables: Mapping[str, DataFrame], base: str, run_ts_ms: int,
              batch_id: int = 0) -> list[str]:
    """Write the fact tables of one run (or of one batch of it) under
    ``snapshot_date/run_ts_ms/batch_id``.

    All contracts are checked before anything is written, so a drifted table stops
    the whole run. Each batch has a partition of its own that is overwritten when the batch
    is written again: a retry never doubles rows.
    """
    ready = {}
    for name, df in tables.items():
        df = coerce_null_columns(df, name)
        contract_violations(df, name)
        ready[name] = df
    written = []
    for name, df in ready.items():
        path = f"{base.rstrip('/')}/{name}"
        (
            df.withColumns({
                "snapshot_date": lima_date(F.lit(run_ts_ms)),
                "run_ts_ms": F.lit(run_ts_ms).cast("bigint"),
                "batch_id": F.lit(batch_id).cast("bigint"),
            })
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("snapshot_date", "run_ts_ms", "batch_id")
            .option("compression", "zstd").parquet(path)
        )
        written.append(path)
    return written


def replace_table(df: DataFrame, path: str) -> None:
    """Replace a table that may be read by the very plan that produces it.

    The new files are complete in a staging folder before two renames put them in
    place; a failure before that leaves the old table untouched.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    tag = uuid.uuid4().hex[:8]
    staging, old = f"{path}.staging-{tag}", f"{path}.old-{tag}"
    coerce_null_columns(df).write.option("compression", "zstd").parquet(staging)
    fs, target = _fs(spark, path)
    _, staged = _fs(spark, staging)
    _, backup = _fs(spark, old)
    if fs.exists(target) and not fs.rename(target, backup):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(staged, target):
        fs.rename(backup, target)
        raise OSError(f"could not move {staging} to {path}")
    if fs.exists(backup):
        fs.delete(backup, True)
    spark.catalog.refreshByPath(path)


def write_csv(df: DataFrame, path: str, compression: str = "none") -> int:
    """CSV with a header, plain or gzip; the files' total size in bytes.

    Quotes are doubled and blanks kept; an empty text is written as ``""``, null as nothing.
    """
    (
        df.write.mode("overwrite").options(**CSV_FORMAT)
        .option("compression", "gzip" if compression == "gzip" else "none")
        .option("emptyValue", '""').csv(path)
    )
    fs, hadoop = _fs(df.sparkSession, path)
    return int(fs.getContentSummary(hadoop).getLength())


def verified_write(df: DataFrame, path: str) -> int:
    """Write and read back: the row counts must agree."""
    seen = Observation()
    write_table(coerce_null_columns(df).observe(seen, F.count(F.lit(1)).alias("n")), path)
    expected = int(seen.get["n"])
    actual = df.sparkSession.read.parquet(path).count()
    if actual != expected:
        raise RuntimeError(f"incomplete write to {path}: {actual} of {expected} rows")
    return actual


def land_official(spark: SparkSession, paths: Sequence[str], target: str) -> DataFrame:
    """Each official CSV to a table of its own under ``target``: ``resource, rows``.

    A resource is a file or a folder of files. There are a few dozen of them, each read,
    typed and written by Spark with its row count checked.
    """
    written = []
    for path in paths:
        name = re.sub(r"(\.csv)?(\.gz)?$", "", path.rstrip("/").rsplit("/", 1)[-1])
        rows = verified_write(read_official_csv(spark, path), f"{target}/{name}.parquet")
        written.append((name, rows))
    return spark.createDataFrame(written, "resource string, rows bigint")


def grouped_summary(df: DataFrame, keys: Sequence[str], **constants: object) -> DataFrame:
    """Long summary (``metric, key, n``): the total and counts per value of each key.

    One aggregation serves all keys: rows are first counted per combination of keys,
    and only that small result is split by key.
    """
    combos = df.groupBy(*[F.col(k).cast("string").alias(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("n")
    )
    pairs = F.array(
        F.struct(F.lit("total").alias("metric"), F.lit("").alias("key")),
        *[F.struct(F.lit(k).alias("metric"), F.col(k).alias("key")) for k in keys],
    )
    counts = (
        combos.select(F.explode(pairs).alias("p"), "n")
        .groupBy("p.metric", "p.key").agg(F.sum("n").alias("n"))
    )
    if not constants:
        return counts
    rows = [(f"param:{k}", json.dumps(v, ensure_ascii=False), None) for k, v in constants.items()]
    extra = df.sparkSession.createDataFrame(rows, "metric string, key string, n bigint")
    return union_all([counts, extra])


def write_summary(summary: DataFrame, path: str) -> None:
    summary.write.mode("overwrite").json(path)


def migrate_null_types(spark: SparkSession, base: str, table: str | None = None,
                       dry_run: bool = True) -> DataFrame:
    """Rewrite run folders with files that hold untyped columns.

    Returns one row: files looked at, files that need it, files rewritten. All folders are
    rewritten by one job into staging, a pointer says that the staging is complete, and
    another job swaps them in. A run that was killed before the pointer left the old files
    and is begun anew; one killed after it is finished by the next run, which finds the
    staging through the pointer. A run after that finds nothing to do.
    """
    if not dry_run:
        _finish_migration(spark, base)
    schemas = file_schemas(spark, base).select(
        "path",
        "columns_json",
        F.regexp_replace("path", r"/[^/]*$", "").alias("folder"),
        partition_keys("path", base).alias("keys"),
        F.col("columns_json").contains('"void"]').alias("needs"),
    )
    files, needing = schemas.agg(F.count(F.lit(1)), F.count_if("needs")).first()
    migrated = 0
    if needing and not dry_run:
        folders = schemas.filter("needs").select("folder").distinct()
        touched = schemas.join(folders, "folder", "left_semi")
        # Folders of one depth are one job: usually there is a single one.
        for (keys,) in touched.select("keys").distinct().collect():
            if not keys:
                raise ValueError(f"files directly under {base}: only run folders are migrated")
            part = touched.filter(F.col("keys") == F.array(*[F.lit(k) for k in keys]))
            _rewrite_folders(spark, base, table, part, list(keys))
        migrated = needing
    return spark.createDataFrame(
        [(files, needing, migrated)], "files bigint, needing bigint, migrated bigint"
    )


def _journal(base: str) -> str:
    return f"{base.rstrip('/')}.migration"


def _rewrite_folders(spark: SparkSession, base: str, table: str | None, files: DataFrame,
                     keys: list[str]) -> None:
    """Rewrite whole leaf folders: stage them, commit the staging, swap it in."""
    from scrutiny.sinks.commits import publish

    fixed = read_relaxed(spark, base, table, files.select("path", "columns_json"))
    publish(fixed, _journal(base), tuple(keys), keys=keys, ddl=fixed.schema.json())
    _finish_migration(spark, base)


def _finish_migration(spark: SparkSession, base: str) -> None:
    """Swap in a committed staging, also one that an earlier run left, and drop it."""
    from scrutiny.sinks.commits import current

    staged = current(spark, _journal(base))
    if staged:
        schema = T.StructType.fromJson(json.loads(staged["ddl"]))
        rows = spark.read.schema(schema).parquet(f"{_journal(base)}/{staged['folder']}")
        (
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*staged["keys"]).option("compression", "zstd").parquet(base)
        )
    delete_path(spark, _journal(base))
