"""CSV, file manifests and run ledgers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: RFC 4180: quotes are doubled inside quotes, blanks belong to the value.
CSV_FORMAT = {"header": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE",
              "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


#: Stands for a missing value while a row is parsed, so that a quoted empty text stays one.
NO_VALUE = "\u0000"


def csv_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One row per file: ``path``, ``encoding``, ``multi_line``, ``header`` (its first line).

    Found out from the content, in one pass over all lines that splits large files. A file
    is UTF-8 if all its lines are, else Latin-1; it has records over several lines if a
    line holds an odd number of quotes.
    """
    lines = spark.read.text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("path"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"))
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.groupBy("path").agg(
        F.when(F.bool_and(F.is_valid_utf8("value")), "UTF-8").otherwise("ISO-8859-1").alias("encoding"),
        F.bool_or(quotes % 2 == 1).alias("multi_line"),
        F.min_by("value", "at").alias("header"))


def encodings(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One row per file: its path and encoding."""
    return csv_files(spark, paths).select("path", "encoding")


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV files by header name, every column text, nothing trimmed or lost.

    Files are read in groups of the same encoding, layout and header (a handful), so that
    files of one folder may differ in all three; columns that a file lacks are null.
    """
    groups = csv_files(spark, [path]).groupBy("encoding", "multi_line", F.hex("header")).agg(
        F.collect_list("path").alias("paths")).collect()
    frames = []
    for group in sorted(groups, key=lambda g: min(g["paths"])):
        frame = spark.read.options(**CSV_FORMAT, encoding=group["encoding"],
                                   multiLine=str(group["multi_line"]).lower(),
                                   nullValue=NO_VALUE).csv(group["paths"])
        frames.append(frame.toDF(*[n.lstrip("\ufeff") for n in frame.columns]))
    if not frames:
        raise FileNotFoundError(f"no CSV lines under {path}")
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)


def read_csv_typed(spark: SparkSession, path: str, types: dict[str, str] | None = None
                   ) -> DataFrame:
    """CSV by header name, everything text but the columns given a type.

    Text first and a strict cast after, so that the order of columns in the file does
    not matter and padded codes are never read as numbers.
    """
    raw = read_csv_text(spark, path)
    return raw.select(
        *[F.col(f"`{n}`").cast((types or {}).get(n, "string")).alias(n) for n in raw.columns]
    )


def read_roll(spark: SparkSession, path: str) -> DataFrame:
    """Voter-roll CSV (either file): ages and quantities are numbers, the rest text."""
    return read_csv_typed(spark, path, {"Edad": "bigint", "Cantidad": "bigint"})


#: A number written the one way its value is written: no padding, no sign on zero.
_PLAIN_NUMBER = r"^(0|-?[1-9][0-9]*|-?(0|[1-9][0-9]*)\.[0-9]+)$"
_DOUBLE_DIGITS, _DECIMAL_DIGITS = 15, 38  # what a double gives back for sure; the widest decimal


def _inferred(rows: DataFrame) -> dict[str, str]:
    """Type of each text column that gives every one of its values back as it was written.

    Whole numbers without padding are ``bigint``; numbers with a fraction ``double`` if none
    ends in a zero and 15 digits hold them, else ``decimal`` if the decimals are as many in
    all or none ends in a zero; ``true`` and ``false`` boolean. All else, a column without a
    value included, stays text.
    """
    tests = []
    for i, name in enumerate(rows.columns):
        text = F.col(f"`{name}`")
        number = text.rlike(_PLAIN_NUMBER)
        fraction = F.when(F.contains(text, F.lit(".")), F.substring_index(text, ".", -1)).otherwise("")
        digits = F.length(F.regexp_replace(text, "[^0-9]", ""))
        fits = {
            "whole": text.try_cast("bigint").cast("string") == text,
            "number": number,
            "short": number & (digits <= _DOUBLE_DIGITS),
            "bare": ~F.endswith(fraction, F.lit("0")),  # the value determines the text
            "boolean": text.isin("true", "false"),
        }
        tests += [
            F.coalesce(F.bool_and(F.when(text.isNotNull(), F.coalesce(ok, F.lit(False)))),
                       F.lit(False)).alias(f"{kind}_{i}")
            for kind, ok in fits.items()
        ]
        scale = F.length(fraction)
        tests += [F.min(scale).alias(f"least_{i}"), F.max(scale).alias(f"scale_{i}"),
                  F.max(digits - scale).alias(f"before_{i}")]
    row = rows.agg(*tests).first()

    def kind(i: int) -> str:
        if row[f"whole_{i}"]:
            return "bigint"
        if row[f"short_{i}"] and row[f"bare_{i}"]:
            return "double"
        width = (row[f"before_{i}"] or 0) + (row[f"scale_{i}"] or 0)
        even = row[f"least_{i}"] == row[f"scale_{i}"]
        if row[f"number_{i}"] and (even or row[f"bare_{i}"]) and width <= _DECIMAL_DIGITS:
            return f"decimal({width},{row[f'scale_{i}']})"
        return "boolean" if row[f"boolean_{i}"] else "string"

    return {name: kind(i) for i, name in enumerate(rows.columns)}


def read_official_csv(spark: SparkSession, path: str, types: dict[str, str] | None = None
                      ) -> DataFrame:
    """Official CSV: encoding and layout found out per file, types from all rows.

    A column gets a type only if every value comes back from it as it was written, so codes
    like ``007`` and amounts like ``0.10`` are kept. ``types`` spares the pass that finds them;
    a value that does not fit a type given there is an error.
    """
    if types is not None:
        return read_csv_typed(spark, path, types)
    raw = read_csv_text(spark, path)
    return raw.select(*[F.col(f"`{name}`").cast(kind).alias(name)
                        for name, kind in _inferred(raw).items()])


def file_manifest(spark: SparkSession, base: str, with_hash: bool = True) -> DataFrame:
    """Every file under a folder: relative path, size and (on request) SHA-256.

    Without the hash the contents are not read at all. With it, tasks read their files
    piece by piece, so a file may have any size.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    root = fs.makeQualified(hadoop).toString().rstrip("/")
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    )
    # Spark writes local paths as file:/x or file:///x depending on the place.
    plain_root = root.split(":", 1)[1].lstrip("/") if ":" in root else root.lstrip("/")
    plain = F.regexp_replace("path", r"^[a-zA-Z0-9]+:/*", "")
    out = files.select(
        "path", F.substring(plain, len(plain_root) + 2, 1_000_000).alias("rel_path"),
        F.col("length").alias("bytes"))
    if not with_hash:
        return out.drop("path")
    return out.mapInPandas(_digests(), "rel_path string, bytes bigint, sha256 string")


def _digests(piece: int = 8 << 20):
    """The hashing task; made here so that it travels to the executors by value."""

    def read(batches):
        import hashlib

        import pyarrow.fs as pafs

        for batch in batches:
            found = []
            for path in batch["path"]:
                filesystem, inner = pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
                digest = hashlib.sha256()
                with filesystem.open_input_stream(inner, compression=None) as handle:
                    while data := handle.read(piece):
                        digest.update(data)
                found.append(digest.hexdigest())
            yield batch[["rel_path", "bytes"]].assign(sha256=found)

    return read


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Run-progress records as JSON lines; unreadable ones are left out."""
    schema = (
        "run_ts_ms bigint, batch_id bigint, expected bigint, ok bigint, empty bigint, "
        "failed bigint, _bad string"
    )
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_bad")
        .json(path)
        .filter(F.col("_bad").isNull() & F.col("run_ts_ms").isNotNull())
        .drop("_bad")
    )
