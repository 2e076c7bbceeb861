"""Tables clustered by a key: bucketed files, so joins and groups by that key don't shuffle.

A bucketed table is an ordinary folder of Parquet files plus its layout in the session's
catalogue. ``write_clustered`` writes and registers it, ``attach_clustered`` registers a folder
that another session wrote. Two tables with as many buckets on the same key join bucket by
bucket. A key with a third of all rows makes one bucket large; the buckets of the facts here
are by acta, of which each has a few dozen rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BUCKETS = 64


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def write_clustered(df: DataFrame, name: str, path: str, key: str = "idActa",
                    buckets: int = BUCKETS) -> DataFrame:
    """Write a table in buckets of the key, sorted by it inside; the table."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
    # One task for each bucket writes one file for it.
    (
        df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
        .option("compression", "zstd").option("path", path).format("parquet").saveAsTable(name)
    )
    return spark.table(name)


def attach_clustered(spark: SparkSession, name: str, path: str, schema: StructType,
                     key: str = "idActa", buckets: int = BUCKETS) -> DataFrame:
    """Register a folder that ``write_clustered`` wrote, with the same key and buckets."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
    spark.sql(
        f"CREATE TABLE {_quoted(name)} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)
