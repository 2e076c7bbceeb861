"""Token ids in Parquet: a list column for the ids, plain columns for selective reads.

Layout. Rows are ordered by document; a file holds a range of documents. Ids are a list of
32-bit integers under dictionary encoding (the vocabulary is the dictionary), keys and
positions are delta encoded (Parquet's second data-page version). Row groups are small and
pages short, with the page index that Parquet writes, so a reader that asks for a few
documents or only for the metadata columns touches little else.

A file does not know how many ids lie before it when it is written. Each row holds its file's
number and its start inside it; ``read_metadata`` adds the totals of the files before, one
row per file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scrutiny.llm.common import give_back, text_slices
from scrutiny.llm.encoding import encoder

#: Parquet's own settings: row group, page, dictionary page and page rows.
LAYOUT = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.dictionary.page.size": str(2 << 20),
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#start_in_file": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}
SCHEMA = "doc_id bigint, file_no int, start_in_file bigint, n_tokens bigint, ids array<int>"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 2) -> None:
    """Encode every whole text and write the ids in ascending document order.

    Null is the empty text, whose ids are the end id alone. Rows without an identifier come
    first; equal identifiers keep one row each, next to each other. A text of any length is one
    row, encoded unit by unit; an empty table gives files without rows. Other columns are not
    read.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, file_no, before = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in text_slices(batches, "text"):
            flat, sizes = enc.ids(batch.column("text"))
            if end_id is not None:
                flat, sizes = with_end(flat, sizes, end_id)
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(sizes), file_no, np.int32)),
                 pa.array(before + ends - sizes), pa.array(sizes), list_array(flat, sizes)],
                ["doc_id", "file_no", "start_in_file", "n_tokens", "ids"])
            before += int(ends[-1])
            give_back()

    (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id")
     .mapInArrow(encode, SCHEMA)
     .write.options(**LAYOUT).parquet(path))


def with_end(flat: np.ndarray, sizes: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Each run of ids followed by ``end_id``."""
    more = sizes + 1
    out = np.full(int(more.sum()), end_id, np.int32)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(more) - 1] = False
    out[keep] = flat
    return out, more


def list_array(flat: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32, copy=False)))


def list_values(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column in a row and the length of each list (null: none)."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(False)
    return flat, sizes.astype(np.int64)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def file_starts(spark: SparkSession, path: str) -> DataFrame:
    """``file_no, before``: ids in all files before. Reads two narrow columns."""
    totals = read_tokens(spark, path).groupBy("file_no").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "file_no", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens`` without touching the ids."""
    rows = read_tokens(spark, path).select("doc_id", "file_no", "start_in_file", "n_tokens")
    return _placed(rows, spark, path).select("doc_id", "start", "n_tokens")


def _placed(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    return (rows.join(file_starts(spark, path), "file_no")
            .withColumn("start", F.col("before") + F.col("start_in_file")))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the files, ids included."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, sizes = list_values(batch.column("ids"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("file_no"), batch.column("start_in_file"),
                 batch.column("n_tokens"), pa.array(run_crcs(flat, sizes), pa.int64())],
                ["doc_id", "file_no", "start_in_file", "n_tokens", "ids_crc32"])

    rows = read_tokens(spark, path).mapInArrow(
        digest,
        "doc_id bigint, file_no int, start_in_file bigint, n_tokens bigint, ids_crc32 bigint")
    return _placed(rows, spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def run_crcs(flat: np.ndarray, sizes: np.ndarray) -> list[int]:
    """CRC-32 of each run of ids as little-endian unsigned 32-bit integers."""
    raw = memoryview(np.ascontiguousarray(flat, "<u4")).cast("B")
    ends = (np.cumsum(sizes) * 4).tolist()
    starts = [0, *ends[:-1]]
    return [zlib.crc32(raw[a:b]) for a, b in zip(starts, ends)]


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The ids of a few documents; the filter reaches row groups and pages."""
    return read_tokens(spark, path).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "ids")

