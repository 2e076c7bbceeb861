"""Token counts of whole texts by Arrow batches that return lengths only.

Null counts as the empty text: 0 bytes, 0 tokens. Rows keep their identifier; repeated rows
are counted each on their own; an empty table gives an empty result. Columns of the input
other than the identifier and the text are never read, so clashing names do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutiny.llm.common import text_slices
from scrutiny.llm.encoding import encoder


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` of every row; no shuffle.

    ``tokenizer`` is the path of a tokenizer file, the same on all executors.
    """

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in text_slices(batches, "text"):
            n = pa.array(enc.lengths(batch.column("text")), pa.int64())
            n_bytes = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), n_bytes, n, pc.greater(n, limit)],
                ["key", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[key].dataType.simpleString()
    return (docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
            .mapInArrow(lengths, f"key {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
            .withColumnRenamed("key", key))
