"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before it kept, written as Parquet in the
cluster's shared folder, and returns documents with the same columns; the last one returns
the pieces of the packed sequences with their token ids.

Defined results, the same in every stage: a null text is an empty one (the quality rules reject
it); rows without an identifier are judged like any other, are never taken for copies of rows
with one, and are packed; repeated rows are one document to near-dedup, and every stage keeps or
drops all of them; texts of any length are treated whole; an empty table gives an empty
result with the same columns; other columns are passed on until packing, which reads none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutiny.llm import decontaminate, line_dedup, packing, quality_rules, simhash
from scrutiny.llm.common import stored, table
from scrutiny.llm.queries import tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and both regressions accept."""
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.filter_quality(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without lines that many of them share."""
    kept = line_dedup.dedup_lines(docs, counts=False)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8)."""
    return simhash.keep_one(docs, size=5, least=0.8)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their ids."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"), window=2048, end_id=1, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("packing", packed),
]

#: Fitted models and the tokenizer have no SQL; ``tests/llm`` hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
