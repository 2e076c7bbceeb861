"""The queries of this package: each applies one operator to its whole table.

A query takes a session and a folder of tables, calls the operator with the parameters meant
for production and derives the columns of its contract. ``ORACLES`` holds DuckDB SQL where
SQL can express the rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutiny.llm.common import table
from scrutiny.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents in ascending order, read back."""
    from scrutiny.llm import token_output

    path = scratch_path(spark, "tokens")
    token_output.write_tokens(
        table(spark, sf_dir, "documents"), path, tokenizer("word_bpe_49k.json"), end_id=2)
    return token_output.read_digests(spark, path)


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    from scrutiny.llm.token_counts import count_tokens

    return count_tokens(
        table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), limit=512)


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals and verdict of all documents, by models fitted on a sample of the labels."""
    from scrutiny.llm import quality_rules

    docs = table(spark, sf_dir, "documents")
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, model)


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents after lines that many documents share are gone."""
    from scrutiny.llm.line_dedup import dedup_lines

    kept = dedup_lines(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of four-word shingles and their components at four differing bits."""
    from scrutiny.llm import simhash

    rows = simhash.group(table(spark, sf_dir, "documents"), size=4, budget=4, seed=42)
    return rows.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and the edit distance."""
    from scrutiny.llm.decontaminate import find

    return find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens, neighbours together."""
    from scrutiny.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), window=2048,
                end_id=1)


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents after 100-byte strings that occur earlier are gone."""
    from scrutiny.llm.suffix_dedup import dedup_substrings

    return dedup_substrings(table(spark, sf_dir, "documents"), with_text=False)


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from the rows that are not held out."""
    from scrutiny.llm import language_id

    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs))


@query
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as windows, written, and what is read back from them."""
    from scrutiny.llm import chat_format
    from scrutiny.llm.common import stored

    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    windows = chat_format.format_windows(
        turns.unionByName(chat_format.probe(spark)), tokenizer("byte_bpe_50k.json"), budget=1024)
    return chat_format.read_digests(stored(windows, "chat-windows"))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of two and three words of each language, over all documents."""
    from scrutiny.llm.collocations import mine

    found = mine(table(spark, sf_dir, "documents"), least=10, covered=50, top=2000)
    return found.withColumn("rank", F.col("rank").cast("bigint"))


@query
def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, compared with an edited text and the next document."""
    from scrutiny.llm.fuzzy_hash import edited_neighbours

    return edited_neighbours(table(spark, sf_dir, "documents"))


@query
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word use of every source against the other sources and its language, over all documents."""
    from scrutiny.llm.divergence import audit

    return audit(table(spark, sf_dir, "documents"), min_docs=3, smooth=1, top=200)
