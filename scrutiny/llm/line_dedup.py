"""Incremental, reversible line dedup: exact reference counts behind sharded cuckoo filters.

A line's key is a 16-byte digest of the line, stripped of blanks at both ends and with A-Z in
lower case. Lines whose key has at least ``min_chars`` code points and occurs in at least
``min_docs`` documents go, except in the largest document that holds it.

State. *References* say for each key how many documents hold it and which is the largest;
they come from postings (key, document, +1 or -1), so a deleted document gives back its
counts. *Filters*, one for each shard of the keys, hold the keys with ``min_docs`` or more
references; keys enter and leave them as counts cross that number. A posting is first asked
of its shard's filter, which sends nearly all unrepeated lines away, and the few that pass
are joined with the exact references, so the filters' false answers do no harm.

Hot lines. Counting is combined before the shuffle. Shards are dealt to tasks in salted
parts of bounded size, so a line in a third of all documents does not meet in one task.

Defined results: a null text is one empty line; rows without an identifier take no part and
keep all lines; rows that share an identifier count as documents of their own, and all of
them keep the line if the identifier is the largest. Texts and lines of any length are read
whole. Empty tables give empty results; other columns are passed through untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrutiny.llm.common import stored, text_slices
from scrutiny.llm.cuckoo import CuckooFilter, filter_of
from scrutiny.session import scratch_path

BLANKS = b" \t\n\x0b\x0c\r"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
MIN_CHARS = 40
MIN_DOCS = 5
SHARD_KEYS = 100_000  # keys of a filter, on average
PART_ROWS = 100_000  # postings that a task takes at once, about


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The key of a line; None for lines too short to count."""
    bare = line.strip(BLANKS)
    if len(bare) < min_chars:
        return None
    if len(bare) < 4 * min_chars and len(bare.decode()) < min_chars:  # bytes to code points
        return None
    return hashlib.blake2b(bare.translate(LOWER), digest_size=16).digest()


def postings(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``key, doc_id``: each key once for each row of ``docs``. No shuffle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            keys: list[bytes] = []
            owners: list[int] = []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts):
                own = {line_key(x, min_chars) for x in set((text or b"").split(b"\n"))}
                own.discard(None)
                keys += own
                owners += [doc] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(owners, pa.int64())], ["key", "doc_id"])

    return (docs.where("doc_id is not null")
            .select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
            .mapInArrow(rows, "key binary, doc_id bigint"))


def references(rows: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``key, n_docs, last_doc`` of keys that reach ``min_docs``; combined before the shuffle."""
    return (rows.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
            .where(F.col("n_docs") >= min_docs))


def shard_of(shards: int):
    return F.pmod(F.xxhash64("key"), F.lit(shards))


def build_filters(refs: DataFrame, shards: int) -> DataFrame:
    """``shard, filter``: one cuckoo filter for each shard that has keys."""

    def build(part: pd.DataFrame) -> pd.DataFrame:
        made = filter_of([bytes(k) for k in part["key"]])
        return pd.DataFrame({"shard": [part["shard"].iloc[0]], "filter": [made.dump()]})

    return (refs.select("key", shard_of(shards).alias("shard"))
            .groupBy("shard").applyInPandas(build, "shard bigint, filter binary"))


def passing(rows: DataFrame, filters: DataFrame, shards: int, n_rows: int) -> DataFrame:
    """The postings whose key a filter may hold.

    The rows of a shard are dealt out by salt to as many tasks as would be needed if all rows
    were of one shard, so no task holds much more than ``PART_ROWS``.
    """
    salts = max(1, -(-n_rows // PART_ROWS))
    salted = rows.withColumn("shard", shard_of(shards)).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    copies = filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))

    def ask(part: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            return part[["key", "doc_id"]].iloc[:0]
        held = CuckooFilter.loaded(bytes(own["filter"].iloc[0]))
        return part.loc[held.contains([bytes(k) for k in part["key"]]), ["key", "doc_id"]]

    return (salted.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt"))
            .applyInPandas(ask, "key binary, doc_id bigint"))


def dropped_keys(rows: DataFrame, refs: DataFrame, filters: DataFrame, shards: int,
                 n_rows: int) -> DataFrame:
    """``doc_id, keys``: what each document loses."""
    return (passing(rows, filters, shards, n_rows).join(refs, "key")
            .where(F.col("doc_id") != F.col("last_doc"))
            .groupBy("doc_id").agg(F.collect_set("key").alias("dropped")))


def rewrite(docs: DataFrame, drops: DataFrame, min_chars: int = MIN_CHARS,
            counts: bool = True) -> DataFrame:
    """All columns of ``docs`` with the shortened text; with ``counts`` also ``n_lines`` and
    ``n_dropped``, which replace columns of these names."""
    own = {"n_lines", "n_dropped"} if counts else set()
    names = [c for c in docs.columns if c not in own]
    inner = (docs.select(F.struct(*names).alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"))
             .join(drops, "doc_id", "left").select("row.text", "dropped", "row"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            texts, n_lines, n_dropped = [], [], []
            lost = batch.column("dropped").to_pylist()
            for t, gone in zip(batch.column("text").cast(pa.binary()).to_pylist(), lost):
                lines = (t or b"").split(b"\n")
                n_lines.append(len(lines))
                if gone:
                    gone = set(gone)
                    lines = [x for x in lines if line_key(x, min_chars) not in gone]
                    t = b"\n".join(lines)
                n_dropped.append(n_lines[-1] - len(lines))
                texts.append(t)
            row = batch.column("row")
            parts = dict(zip([f.name for f in row.type], row.flatten()))
            parts["text"] = pa.array(texts, pa.binary()).cast(pa.string())
            if counts:
                parts |= {"n_lines": pa.array(n_lines, pa.int64()),
                          "n_dropped": pa.array(n_dropped, pa.int64())}
            yield pa.RecordBatch.from_arrays(list(parts.values()), list(parts))

    schema = T.StructType([docs.schema[c] for c in names])
    for c in ("n_lines", "n_dropped") if counts else ():
        schema = schema.add(c, T.LongType())
    return inner.mapInArrow(rows, schema)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                counts: bool = True) -> DataFrame:
    """All documents without their repeated lines, in one go. See the head of this module."""
    rows = stored(postings(docs, min_chars), "line-postings")
    refs = stored(references(rows, min_docs), "line-references")
    shards = max(1, -(-refs.count() // SHARD_KEYS))
    drops = dropped_keys(rows, refs, build_filters(refs, shards), shards, rows.count())
    return rewrite(docs, drops, min_chars, counts)


class LineIndex:
    """The same as a state that documents enter and leave.

    Every change writes the next version beside the earlier ones and only then counts, so a
    change that dies half-way leaves the index as it was. An index that is there already is
    opened at its last complete version. A document counts once for a line however often it
    was inserted; it is out when it was deleted as often. Deleting what isn't held is undone by
    the insert that follows.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, shards: int = 16,
                 min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS):
        self.spark, self.path = spark, path or scratch_path(spark, "line-index")
        self.shards, self.min_chars, self.min_docs = shards, min_chars, min_docs
        self.version = self._last_version()
        if self.version >= 0:
            return
        self.version = 0
        none = spark.createDataFrame([], "key binary, doc_id bigint, sign int")
        none.write.mode("overwrite").parquet(f"{self.path}/postings/version=0")
        spark.createDataFrame([], "shard bigint, filter binary").write.mode("overwrite").parquet(
            f"{self.path}/filters/version=0")

    def _last_version(self) -> int:
        """The last version whose filters were written to the end (-1: there is no index)."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/filters")
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return -1
        done = [s.getPath().getParent().getName() for s in
                fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(folder, "version=*/_SUCCESS")) or []]
        return max((int(n.split("=")[1]) for n in done), default=-1)

    def _postings(self, version: int | None = None) -> DataFrame:
        """What is held: postings whose additions outnumber their removals."""
        last = self.version if version is None else version
        paths = [f"{self.path}/postings/version={v}" for v in range(last + 1)]
        return (self.spark.read.schema("key binary, doc_id bigint, sign int").parquet(*paths)
                .groupBy("key", "doc_id").agg(F.sum("sign").alias("n")).where("n > 0"))

    def references(self) -> DataFrame:
        return references(self._postings().select("key", "doc_id"), self.min_docs)

    def filters(self) -> DataFrame:
        return self.spark.read.schema("shard bigint, filter binary").parquet(
            f"{self.path}/filters/version={self.version}")

    def insert(self, docs: DataFrame) -> None:
        """Add documents that the index doesn't hold."""
        self._change(docs, 1)

    def delete(self, docs: DataFrame) -> None:
        """Take out documents that were inserted with these texts."""
        self._change(docs, -1)

    def _change(self, docs: DataFrame, sign: int) -> None:
        new = self.version + 1
        postings(docs, self.min_chars).withColumn("sign", F.lit(sign)).write.mode("overwrite").parquet(
            f"{self.path}/postings/version={new}")
        touched = (self.spark.read.schema("key binary").parquet(f"{self.path}/postings/version={new}")
                   .distinct())

        def documents(version: int, name: str) -> DataFrame:
            """How many documents hold a touched key."""
            return (self._postings(version).join(touched, "key", "left_semi")
                    .groupBy("key").agg(F.count("*").alias(name)))

        n, after = (F.coalesce(c, F.lit(0)) for c in ("n_before", "n_after"))
        crossed = (touched.join(documents(self.version, "n_before"), "key", "left")
                   .join(documents(new, "n_after"), "key", "left")
                   .withColumn("enters", (n < self.min_docs) & (after >= self.min_docs))
                   .withColumn("leaves", (n >= self.min_docs) & (after < self.min_docs))
                   .where("enters or leaves")
                   .select("key", "enters", shard_of(self.shards).alias("shard")))
        path = f"{self.path}/filters/version={new}"
        turned = stored(self._turned(crossed), "line-filters")
        self.version = new
        full = [r["shard"] for r in turned.where("length(filter) = 0").select("shard").collect()]
        if full:  # at most one number for each shard
            again = build_filters(self.references().where(shard_of(self.shards).isin(full)), self.shards)
            turned = turned.where("length(filter) > 0").unionByName(again)
        turned.write.mode("overwrite").parquet(path)

    def _turned(self, crossed: DataFrame) -> DataFrame:
        """The filters after keys entered and left; a filter that is full is built larger."""

        def turn(own: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
            shard = (own if len(own) else part)["shard"].iloc[0]
            held = (CuckooFilter.loaded(bytes(own["filter"].iloc[0])) if len(own)
                    else CuckooFilter.for_keys(4 * len(part) + 1000))
            held.remove([bytes(k) for k in part.loc[~part["enters"].astype(bool), "key"]])
            new = [bytes(k) for k in part.loc[part["enters"].astype(bool), "key"]]
            full = not held.add(new)
            table = b"" if full else held.dump()  # an empty table is built anew below
            return pd.DataFrame({"shard": [shard], "filter": [table]})

        return (self.filters().groupBy("shard").cogroup(crossed.groupBy("shard"))
                .applyInPandas(turn, "shard bigint, filter binary"))

    def apply(self, docs: DataFrame) -> DataFrame:
        """``docs`` (held by the index) without the lines that are repeated now."""
        rows = stored(postings(docs, self.min_chars), "line-postings")
        drops = dropped_keys(rows, self.references(), self.filters(), self.shards, rows.count())
        return rewrite(docs, drops, self.min_chars)
