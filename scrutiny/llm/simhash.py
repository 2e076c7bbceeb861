"""SimHash fingerprints and near-duplicate groups by a binary-trie self-join.

``group`` links fingerprints of word shingles within a Hamming budget, nothing else.
``near_duplicates`` finds documents whose sets of word shingles are similar: several
fingerprints of a document's words give candidates, which are then compared exactly. (A
fingerprint of shingles at similarity 0.8 differs in seven bits of 64 on average; of words in
three, so a small budget finds nearly all, and the exact check removes the rest.)

Defined results: a null or blank text has fingerprint zero and is linked like any other.
Rows without an identifier get the component of their fingerprint, or null if they alone have
it. Repeated rows and exact copies meet in one node before anything is compared, however many
they are. Texts of any length are read whole, a slice of words at a time. Empty tables give
empty results; only the identifier and the text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutiny.llm.common import stored, text_slices
from scrutiny.llm.components import components, stars
from scrutiny.llm.trie_join import apart, links, parity, tied

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
ONES = np.uint64(0x0101010101010101)


def words_of(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.translate(LOWER).split()


def shingle_hashes(words: list[bytes], size: int, seed: int) -> list[int]:
    """XXH64 of each run of ``size`` words joined by blanks, repeats included."""
    from xxhash import xxh64_intdigest

    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= size:
        return [xxh64_intdigest(line, seed)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return [xxh64_intdigest(line[a:b], seed)
            for a, b in zip(starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist())]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each run of ``counts`` hashes the bits that more than half of them have.

    Eight bits are counted at once, each in a byte of a 64-bit word; parts of at most 255
    hashes keep the bytes from running over.
    """
    out = np.zeros(len(counts), np.uint64)
    full = counts > 0
    n = counts[full]
    if not len(n):
        return out
    parts = -(-n // 255)
    starts = np.cumsum(n) - n
    cuts = np.repeat(starts, parts) + 255 * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    firsts = np.cumsum(parts) - parts
    found = np.zeros(len(n), np.uint64)
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(shift)) & ONES, cuts)
        total = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), firsts, axis=0)
        most = (2 * total > n[:, None]).astype(np.uint64)
        for lane in range(8):
            found |= most[:, lane] << np.uint64(8 * lane + shift)
    out[full] = found
    return out


def fingerprints(docs: DataFrame, size: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id, fp``; no shuffle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", 1 << 20):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            each = [shingle_hashes(words_of(t or b""), size, seed) for t in texts]
            counts = np.fromiter(map(len, each), np.int64, len(each))
            flat = np.fromiter((h for x in each for h in x), np.uint64, int(counts.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(majority(flat, counts).view(np.int64))],
                ["doc_id", "fp"])

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
            .mapInArrow(rows, "doc_id bigint, fp bigint"))


def group(docs: DataFrame, size: int = 4, budget: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id, fp, component_id``: fingerprints link at ``budget`` or fewer differing bits."""
    rows = stored(fingerprints(docs, size, seed), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node is not null"),
                   "fingerprint-nodes")
    found = components(links(nodes, budget))
    placed = nodes.join(found, "node", "left").select(
        "fp", F.coalesce("component", "node").alias("component_id"))
    return rows.join(placed, "fp", "left").select("doc_id", "fp", "component_id")


def hex_digits(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


#: Seeds of the fingerprints that give candidates; a pair has to be close in one of them.
SEEDS = (42, 1, 2, 3)


def sketched(docs: DataFrame, seeds: tuple[int, ...] = SEEDS) -> DataFrame:
    """``doc_id, words_key, fps``: a digest of the word sequence, and for each seed a
    fingerprint of the distinct words. No shuffle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in text_slices(batches, "text", 1 << 20):
            keys, each = [], []
            number: dict[bytes, int] = {}
            for t in batch.column("text").cast(pa.binary()).to_pylist():
                words = words_of(t or b"")
                keys.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
                each.append([number.setdefault(w, len(number)) for w in set(words)])
            counts = np.fromiter(map(len, each), np.int64, len(each))
            flat = np.fromiter((i for x in each for i in x), np.int64, int(counts.sum()))
            fps = []
            for seed in seeds:
                hashes = np.fromiter((xxh64_intdigest(w, seed) for w in number), np.uint64, len(number))
                fps.append(majority(hashes[flat], counts).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys, pa.binary()),
                 pa.array(list(np.stack(fps, 1)), pa.list_(pa.int64()))],
                ["doc_id", "words_key", "fps"])

    return _named(docs).mapInArrow(rows, "doc_id bigint, words_key binary, fps array<bigint>")


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, shingles, parity``: the distinct hashes of a text's word shingles. No shuffle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", 1 << 20):
            sets = [np.unique(np.array(shingle_hashes(words_of(t or b""), size, 0), np.uint64))
                    for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                 pa.array(map(parity, sets), pa.binary())],
                ["doc_id", "shingles", "parity"])

    return _named(docs).mapInArrow(rows, "doc_id bigint, shingles array<bigint>, parity binary")


def _named(docs: DataFrame) -> DataFrame:
    return (docs.where("doc_id is not null")
            .select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))


def near_duplicates(docs: DataFrame, size: int = 5, least: float = 0.8, budget: int = 4) -> DataFrame:
    """``doc_id, component_id`` of documents that have a near or exact copy with another id.

    The similarity is that of the sets of word shingles. Ties of the trie join are compared
    first (each text with its nearest in every bucket, and with one of its group), and only their
    texts are cut into shingles. A tie that fails decides nothing about others, so each text is
    then compared with the partner that most were similar to, and at last every pair within the
    budget that is still between two groups. Of both, pairs that the parities of their shingle sets
    show to be unlike come out of no walk. Rows that share an identifier are one document,
    similar to another if any of its texts is.
    """
    rows = stored(sketched(docs), "sketches")
    copies = stored(rows.groupBy("words_key").agg(F.min("doc_id").alias("node"), F.count("*").alias("n"))
                    .where("n > 1").drop("n"), "copies")
    owned = stored(rows.join(copies, "words_key", "left").select(
        "doc_id", F.coalesce("node", "doc_id").alias("node"), "fps"), "owned")
    texts = stored(owned.where("doc_id = node").select("node", "fps").distinct(), "texts")
    each = by_seed(texts)
    first = stored(each.groupBy("seed", "fp").agg(F.min("node").alias("node")), "fingerprint-nodes")
    same = (each.join(first.withColumnRenamed("node", "first"), ["seed", "fp"]).where("node <> first")
            .select(F.col("first").alias("a"), F.col("node").alias("b")))
    pairs = stored(same.unionByName(tied(first, budget).select("a", "b")).distinct(), "candidates")
    asked = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = stored(shingle_sets(docs.join(asked, "doc_id", "left_semi"), size), "shingles")
    odd = F.when(F.min("parity") == F.max("parity"), F.min("parity"))  # null: several sets
    nodes = stored(texts.join(sets.groupBy(F.col("doc_id").alias("node")).agg(
        F.min(F.size("shingles")).cast("bigint").alias("low"),
        F.max(F.size("shingles")).cast("bigint").alias("high"), odd.alias("parity")), "node"), "undecided")
    found = stored(verified(pairs, sets, least), "similar")
    whole = found
    for leading in (True, False):
        groups = stars(whole)
        more = stored(apart(labelled(nodes, groups, found), budget, least, leading)
                      .join(pairs, ["a", "b"], "left_anti"), "candidates")
        new = stored(verified(more, sets, least), "similar")
        pairs, found = pairs.unionByName(more), found.unionByName(new)
        whole = groups.select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(new)
    whole = whole.unionByName(owned.where("doc_id <> node").select(
        F.col("node").alias("a"), F.col("doc_id").alias("b")))
    return components(whole).withColumnsRenamed({"node": "doc_id", "component": "component_id"})


def by_seed(texts: DataFrame) -> DataFrame:
    """A row for each of a text's fingerprints: ``fp`` and its ``seed`` instead of ``fps``."""
    each = texts.select(*(c for c in texts.columns if c != "fps"), F.posexplode("fps").alias("seed", "fp"))
    return each.withColumn("seed", F.col("seed").cast("bigint"))


def labelled(nodes: DataFrame, groups: DataFrame, found: DataFrame) -> DataFrame:
    """``nodes`` by seed, with the group that each is in and with the number of its pairs found."""
    ends = found.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(
        F.count("*").alias("weight"))
    return by_seed(nodes.join(groups, "node", "left").join(ends, "node", "left").select(
        "node", "fps", "low", "high", "parity", F.coalesce("component", "node").alias("label"),
        F.coalesce("weight", F.lit(0)).alias("weight")))


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs whose shingle sets have at least that Jaccard similarity."""
    a = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("left"))
    b = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("right"))
    shared = F.size(F.array_intersect("left", "right"))
    return (pairs.join(a, "a").join(b, "b")
            .where(F.least(F.size("left"), F.size("right"))
                   >= least * F.greatest(F.size("left"), F.size("right")))
            .where(shared >= least * (F.size("left") + F.size("right") - shared))
            .select("a", "b"))


def keep_one(docs: DataFrame, size: int = 5, least: float = 0.8) -> DataFrame:
    """``docs`` without the members of near-duplicate groups, except each group's smallest id."""
    gone = near_duplicates(docs, size, least).where("doc_id <> component_id").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
