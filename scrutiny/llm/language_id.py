"""Language identification: nearest centroid over normalised TF-IDF of hashed n-grams.

A text's vector holds the hashed byte n-grams (three and four bytes, letters only, A-Z lower-
cased) of the whole text, weighted by 1 + log of the count and by the inverse document
frequency, and has length one. Each language has several centroids, found by spherical
k-means on its own training rows; a text gets the language of the centroid with the highest
cosine. A text further away from its centroid than nearly all training rows of that centroid
are is marked as rejected.

Document frequencies are counted over all training rows. The centroids are fitted on a
bounded sample of them, ``sample`` rows for each language with the smallest hashes of their
identifiers (the documented bound of what reaches the driver).

Defined results: a null text or one without a letter is ``und`` with score 0 and rejected; so
is every text if there are no training rows. Equal cosines give the language first in
alphabetical order. Repeated rows are predicted each on its own, empty tables give empty
results, and only the identifier, the text and (for training) the language are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutiny.llm.common import text_slices

DIMS = 8192
CENTROIDS = 4
GRAMS = (3, 4)
#: A-Z to a-z, digits, marks and controls to one blank; bytes of other letters stay.
FOLD = np.array([c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32
                 for c in range(256)], np.uint8)


ASCII_LETTER = re.compile(rb"[A-Za-z]")


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]  # one for each centroid
    centroids: np.ndarray  # rows of length one
    idf: np.ndarray
    nearest: np.ndarray  # for each centroid the least cosine that is not rejected


def held_out(key: Column | str = "doc_id") -> Column:
    """True for rows that no model may learn from: crc32 of the identifier's digits mod 4 is 2."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def counted(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed n-grams, a row of ``DIMS`` for each text; texts' letters as a flag.

    N-grams that only hold blanks are left out; a run of blanks counts as one.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    raw = FOLD[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    doc = np.repeat(np.arange(len(texts)), sizes)
    keep = np.ones(len(raw), bool)
    keep[1:] = (raw[1:] != 32) | (raw[:-1] != 32) | (doc[1:] != doc[:-1])
    raw, doc = raw[keep].astype(np.uint32), doc[keep]
    out = np.zeros(len(texts) * DIMS, np.int64)
    for n in GRAMS:
        if len(raw) < n:
            continue
        code = np.zeros(len(raw) - n + 1, np.uint32)
        for k in range(n):
            code = code * np.uint32(257) + raw[k:len(raw) - n + 1 + k]
        code = (code ^ (code >> np.uint32(15))) * np.uint32(2654435761)
        own = doc[:len(code)] == doc[n - 1:]
        at = doc[:len(code)][own] * DIMS + (code[own] >> np.uint32(19)).astype(np.int64)
        out += np.bincount(at, minlength=len(out))
    return out.reshape(len(texts), DIMS), np.array([lettered(t) for t in texts], bool)


def lettered(text: bytes) -> bool:
    """True if the text has a letter."""
    return ASCII_LETTER.search(text) is not None or any(
        map(str.isalpha, text.decode(errors="replace")))


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts.astype(np.float32)) * idf
    length = np.sqrt(np.square(x).sum(1, keepdims=True))
    return x / np.where(length > 0, length, 1)


def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """At most 64 rows and 512 KB of text, so that the table of counts stays small."""
    for batch in text_slices(batches, "text", 512 << 10):
        for at in range(0, batch.num_rows, 64):
            yield batch.slice(at, 64)


def bytes_of(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def fit(docs: DataFrame, sample: int = 400, seed: int = 7) -> Model:
    """Learn from text and language of rows that have both and are not held out."""
    known = (docs.where("lang is not null and text is not null").where(~held_out())
             .select("doc_id", "text", "lang"))

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(DIMS, np.int64)
        for part in portions(batches):
            df += (counted(bytes_of(part))[0] > 0).sum(0)
            n += part.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(np.arange(DIMS), -1)), pa.array(np.append(df, n))], ["dim", "n"])

    found = known.select("text").mapInArrow(presence, "dim bigint, n bigint").groupBy("dim").agg(
        F.sum("n").alias("n")).collect()  # a row for each dimension
    df = np.zeros(DIMS + 1)
    for r in found:
        df[r["dim"]] = r["n"]
    idf = np.log((1 + df[-1]) / (1 + df[:-1])).astype(np.float32) + np.float32(1)

    # Per language the smallest hashes: top-k per partition first, then of those.
    languages = sorted(r["lang"] for r in known.select("lang").distinct().collect())
    names, rows, nearest = [], [], []
    for lang in languages:
        chosen = (known.where(F.col("lang") == lang)
                  .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("text"))
        texts = [r["text"].encode() for r in chosen.toLocalIterator()]
        counts = [counted(texts[i:i + 64])[0] for i in range(0, len(texts), 64)]
        x = np.concatenate([vectors(c, idf) for c in counts])
        x = x[np.square(x).sum(1) > 0]
        if not len(x):
            continue
        centre = clustered(x, CENTROIDS, seed)
        cosine = x @ centre.T
        mine = cosine.argmax(1)
        for k in range(len(centre)):
            own = cosine[mine == k, k]
            names.append(lang)
            rows.append(centre[k])
            nearest.append(0.5 * float(np.quantile(own, 0.01)) if len(own) else 0.0)
    return Model(tuple(names), np.array(rows, np.float32).reshape(-1, DIMS), idf, np.array(nearest))


def clustered(x: np.ndarray, k: int, seed: int, rounds: int = 15) -> np.ndarray:
    """Spherical k-means; centres start far from one another."""
    rng = np.random.default_rng(seed)
    centre = x[[int(rng.integers(len(x)))]]
    while len(centre) < min(k, len(x)):
        far = (x @ centre.T).max(1).argmin()
        centre = np.concatenate([centre, x[[int(far)]]])
    for _ in range(rounds):
        mine = (x @ centre.T).argmax(1)
        sums = np.zeros_like(centre)
        np.add.at(sums, mine, x)
        length = np.sqrt(np.square(sums).sum(1, keepdims=True))
        centre = np.where(length > 0, sums / np.where(length > 0, length, 1), centre)
    return centre


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected``; the text alone decides. No shuffle.

    The score is the cosine to the nearest centroid (0 for ``und``).
    """
    names = np.array([*model.languages, "und"], object)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches):
            counts, letters = counted(bytes_of(part))
            best, score = np.full(len(counts), -1), np.zeros(len(counts))
            if len(model.languages):
                cosine = vectors(counts, model.idf) @ model.centroids.T
                best = np.where(letters, cosine.argmax(1), -1)
                score = np.where(letters, np.clip(cosine.max(1), 0, 1), 0).astype(np.float64)
            far = (best < 0) | (score < np.append(model.nearest, 0)[best])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(names[best], pa.string()),
                 pa.array(score), pa.array(far)],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                        held_out().alias("held_out"))
            .mapInArrow(rows, "doc_id bigint, held_out boolean, lang_pred string, score double, "
                              "rejected boolean"))
