"""Quality rules: counted signals and two calibrated logistic regressions over hashed n-grams.

The first regression tells junk from prose by the square roots of the shares of a text's
hashed byte trigrams and three shares of the counted signals. The second tells toxic texts by
the presence of hashed words. Both are fitted on a bounded sample of labelled rows
(``sample``, the rows with the smallest hashes of their identifiers), calibrated on rows of
the sample kept aside, and applied in Arrow batches against fixed thresholds.

Defined results: a null text has no words and fails the base rules; a label that is null does
not count for its regression; documents labelled twice count with the worse label; without
labels of both kinds a regression rejects nothing. Repeated rows are judged each on its own,
texts of any length as a whole, empty tables give empty results, and columns other than the
ones named are passed through unread (``filter_quality``) or dropped (``judge``).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scrutiny.llm import logistic
from scrutiny.llm.common import give_back, text_slices
from scrutiny.llm.encoding import summed

CHAR_DIMS = 4096
EDGE = b".,;:!?\"'()[]{}*#$%&|<>-_/\\"
SYMBOLS = b"#*$%&|<>"
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
SYMBOL = np.zeros(256, bool)
SYMBOL[list(SYMBOLS)] = True
COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Model:
    """Fitted weights; each is None where the sample had no rows of both kinds."""

    junk: tuple | None = None  # weights, bias, slope, offset
    toxic: tuple | None = None  # sorted word hashes, weights, bias, slope, offset
    junk_limit: float = 0.5
    toxic_limit: float = 0.5


class Slice:
    """Signals and features of a slice of texts, worked out together."""

    def __init__(self, column: pa.Array):
        self.texts = [t or b"" for t in column.cast(pa.binary()).to_pylist()]
        self.size = np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        self.raw = np.frombuffer(b"".join(self.texts), np.uint8)
        self.words = [t.split() for t in self.texts]
        self.n_words = np.fromiter(map(len, self.words), np.int64, len(self.words))

    def counts(self) -> dict[str, np.ndarray]:
        space = SPACE[self.raw]
        chars = ~space & ((self.raw & 0xC0) != 0x80)
        dup = []
        for t in self.texts:
            lines = [x for x in t.split(b"\n") if x and not x.isspace()]
            dup.append(len(lines) - len(set(lines)))
        return {"n_words": self.n_words, "word_chars": summed(chars.astype(np.int64), self.size),
                "n_symbols": summed(SYMBOL[self.raw].astype(np.int64), self.size),
                "n_dup_lines": np.array(dup, np.int64), "n_repeat_words": self.repeated()}

    def numbered(self) -> tuple[np.ndarray, list[bytes]]:
        """A number for each word of the slice, and the distinct words in that order."""
        if not hasattr(self, "_numbered"):
            known: dict[bytes, int] = {}
            flat = np.fromiter((known.setdefault(w, len(known)) for ws in self.words for w in ws),
                               np.int64, int(self.n_words.sum()))
            self._numbered = flat, list(known)
        return self._numbered

    def repeated(self) -> np.ndarray:
        """Words covered by windows of three words that the text holds at least twice."""
        flat, known = self.numbered()
        ends = np.cumsum(self.n_words)
        doc = np.repeat(np.arange(len(self.n_words)), self.n_words)
        starts = np.flatnonzero(np.arange(len(flat)) + 2 < ends[doc]) if len(flat) else np.array([], int)
        # Pairs first, so that any number of distinct words fits into the code of a window.
        pairs = np.unique(flat[starts] * len(known) + flat[starts + 1], return_inverse=True)[1]
        code = pairs * max(1, len(known)) + flat[starts + 2]
        order = np.lexsort((code, doc[starts]))
        same = (np.diff(code[order]) == 0) & (np.diff(doc[starts][order]) == 0)
        hit = np.zeros(len(order), bool)
        hit[order[1:][same]] = True
        hit[order[:-1][same]] = True
        cover = np.zeros(len(flat) + 3, np.int64)
        np.add.at(cover, starts[hit], 1)
        np.subtract.at(cover, starts[hit] + 3, 1)
        return summed((np.cumsum(cover)[:len(flat)] > 0).astype(np.int64), self.n_words)

    def trigrams(self) -> np.ndarray:
        """Counts of hashed byte trigrams, a row of ``CHAR_DIMS`` for each text."""
        n = len(self.size)
        doc = np.repeat(np.arange(n), self.size)
        if len(self.raw) < 3:
            return np.zeros((n, CHAR_DIMS), np.int64)
        b = self.raw.astype(np.uint32)
        code = ((b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]) * np.uint32(2654435761)
        own = doc[:-2] == doc[2:]
        at = doc[:-2][own] * CHAR_DIMS + (code[own] >> np.uint32(20))
        return np.bincount(at, minlength=n * CHAR_DIMS).reshape(n, CHAR_DIMS)

    def word_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hashed words of each text, in a row, and how many each has."""
        flat, known = self.numbered()
        hashes = np.fromiter((zlib.crc32(w.strip(EDGE).lower()) for w in known), np.int64, len(known))
        doc = np.repeat(np.arange(len(self.n_words)), self.n_words)
        both = np.unique((doc << 32) | hashes[flat])
        return both & 0xFFFFFFFF, np.bincount(both >> 32, minlength=len(self.n_words))


def junk_features(trigrams: np.ndarray, counts: dict[str, np.ndarray]) -> np.ndarray:
    x = np.sqrt(trigrams / np.maximum(trigrams.sum(1, keepdims=True), 1)).astype(np.float32)
    words = np.maximum(counts["n_words"], 1)
    more = np.stack([counts["n_repeat_words"] / words,
                     np.minimum(1, counts["n_symbols"] / np.maximum(counts["word_chars"], 1) * 4),
                     np.minimum(1, counts["n_dup_lines"] / words * 4)], 1)
    return np.concatenate([x, more.astype(np.float32)], 1)


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` labelled documents, chosen by hash; the worse of repeated labels."""
    chosen = (labels.where("doc_id is not null and (quality is not null or toxic is not null)")
              .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id")
    # At most ``sample`` rows of three numbers: small enough to go to every task.
    placed = F.broadcast(chosen.withColumn("place", F.row_number().over(order)))
    return (docs.select("doc_id", "text").join(placed, "doc_id")
            .groupBy("doc_id").agg(F.max("text").alias("text"), F.first("quality").alias("quality"),
                                   F.first("toxic").alias("toxic"), F.min("place").alias("place")))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 8000,
        junk_sample: int = 2000) -> Model:
    """Fit both regressions on at most ``sample`` labelled rows.

    Toxic words are rare, so all rows of the sample count for them (about 2 KB a row reach the
    driver); the first ``junk_sample`` also for junk (8 KB a row).
    """

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", 256 << 10):
            s = Slice(batch.column("text"))
            some = batch.column("place").to_numpy() <= junk_sample
            part = Slice(batch.column("text").filter(pa.array(some)))
            x = iter(junk_features(part.trigrams(), part.counts()).astype(np.float16))
            words, n = s.word_hashes()
            cuts = np.cumsum(n)[:-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality").cast(pa.int32()),
                 batch.column("toxic").cast(pa.int32()),
                 pa.array([next(x).tobytes() if k else None for k in some], pa.binary()),
                 pa.array([r.astype("<u4").tobytes() for r in np.split(words, cuts)], pa.binary())],
                ["doc_id", "quality", "toxic", "junk", "words"])

    rows = (labelled_sample(docs, labels, sample)
            .mapInArrow(features, "doc_id bigint, quality int, toxic int, junk binary, words binary")
            .toArrow().sort_by("doc_id"))
    aside = np.array([zlib.crc32(str(i).encode()) % 4 == 0 for i in rows["doc_id"].to_pylist()], bool)
    toxic_rows, rows = rows.select(["toxic", "words"]), rows.select(["quality", "junk"])
    junk = _fit_junk(rows, aside)
    del rows
    give_back()
    toxic = _fit_toxic(toxic_rows, aside)
    del toxic_rows
    give_back()
    return Model(junk, toxic)


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    """The bytes of all values in a row, without a Python object for each."""
    return np.concatenate([np.zeros(0, kind), *(
        np.frombuffer(c.buffers()[2] or b"", np.uint8)[ends[c.offset]:ends[c.offset + len(c)]].view(kind)
        for c in column.cast(pa.binary()).chunks
        for ends in [np.frombuffer(c.buffers()[1], np.int32)])])


def _both_kinds(y: np.ndarray) -> bool:
    return 0 < y.sum() < len(y)


def _trained(aside: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows to fit on and rows to calibrate on; all for both where one kind would be missing."""
    if _both_kinds(y[aside]) and _both_kinds(y[~aside]):
        return ~aside, aside
    return np.ones(len(y), bool), np.ones(len(y), bool)


def _fit_junk(rows: pa.Table, aside: np.ndarray) -> tuple | None:
    own = pc.and_(pc.is_valid(rows["quality"]), pc.is_valid(rows["junk"]))
    some = rows.filter(own)
    y = (some["quality"].to_numpy() == 0).astype(float)
    if not _both_kinds(y):
        return None
    x = _joined(some["junk"], np.float16).reshape(len(y), -1)
    train, test = _trained(aside[own.to_numpy()], y)
    w, bias = logistic.fit_dense(x[train].astype(np.float32), y[train])
    return (w, bias, *logistic.calibrated(x[test].astype(np.float32) @ w + bias, y[test]))


def _fit_toxic(rows: pa.Table, aside: np.ndarray, least: int = 3) -> tuple | None:
    own = pc.is_valid(rows["toxic"])
    some = rows.filter(own)
    y = (some["toxic"].to_numpy() > 0).astype(float)
    if not _both_kinds(y):
        return None
    sizes = pc.binary_length(some["words"]).to_numpy().astype(np.int64) // 4
    words = _joined(some["words"], "<u4")
    seen, times = np.unique(words, return_counts=True)
    seen = seen[times >= least]
    if not len(seen):
        return None
    at = np.minimum(np.searchsorted(seen, words), len(seen) - 1)
    hit = seen[at] == words
    sizes = summed(hit.astype(np.int64), sizes)
    at = at[hit].astype(np.int32)
    row = np.repeat(np.arange(len(y), dtype=np.int32), sizes)
    train, test = _trained(aside[own.to_numpy()], y)
    w, bias = logistic.fit_sparse(at[train[row]], sizes[train], len(seen), y[train])
    z = summed(w[at[test[row]]], sizes[test]) + bias
    used = w != 0
    return (seen[used].astype(np.int64), w[used], bias, *logistic.calibrated(z, y[test]))


def score(s: Slice, counts: dict[str, np.ndarray], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of junk and of toxic texts (0 where there is no model)."""
    junk = toxic = np.zeros(len(s.size))
    if model.junk is not None:
        w, bias, slope, offset = model.junk
        x = junk_features(s.trigrams(), counts)
        junk = logistic.sigmoid(slope * (x @ w + bias) + offset)
    if model.toxic is not None:
        seen, w, bias, slope, offset = model.toxic
        words, n = s.word_hashes()
        if len(seen):
            at = np.minimum(np.searchsorted(seen, words), len(seen) - 1)
            hit = np.where(seen[at] == words, w[at], 0.0)
        else:
            hit = np.zeros(len(words))
        toxic = logistic.sigmoid(slope * (summed(hit, n) + bias) + offset)
    return junk, toxic


def small_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """At most 256 rows and about 1 MB of text, so that the trigram table stays small."""
    for batch in text_slices(batches, "text", 1 << 20):
        for at in range(0, batch.num_rows, 256):
            yield batch.slice(at, 256)


def verdict(texts: pa.Array, model: Model) -> tuple:
    """Signals, who fails the base rules, who is kept, and both probabilities."""
    s = Slice(texts)
    counts = s.counts()
    failed = ((counts["n_words"] < MIN_WORDS)
              | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]))
    junk, toxic = score(s, counts, model)
    return counts, failed, ~failed & (junk < model.junk_limit) & (toxic < model.toxic_limit), junk, toxic


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, the counted signals, ``base_failed``, ``kept``, ``p_junk``, ``p_toxic``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small_slices(batches):
            counts, failed, kept, junk, toxic = verdict(part.column("text"), model)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(counts[c], pa.int64()) for c in COLUMNS),
                 pa.array(failed), pa.array(kept), pa.array(junk), pa.array(toxic)],
                ["doc_id", *COLUMNS, "base_failed", "kept", "p_junk", "p_toxic"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        rows, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COLUMNS)
        + ", base_failed boolean, kept boolean, p_junk double, p_toxic double")


def filter_quality(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep. No shuffle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small_slices(batches):
            yield part.filter(pa.array(verdict(part.column("text"), model)[2]))

    return docs.mapInArrow(rows, docs.schema)
