"""Lexical retrieval packing: windows filled with a seed document and its BM25 neighbours.

Documents are encoded once and stored. Token ids are the terms of BM25; how many documents
hold each id is counted over all documents (the table has at most one row for each id of the
vocabulary, which bounds what is handed to the tasks). Documents with the same most telling
terms lie next to each other after a range partition, and consecutive runs of them are the
shards of the inverted index. In a shard the first unused document seeds a window; the index
returns its unused neighbours, best first, and they fill the window. A document that doesn't
fit is cut, and its rest seeds the next window, so windows are full; the last open window of a
task is cut into sequences whose lengths are powers of two, which need no padding.

The identifier is part of the range key, so documents that share all their terms spread over
any number of tasks. Defined results: a null text is the empty one and has the end id alone;
rows without an identifier and repeated rows are packed like any other; an empty table gives
no piece; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutiny.llm.common import stored, text_slices
from scrutiny.llm.encoding import encoder, slots
from scrutiny.llm.token_output import list_array, run_crcs, with_end

SHARD_DOCS = 256
SHARD_TOKENS = 1 << 20
SLICE_BYTES = 2 << 20  # of ids whose distinct terms are counted at once
K1, B = 1.2, 0.75
#: Neighbours looked at for one that fits the rest of a window whole.
NEAREST = 16


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1,
         with_ids: bool = False) -> DataFrame:
    """A row for each piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset`` and, if asked for, the piece's ``ids``. ``window`` is a power of two."""
    width = id_width(tokenizer)
    encoded = stored(_encoded(docs, tokenizer, end_id, width), "packing-ids", compression="zstd")
    found = encoded.mapInArrow(_presence(width), "id int, n bigint, tokens bigint").groupBy("id").agg(
        F.sum("n").alias("n"), F.sum("tokens").alias("tokens")).collect()  # a row for each id
    size = max([r["id"] for r in found], default=0) + 1
    df = np.zeros(size, np.int64)
    n_docs = n_tokens = 0
    for r in found:
        if r["id"] < 0:  # the row of totals
            n_docs, n_tokens = r["n"], r["tokens"]
        else:
            df[r["id"]] = r["n"]
    idf = np.log1p((n_docs - df + 0.5) / (df + 0.5)).astype(np.float32)
    mean = n_tokens / max(1, n_docs)

    def telling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "ids", SLICE_BYTES):
            first, second = top_terms(*blobs(batch.column("ids"), width), idf)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(first), pa.array(second)],
                ["doc_id", "ids", "first", "second"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window, TaskContext.get().partitionId() << 40, with_ids)
        for doc_ids, arrays in shards(batches, width):
            packer.take(doc_ids, arrays, Index(arrays, idf, mean))
            yield packer.batch()
        packer.close()
        yield packer.batch()

    schema = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
              "sequence_id bigint, offset bigint" + ", ids array<int>" * with_ids)
    return (encoded.mapInArrow(telling, "doc_id bigint, ids binary, first int, second int")
            .repartitionByRange("first", "second", "doc_id")
            .sortWithinPartitions("first", "second", "doc_id")
            .select("doc_id", "ids").mapInArrow(fill, schema))


def id_width(tokenizer: str) -> str:
    """Ids travel as bytes, two for each where the vocabulary allows it."""
    return "<u2" if encoder(tokenizer).tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


def blobs(column: pa.Array, width: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of byte strings in a row, and how many each row has."""
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + n + 1]
    step = int(width[2])
    flat = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]].view(width)
    return flat, np.diff(offsets).astype(np.int64) // step


def _encoded(docs: DataFrame, tokenizer: str, end_id: int, width: str) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in text_slices(batches, "text", 2 << 20):
            flat, sizes = with_end(*enc.ids(batch.column("text")), end_id)
            offsets = np.concatenate([[0], np.cumsum(sizes)]) * int(width[2])
            ids = pa.BinaryArray.from_buffers(
                pa.binary(), len(sizes),
                [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(flat.astype(width))])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
            .mapInArrow(rows, "doc_id bigint, ids binary"))


def term_counts(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number, id and count of each distinct id of each document, in that order."""
    doc = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    code = np.sort((doc << 32) | flat.astype(np.int64))
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.array([], int)
    times = np.diff(np.append(first, len(code)))
    return code[first] >> 32, code[first] & 0xFFFFFFFF, times


def _presence(width: str):
    """How many documents hold each id; totals under id -1."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64)
        n_docs = n_tokens = 0
        for batch in text_slices(batches, "ids", SLICE_BYTES):
            flat, sizes = blobs(batch.column("ids"), width)
            n = np.bincount(term_counts(flat, sizes)[1])
            if len(n) > len(held):
                held = np.concatenate([held, np.zeros(len(n) - len(held), np.int64)])
            held[:len(n)] += n
            n_docs, n_tokens = n_docs + len(sizes), n_tokens + len(flat)
        ids = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(ids, -1).astype(np.int32)), pa.array(np.append(held[ids], n_docs)),
             pa.array(np.append(np.zeros(len(ids), np.int64), n_tokens))], ["id", "n", "tokens"])

    return rows


def top_terms(flat: np.ndarray, sizes: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two ids of each document with the highest tf-idf (-1: there is none)."""
    doc, term, times = term_counts(flat, sizes)
    out = np.full((2, len(sizes)), -1, np.int32)
    if not len(doc):
        return out[0], out[1]
    start = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    n = np.diff(np.append(start, len(doc)))
    value = times * idf[term]
    for k in range(2):
        best = np.repeat(np.maximum.reduceat(value, start), n)
        at = np.flatnonzero((value == best) & (value > 0))
        own, first = np.unique(doc[at], return_index=True)
        out[k, own] = term[at[first]]
        value[at[first]] = 0
    return out[0], out[1]


def shards(batches: Iterator[pa.RecordBatch], width: str) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Consecutive documents, bounded by number and by tokens."""
    keys, arrays, tokens = [], [], 0
    for batch in batches:
        flat, sizes = blobs(batch.column("ids"), width)
        ends = np.cumsum(sizes)
        for key, a, b in zip(batch.column("doc_id").to_pylist(), (ends - sizes).tolist(), ends.tolist()):
            if keys and (len(keys) >= SHARD_DOCS or tokens + b - a > SHARD_TOKENS):
                yield keys, arrays
                keys, arrays, tokens = [], [], 0
            keys.append(key)
            arrays.append(flat[a:b])
            tokens += b - a
    if keys:
        yield keys, arrays


class Index:
    """The inverted BM25 index of a shard: postings by term, with their weights."""

    def __init__(self, arrays: list[np.ndarray], idf: np.ndarray, mean: float):
        sizes = np.array([len(a) for a in arrays])
        doc, term, times = term_counts(np.concatenate(arrays), sizes)
        weight = times * (K1 + 1) / (times + K1 * (1 - B + B * sizes[doc] / mean)) * idf[term]
        self.n = len(arrays)
        self.terms, inverse = np.unique(term, return_inverse=True)
        self.cuts = np.searchsorted(doc, np.arange(self.n + 1))
        self.own = inverse  # terms of each document, in document order
        order = np.argsort(inverse, kind="stable")
        self.docs, self.weights = doc[order], weight[order]
        self.starts = np.searchsorted(inverse[order], np.arange(len(self.terms) + 1))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document of the shard for the terms of the seed."""
        own = self.own[self.cuts[seed]:self.cuts[seed + 1]]
        at, n = self.starts[own], self.starts[own + 1] - self.starts[own]
        entries = slots(at, n)
        return np.bincount(self.docs[entries], self.weights[entries], self.n)


class Packer:
    """Fills windows; what is open at the end of a shard goes on with the next one."""

    def __init__(self, window: int, first_sequence: int, with_ids: bool):
        self.window, self.sequence, self.with_ids = window, first_sequence, with_ids
        self.used = 0  # tokens in the open window
        self.open: list[tuple] = []  # pieces of the open window: key, start, ids, tokens of the document
        self.rows: list[tuple] = []
        self.arrays: list[np.ndarray] = []

    def take(self, keys: list, arrays: list[np.ndarray], index: Index) -> None:
        free = np.ones(len(keys), bool)
        size = np.array([len(a) for a in arrays])
        nxt, seed = 0, None
        while True:
            if seed is None or not self.used:
                while nxt < len(keys) and not free[nxt]:
                    nxt += 1
                if nxt == len(keys):
                    return
                seed = nxt
                chosen = [seed]
            else:
                chosen = self.neighbours(index.scores(seed), free, size)
                if not chosen:
                    return
            for k in chosen:
                free[k] = False
                if self.put(keys[k], arrays[k]):  # a window was filled on the way
                    seed = k if self.used else None
                    break

    def neighbours(self, scores: np.ndarray, free: np.ndarray, size: np.ndarray) -> list[int]:
        """Unused neighbours, best first, up to the one that fills the window."""
        left = np.flatnonzero(free)
        if not len(left):
            return []
        room, chosen = self.window - self.used, []
        order = left[np.argsort(-scores[left], kind="stable")]
        while len(order) and room:
            near = order[:NEAREST]
            fits = near[size[near] <= room]
            k = int(fits[0] if len(fits) else near[0])
            chosen.append(k)
            room -= min(room, int(size[k]))
            order = order[order != k]
        return chosen

    def put(self, key, ids: np.ndarray) -> bool:
        """Add a document; True if it filled at least one window."""
        start, filled = 0, False
        while start < len(ids):
            part = ids[start:start + self.window - self.used]
            self.open.append((key, start, part, len(ids)))
            self.used += len(part)
            start += len(part)
            if self.used == self.window:
                self._write(self.open)
                self.open, self.used, filled = [], 0, True
        return filled

    def close(self) -> None:
        """Cut the open window into sequences whose lengths are powers of two."""
        rest = self.open
        while rest:
            length = 1 << (sum(len(p[2]) for p in rest).bit_length() - 1)
            head, tail, room = [], [], length
            for key, start, part, total in rest:
                a, b = part[:room], part[room:]
                room -= len(a)
                if len(a):
                    head.append((key, start, a, total))
                if len(b):
                    tail.append((key, start + len(a), b, total))
            self._write(head)
            rest = tail
        self.open, self.used = [], 0

    def _write(self, pieces: list[tuple]) -> None:
        offset = 0
        for key, start, part, total in pieces:
            self.rows.append((key, start, len(part), total, self.sequence, offset))
            self.arrays.append(part)
            offset += len(part)
        self.sequence += 1

    def batch(self) -> pa.RecordBatch:
        key, start, length, total, sequence, offset = map(
            list, zip(*self.rows)) if self.rows else ([],) * 6
        sizes = np.array(length, np.int64)
        flat = np.concatenate([*self.arrays, np.array([], np.int32)]).astype(np.int32)
        self.rows, self.arrays = [], []
        long = lambda x: pa.array(x, pa.int64())
        columns = [long(key), long(start), long(length), long(run_crcs(flat, sizes)), long(total),
                   long(sequence), long(offset)]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        if self.with_ids:
            columns, names = [*columns, list_array(flat, sizes)], [*names, "ids"]
        return pa.RecordBatch.from_arrays(columns, names)
