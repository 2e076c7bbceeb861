"""Repeated substrings of 100 bytes, found by a distributed sparse suffix array.

Every byte goes that is covered by a 100-byte string which also starts earlier (smaller
identifier, or the same document further left), judged on the texts as they came in.

Method. An array of all suffixes would move each byte a hundred times. It is enough to hold
the suffixes that begin at *anchors* (see ``anchors``): equal 100-byte strings have the same
anchor, so two copies of a string meet as two suffixes that share their first 32 bytes, with
the bytes left of the anchor compared too.

1. Texts are gathered in chunks of about 4 MB, compressed and stored.
2. Each chunk names the hashes of its anchors once; hashes that no other place has are
   struck out by one shuffle. Nothing is decided here, unrepeated text only stops travelling.
3. The suffixes left over, one for all equal ones of a chunk, are range-partitioned by their
   leading bytes with sampled splitters. A bucket sorts its suffixes by multikey quicksort on
   eight bytes at a time and compares them with their neighbours: equal suffixes at once,
   partly equal ones string by string. Splitters never part suffixes whose leading 32 bytes
   are equal, so no equal strings lie on both sides of a boundary.
4. The stretches found go back to their chunks, which cut the texts.

However many copies a passage has, a chunk sends it once, so a bucket holds at most as many
of its suffixes as there are chunks, times the variants of its surroundings.

Defined results: a null text is empty; texts below 100 bytes lose nothing; rows without an
identifier neither lose nor cause anything; among rows that share an identifier the order of
reading decides which comes first. A text longer than a chunk is a chunk of its own and is
treated whole; an empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutiny.llm.anchors import GRAM, SPAN, WIDTH, anchors
from scrutiny.llm.common import partitions, stored, text_slices
from scrutiny.llm.encoding import gathered

CHUNK_BYTES = 4 << 20
CHUNKS = "chunk bigint, doc_ids array<bigint>, sizes array<bigint>, blob binary"
#: ``spot`` packs a row of the chunk and a place in its text (see ``packed``). Rows that hold a
#: cut instead of a suffix have its end in ``doc_id`` and an even spread of bytes as suffix.
SUFFIXES = "suffix binary, before binary, chunk bigint, spot bigint, doc_id bigint, cut boolean"
CUTS = "chunk bigint, row int, low bigint, high bigint"
LEFT = WIDTH - 1  # most bytes left of an anchor that a string can have
PLACE = (1 << 40) - 1


def chunked(docs: DataFrame) -> DataFrame:
    """Texts gathered in compressed chunks; in a chunk in the order of identifiers."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=9)
        number = TaskContext.get().partitionId() << 32
        for batch in regrouped(batches):
            keyed = pa.table([batch.column("doc_id"), pa.array(np.arange(batch.num_rows))], ["doc_id", "row"])
            batch = batch.take(pc.sort_indices(keyed, sort_keys=[
                ("doc_id", "ascending"), ("row", "ascending")], null_placement="at_end"))
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                 pa.array([list(map(len, texts))], pa.list_(pa.int64())),
                 pa.array([press.compress(b"".join(texts))], pa.binary())],
                ["chunk", "doc_ids", "sizes", "blob"])
            number += 1

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
            .mapInArrow(rows, CHUNKS))


def regrouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about ``CHUNK_BYTES`` of text, whatever the batches that come in."""
    held, size = [], 0
    for part in text_slices(batches, "text", CHUNK_BYTES // 8):
        n = part.column("text").nbytes
        if held and size + n > CHUNK_BYTES:
            yield one_batch(held)
            held, size = [], 0
        held.append(part)
        size += n
    if held and sum(b.num_rows for b in held):
        yield one_batch(held)


class Chunk:
    """An unpacked chunk with its anchors."""

    def __init__(self, row: dict):
        import zstandard

        self.number, self.doc_ids = row["chunk"], row["doc_ids"]
        self.raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["blob"]), np.uint8)
        self.sizes = np.array(row["sizes"], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def anchors(self) -> tuple[np.ndarray, ...]:
        """Hash, place, first and last span, and row of each anchor of a document with an id."""
        h, at, first, last = anchors(self.raw, self.sizes)
        row = np.searchsorted(self.starts, at, side="right") - 1
        named = np.array([d is not None for d in self.doc_ids], bool)[row]
        return h[named], at[named], first[named], last[named], row[named]


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def repeated_hashes(chunks: DataFrame) -> DataFrame:
    """``chunk, hashes``: the hashes of a chunk's anchors that occur elsewhere or twice."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in unpacked(batches):
            h, n = np.unique(Chunk(row).anchors()[0], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(np.full(len(h), row["chunk"])), pa.array(n > 1)],
                ["hash", "chunk", "twice"])

    def strike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, chunk, twice in whole_runs(batches):
            new = np.concatenate([[True], h[1:] != h[:-1]])
            run = np.cumsum(new) - 1
            n = np.bincount(run, 1 + twice)
            keep = n[run] > 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[keep]), pa.array(chunk[keep])], ["hash", "chunk"])

    return (chunks.mapInArrow(name, "hash bigint, chunk bigint, twice boolean")
            .repartition(partitions(chunks.sparkSession), "hash").sortWithinPartitions("hash")
            .mapInArrow(strike, "hash bigint, chunk bigint")
            .groupBy("chunk").agg(F.collect_list("hash").alias("hashes")))


def whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """The columns of sorted batches, cut where a hash ends."""
    held = None
    for batch in batches:
        own = (batch.column("hash").to_numpy(), batch.column("chunk").to_numpy(),
               batch.column("twice").to_numpy(zero_copy_only=False))
        held = own if held is None else tuple(np.concatenate(x) for x in zip(held, own))
        if not len(held[0]):
            continue
        last = int(np.searchsorted(held[0], held[0][-1]))
        if last:
            yield tuple(x[:last] for x in held)
            held = tuple(x[last:] for x in held)
    if held is not None and len(held[0]):
        yield held


def suffixes(chunks: DataFrame, repeated: DataFrame) -> DataFrame:
    """Suffixes at anchors with a repeated hash, one for all equal ones of a chunk.

    ``suffix`` runs from the anchor to the end of its last string, ``before`` from the start of
    its first string to the anchor. The other equal ones of the chunk are known to go, and
    travel on as cuts, overlapping ones put together.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in unpacked(batches):
            chunk = Chunk(record)
            h, at, first, last, row = chunk.anchors()
            wanted = np.sort(np.array(record["hashes"], np.int64).view(np.uint64))
            near = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
            some = wanted[near] == h
            at, first, last, row = at[some], first[some], last[some], row[some]
            view, seen = chunk.raw.tobytes(), set()
            new = np.zeros(len(at), bool)
            for i, (a, b) in enumerate(zip(first.tolist(), (last + SPAN).tolist())):
                body = view[a:b]
                if body not in seen:
                    seen.add(body)
                    new[i] = True
            yield from suffix_batches(chunk, at[new], first[new], last[new] + SPAN, row[new])
            yield cut_rows(chunk, *joined(first[~new], last[~new] + SPAN, row[~new]))

    return chunks.join(repeated, "chunk").mapInArrow(rows, SUFFIXES)


def packed(row: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (row.astype(np.int64) << 40) | place


def joined(low: np.ndarray, high: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches in ascending order, those put together that overlap or touch."""
    if not len(low):
        return low, high, row
    new = np.concatenate([[True], (low[1:] > np.maximum.accumulate(high)[:-1]) | (row[1:] != row[:-1])])
    start = np.flatnonzero(new)
    return low[start], np.maximum.reduceat(high, start), row[start]


def suffix_batches(chunk: Chunk, at, low, high, row) -> Iterator[pa.RecordBatch]:
    ids = np.array([-1 if d is None else d for d in chunk.doc_ids], np.int64)
    for cut in range(0, len(at), 20_000):
        a, lo, hi, r = (x[cut:cut + 20_000] for x in (at, low, high, row))
        yield pa.RecordBatch.from_arrays(
            [binary(gathered(chunk.raw, a, hi - a), hi - a), binary(gathered(chunk.raw, lo, a - lo), a - lo),
             pa.array(np.full(len(a), chunk.number)), pa.array(packed(r, a - chunk.starts[r])),
             pa.array(ids[r]), pa.array(np.zeros(len(a), bool))],
            ["suffix", "before", "chunk", "spot", "doc_id", "cut"])


def cut_rows(chunk: Chunk, low, high, row) -> pa.RecordBatch:
    n, base = len(low), chunk.starts[row]
    with np.errstate(over="ignore"):
        mixed = (low.astype(np.uint64) + np.uint64(chunk.number)) * np.uint64(0x9E3779B97F4A7C15)
    return pa.RecordBatch.from_arrays(
        [binary(mixed.view(np.uint8), np.full(n, 8)), binary(np.zeros(0, np.uint8), np.zeros(n, np.int64)),
         pa.array(np.full(n, chunk.number)), pa.array(packed(row, low - base)),
         pa.array(high - base), pa.array(np.ones(n, bool))],
        ["suffix", "before", "chunk", "spot", "doc_id", "cut"])


def binary(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))])


def multikey_sorted(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a table of big-endian words, and a number for each run of equals.

    Multikey quicksort, eight bytes at a time: rows are sorted by a word, and only runs that
    are still equal go on to the next one.
    """
    n, width = words.shape
    order, run = np.arange(n), np.zeros(n, np.int64)
    tied = np.arange(n)  # positions in ``order`` that are not alone in their run
    for depth in range(width):
        key = words[order[tied], depth]
        by = np.lexsort((key, run[tied]))
        order[tied] = order[tied][by]
        key = words[order[tied], depth]
        new = np.zeros(n, bool)
        new[tied[1:]] = (key[1:] != key[:-1]) & (run[tied[1:]] == run[tied[:-1]])
        run = run + np.cumsum(new)
        alone = np.bincount(run)[run] == 1
        tied = np.flatnonzero(~alone)
        if not len(tied):
            break
    return order, run


def cuts(rows: DataFrame) -> DataFrame:
    """The stretches to remove, from suffixes in ranges of their leading bytes."""

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_leads(batches):
            known = batch.column("cut").to_numpy(zero_copy_only=False)
            cut = batch.filter(pa.array(known))
            spot = cut.column("spot").to_numpy()
            yield cut_batch(cut.column("chunk").to_numpy(), spot, spot & PLACE,
                            cut.column("doc_id").to_numpy())
            yield from compared(batch.filter(pa.array(~known)))

    lead = F.substring("suffix", 1, GRAM)
    return (rows.repartitionByRange(partitions(rows.sparkSession), lead)
            .sortWithinPartitions(lead).mapInArrow(bucket, CUTS))


def whole_leads(batches: Iterator[pa.RecordBatch], least: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Sorted batches put together, cut where the leading bytes change.

    Rows are put together once, when their leads are complete, so a lead of very many suffixes
    costs time in proportion to them.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        size += batch.num_rows
        if size >= least:
            lead = batch.column("suffix")
            last = lead[batch.num_rows - 1].as_py()[:GRAM]
            stop = bisect_left(range(batch.num_rows), last, key=lambda i: lead[i].as_py()[:GRAM])
            goes_on = not stop and held and held[-1].column("suffix")[-1].as_py()[:GRAM] == last
            if not goes_on:
                done = [*held, batch.slice(0, stop)] if stop else held
                if done:
                    yield one_batch(done)
                held, size, batch = [], batch.num_rows - stop, batch.slice(stop)
        held.append(batch)
    if held:
        yield one_batch(held)


def one_batch(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Batches as one. Arrow splits what is over 2 GB: that is an error here, never a loss."""
    (whole,) = pa.Table.from_batches(parts).combine_chunks().to_batches()
    return whole


def compared(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Cuts among the suffixes of a bucket."""
    n = batch.num_rows
    if n < 2:
        return
    chunk, spot, doc = (batch.column(c).to_numpy() for c in ("chunk", "spot", "doc_id"))
    place = spot & PLACE
    # Around the anchor: at most LEFT bytes before it and SPAN from it on, blank beyond.
    ahead, right = cells(batch.column("suffix"), np.arange(SPAN), False)
    before, left = cells(batch.column("before"), np.arange(LEFT), True)
    around = np.concatenate([left, right], 1)
    # Sort key: the suffix, the bytes before it from right to left, and both lengths.
    pad = np.zeros((n, -(-(LEFT + SPAN + 2) // 8) * 8), np.uint8)
    pad[:, :SPAN] = around[:, LEFT:]
    pad[:, SPAN:SPAN + LEFT] = around[:, :LEFT][:, ::-1]
    pad[:, SPAN + LEFT] = before
    pad[:, SPAN + LEFT + 1] = ahead
    words = pad.view(">u8").astype(np.uint64)
    order, run = multikey_sorted(words)
    rank = np.empty(n, np.int64)
    rank[np.lexsort((spot, chunk, doc))] = np.arange(n)
    # Equal in full: all but the first go whole.
    firsts = np.full(run[-1] + 1, n)
    np.minimum.at(firsts, run, rank[order])
    later = np.zeros(n, bool)
    later[order] = rank[order] != firsts[run]
    yield cut_batch(chunk[later], spot[later], (place - before)[later], (place + ahead)[later])
    # Equal in part: neighbours with the same leading bytes, string by string.
    kept = order[~later[order]]
    lead = words[kept, :GRAM // 8]
    same = (lead[1:] == lead[:-1]).all(1)
    mixed = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    kept = kept[mixed]
    kept = kept[np.argsort(rank[kept])]
    if not len(kept):
        return
    least = SPAN - ahead[kept]  # fewest bytes before the anchor that a string has
    gone = np.zeros((len(kept), LEFT + 2), bool)  # strings by the bytes they have before the anchor
    for d in range(LEFT + 1):
        own = np.flatnonzero((least <= d) & (d <= before[kept]))
        if len(own) < 2:
            continue
        strings = np.ascontiguousarray(
            around[kept[own], LEFT - d:LEFT - d + SPAN]).view(f"V{SPAN}").ravel()
        _, first, which = np.unique(strings, return_index=True, return_inverse=True)
        gone[own[first[which] != np.arange(len(own))], d] = True
    edge = np.diff(gone.astype(np.int8), axis=1, prepend=0)
    who, fewest = np.nonzero(edge == 1)
    most = np.nonzero(edge == -1)[1] - 1
    k = kept[who]
    yield cut_batch(chunk[k], spot[k], place[k] - most, place[k] - fewest + SPAN)


def cells(column: pa.BinaryArray, grid: np.ndarray, from_right: bool) -> tuple[np.ndarray, np.ndarray]:
    """Length of each value, and its bytes in a table, blank where it has none."""
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    sizes = np.diff(offsets)
    at = grid - (len(grid) - sizes[:, None]) if from_right else np.broadcast_to(grid, (n, len(grid)))
    inside = (at >= 0) & (at < sizes[:, None])
    if not len(raw):
        return sizes, np.zeros((n, len(grid)), np.uint8)
    return sizes, np.where(inside, raw[np.clip(offsets[:-1, None] + at, 0, len(raw) - 1)], 0).astype(np.uint8)


def cut_batch(chunk, spot, low, high) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(chunk), pa.array((spot >> 40).astype(np.int32)), pa.array(low), pa.array(high)],
        ["chunk", "row", "low", "high"])


OUT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint"


def applied(chunks: DataFrame, stretches: DataFrame, with_text: bool) -> DataFrame:
    """Each document without its stretches: sizes, a digest or the text itself."""
    lists = stretches.groupBy("chunk").agg(F.collect_list(F.struct("row", "low", "high")).alias("cuts"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.slice(i, 1)
                flat = part.column("cuts").flatten()
                record = part.select(["chunk", "doc_ids", "sizes", "blob"]).to_pylist()[0]
                yield _cut(Chunk(record), *(flat.field(c).to_numpy() for c in ("row", "low", "high")),
                           with_text)

    return chunks.join(lists, "chunk", "left").select(*chunks.columns, "cuts").mapInArrow(
        rows, OUT + (", text string" if with_text else ", kept_sha256 string"))


def _cut(chunk: Chunk, row, low, high, with_text: bool) -> pa.RecordBatch:
    cover = np.zeros(len(chunk.raw) + 1, np.int64)
    np.add.at(cover, chunk.starts[row] + low, 1)
    np.subtract.at(cover, chunk.starts[row] + high, 1)
    gone = np.cumsum(cover)[:-1] > 0
    removed, spans, last = [], [], []
    for a, n in zip(chunk.starts.tolist(), chunk.sizes.tolist()):
        own = gone[a:a + n]
        removed.append(int(own.sum()))
        spans.append(int((own[1:] & ~own[:-1]).sum() + own[0]) if n else 0)
        kept = chunk.raw[a:a + n][~own].tobytes() if removed[-1] else chunk.raw[a:a + n].tobytes()
        last.append(kept.decode(errors="replace") if with_text else hashlib.sha256(kept).hexdigest())
    return pa.RecordBatch.from_arrays(
        [pa.array(chunk.doc_ids, pa.int64()), pa.array(chunk.sizes), pa.array(removed, pa.int64()),
         pa.array(spans, pa.int64()), pa.array(last, pa.string())],
        ["doc_id", "n_bytes", "n_removed", "n_spans", "text" if with_text else "kept_sha256"])


def dedup_substrings(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans`` and the remaining ``text`` (bytes that a cut left
    without their character are replaced), or ``kept_sha256`` of the remaining bytes."""
    chunks = stored(chunked(docs), "chunks", compression="uncompressed")
    rows = suffixes(chunks, repeated_hashes(chunks))
    return applied(chunks, stored(cuts(rows), "cuts"), with_text)
