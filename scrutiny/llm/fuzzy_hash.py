"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last eight bytes decides where a chunk ends: at block level ``k`` where
it ends in ``k`` zero bits, so chunks have 2^k bytes on average and the ends of a level are
among those of the level below. Each chunk's polynomial hash becomes one of 64 symbols. The
level of a text is the lowest one with at most 64 chunks, or the one below if that leaves
fewer than 16 (texts that repeat themselves have many ends of one level and none of the next);
then the 64th symbol stands for all the rest. The fingerprint is ``level:symbols:symbols of the
next level``. All bytes count at every level; an edit changes the symbols around it, and the
ends fall into step again eight bytes later.

Two fingerprints are compatible if a level is in both. Their likeness is 1 - d / m at the best
common level, d the edit distance of the symbols and m the longer length, or 0 if the symbols
share no run of seven (of fewer than 28 symbols, no run of a quarter of them): unlike texts
agree in single symbols by chance. Equal fingerprints have likeness 1.

Defined results: a null text is the empty one, whose fingerprint ``0::`` is like itself only;
rows without an identifier stand last in descending order; rows with equal identifiers are
ordered by their texts, so repeated rows have each other as neighbours; texts of any length
are hashed whole, in blocks; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrutiny.llm.common import stored, text_slices, texts_of

MOST, FEW = 64, 16  # symbols of a level
RUN = 7
BLOCK = 1 << 20  # bytes hashed at once
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
ROLL = 0x01000193
CHUNK = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64


def _powers(base: int) -> np.ndarray:
    out = np.full(BLOCK + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


POWERS, INVERSES = _powers(CHUNK), _powers(pow(CHUNK, -1, 1 << 64))
#: The rolling hash adds up windows of 1, 2 and 4 bytes to twice their width.
STEPS = tuple((n, np.uint32(pow(ROLL, n, 1 << 32))) for n in (1, 2, 4))


def ends(data: np.ndarray, before: np.ndarray) -> np.ndarray:
    """For each byte the highest level at which a chunk ends after it (32 at most).

    ``before`` are the seven bytes in front (zeros at the start of a text).
    """
    x = np.concatenate([before, data]).astype(np.uint32)
    for n, factor in STEPS:
        x = x[n:] + factor * x[:-n]
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x2C1B3C6D)
    x ^= x >> np.uint32(12)
    low = x & (~x + np.uint32(1))
    level = (low.astype(np.float32).view(np.uint32) >> np.uint32(23)).astype(np.int16) - 127
    level[x == 0] = 32
    return level


def _blocks(data: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for start in range(0, len(data), BLOCK):
        before = data[max(0, start - 7):start]
        part = data[start:start + BLOCK]
        yield start, part, ends(part, np.concatenate([np.zeros(7 - len(before), np.uint8), before]))


def fingerprint(text: bytes) -> str:
    """Level and symbols of two levels; see the module's text."""
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return "0::"
    blocks = list(_blocks(data)) if len(data) <= BLOCK else None
    tally = np.zeros(33, np.int64)
    for _, _, level in blocks or _blocks(data):
        tally += np.bincount(level, minlength=33)
    tally[level[-1]] -= 1  # after the last byte a chunk ends anyway
    chunks = np.append(np.cumsum(tally[::-1])[::-1], 0) + 1
    k = int(np.argmax(chunks <= MOST))
    k -= k > 0 and bool(chunks[k] < FEW)
    at, high, sums, carry = [], [], [], np.uint64(0)
    for start, part, level in blocks or _blocks(data):
        total = np.cumsum((part.astype(np.uint64) + np.uint64(1)) * POWERS[:len(part)])
        total *= np.uint64(pow(CHUNK, start, 1 << 64))
        total += carry
        carry = total[-1]
        here = np.flatnonzero(level[:len(data) - 1 - start] >= k)
        at.append(here + start + 1)
        high.append(level[here])
        sums.append(total[here])
    at, high = np.concatenate([*at, [len(data)]]), np.concatenate([*high, [33]])
    sums = np.append(np.concatenate(sums), carry)
    upper = high > k
    return f"{k}:{_symbols(at, sums)}:{_symbols(at[upper], sums[upper])}"


def _symbols(at: np.ndarray, sums: np.ndarray) -> str:
    """A symbol for each chunk from the running sums at the ends; the last has the rest."""
    if len(at) > MOST:
        at, sums = (np.append(x[:MOST - 1], x[-1:]) for x in (at, sums))
    start = np.concatenate([[0], at[:-1]])
    back = INVERSES[start % BLOCK]
    if start[-1] >= BLOCK:
        inverse = pow(CHUNK, -1, 1 << 64)
        back = back * np.array([pow(inverse, s - s % BLOCK, 1 << 64) for s in start.tolist()], np.uint64)
    h = (sums - np.concatenate([[np.uint64(0)], sums[:-1]])) * back
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return "".join([SYMBOLS[s] for s in (h >> np.uint64(58)).tolist()])


def likeness(a: list[str], b: list[str]) -> np.ndarray:
    """Likeness of pairs of fingerprints, 0 to 1."""
    out = np.zeros(len(a))
    where, left, right = [], [], []
    for i, (x, y) in enumerate(zip(a, b)):
        if x == y:
            out[i] = 1.0
            continue
        k, *one = x.split(":")
        m, *two = y.split(":")
        step = int(m) - int(k)
        for s, t in zip(one[step:] if step > 0 else one, two[-step:] if step < 0 else two):
            short = min(len(s), len(t))
            need = max(1, min(RUN, short // 4))
            if short and not {s[j:j + need] for j in range(len(s) - need + 1)}.isdisjoint(
                    t[j:j + need] for j in range(len(t) - need + 1)):
                where.append(i)
                left.append(s)
                right.append(t)
    if where:
        size = np.maximum(*(np.fromiter(map(len, x), np.int64, len(x)) for x in (left, right)))
        np.maximum.at(out, where, 1.0 - distances(left, right) / size)
    return out


def distances(left: list[str], right: list[str]) -> np.ndarray:
    """Edit distances of pairs of strings of 1 to 64 symbols: Myers' bit vectors, a machine word
    for each pair, all pairs at once."""
    n = len(left)
    m, size = (np.fromiter(map(len, x), np.int64, n) for x in (left, right))
    code = np.zeros(128, np.int64)
    code[[ord(c) for c in SYMBOLS]] = np.arange(64)
    width = max(MOST, int(max(m.max(), size.max())))
    p, t = (code[np.frombuffer("".join(s.ljust(width, "A") for s in x).encode(), np.uint8)]
            .reshape(n, width) for x in (left, right))
    rows, one = np.arange(n), np.uint64(1)
    where = np.zeros((n, 64), np.uint64)
    for j in range(int(m.max())):
        live = rows[m > j]
        where[live, p[live, j]] |= one << np.uint64(j)
    last = (m - 1).astype(np.uint64)
    up, down = np.full(n, ~np.uint64(0)), np.zeros(n, np.uint64)
    score = m.copy()
    for j in range(int(size.max())):
        equal = where[rows, t[:, j]]
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        more, less = down | ~(horizontal | up), up & horizontal
        change = ((more >> last) & one).astype(np.int64) - ((less >> last) & one).astype(np.int64)
        score += np.where(size > j, change, 0)
        more, less = (more << one) | one, less << one
        up, down = less | ~(vertical | more), more & vertical
    return score


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fingerprint`` of every row; no shuffle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            found = [fingerprint(t.encode()) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found)],
                                             ["key", "fingerprint"])

    kind = docs.schema[key].dataType.simpleString()
    return (docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
            .mapInArrow(rows, f"key {kind}, fingerprint string").withColumnRenamed("key", key))


def compared(pairs: DataFrame, a: str, b: str, name: str = "likeness") -> DataFrame:
    """Pairs of fingerprints with their likeness (null if one of them is)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(c).to_pylist() for c in (a, b))
            known = [x is not None and y is not None for x, y in zip(left, right)]
            near = likeness([x or "0::" for x in left], [y or "0::" for y in right])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near, mask=~np.array(known, bool))],
                [*batch.schema.names, name])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema)
    return pairs.mapInArrow(rows, f"{ddl}, `{name}` double")


RESULT = ("n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def edited_neighbours(docs: DataFrame) -> DataFrame:
    """Every document compared with its edited text and with the next document.

    The next one is that of the next smaller identifier (of the last, the first). The edited
    text is the text with its last half of code points replaced by as many from the beginning
    of the next one. Rows are ranged and sorted once; in a task the next row is the next
    document, and only the first and last row of each task are joined across tasks.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    order: list[Column] = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "tie", F.xxhash64("text"))
    done = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
        .drop("tie").mapInArrow(_in_order, f"doc_id {kind}, {RESULT}, part int, edge string, text string"),
        "neighbours")
    inner = done.where("edge IS NULL").select("doc_id", *_names(RESULT))
    first = done.where("edge = 'first'").select("part", F.col("text").alias("next_text"))
    last = done.where("edge = 'last'").select("doc_id", "part", "text")
    around = Window.orderBy("part")  # a number for each task
    after = first.select("part").select(
        F.col("part").alias("at"),
        F.coalesce(F.lead("part").over(around),
                   F.min("part").over(around.rowsBetween(Window.unboundedPreceding, 0))).alias("part"))
    outer = (last.withColumnRenamed("part", "at").join(after, "at").join(first, "part")
             .select("doc_id", "text", "next_text").mapInArrow(_pairs, f"doc_id {kind}, {RESULT}"))
    return inner.unionByName(outer)


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def _results(texts: list[str], following: list[str], prints: list[str],
             next_prints: list[str]) -> list[pa.Array]:
    edited = []
    for t, u in zip(texts, following):
        half = len(t) // 2
        edited.append((t[:len(t) - half] + u[:half]).encode())
    marks = [fingerprint(e) for e in edited]
    return [pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
            pa.array(prints, pa.string()), pa.array(marks, pa.string()),
            pa.array(likeness(prints, marks)), pa.array(likeness(prints, next_prints))]


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all rows but the last; the first and the last with their texts."""
    part = TaskContext.get().partitionId()
    names = ["doc_id", *_names(RESULT), "part", "edge", "text"]
    open_row = kind = None

    def edge(which: str, key, text: str) -> pa.RecordBatch:
        empty = [pa.nulls(1, t) for t in (pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64())]
        return pa.RecordBatch.from_arrays(
            [pa.array([key], kind), *empty, pa.array([part], pa.int32()), pa.array([which]),
             pa.array([text], pa.string())], names)

    for batch in text_slices(batches, "text"):
        kind = batch.schema.field("doc_id").type
        texts = texts_of(batch)
        keys = batch.column("doc_id").to_pylist()
        prints = [fingerprint(t.encode()) for t in texts]
        if open_row is None:
            yield edge("first", None, texts[0])
        else:
            keys, texts, prints = [open_row[0], *keys], [open_row[1], *texts], [open_row[2], *prints]
        open_row = keys[-1], texts[-1], prints[-1]
        n = len(texts) - 1
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[:n], kind), *_results(texts[:n], texts[1:], prints[:n], prints[1:]),
                 pa.array(np.full(n, part, np.int32)), pa.nulls(n, pa.string()),
                 pa.nulls(n, pa.string())], names)
    if open_row is not None:
        yield edge("last", open_row[0], open_row[1])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text"):
        texts, following = texts_of(batch), texts_of(batch, "next_text")
        prints, others = ([fingerprint(t.encode()) for t in x] for x in (texts, following))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *_results(texts, following, prints, others)],
            ["doc_id", *_names(RESULT)])
