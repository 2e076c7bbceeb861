"""Words of whole texts, cut out of Arrow buffers without a Python object for each.

``lower`` and ``kind`` are tables over the 256 byte values: A-Z fall to a-z, and a byte belongs
to a word, separates words, or ends a piece. All separators are ASCII, so a character of
several bytes is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD, GAP, BREAK = 0, 1, 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of a text worked on at once; a longer text is cut at separators.
BLOCK = 4 << 20


def kinds(gap: bytes, stop: bytes = b"") -> np.ndarray:
    """Byte classes from the bytes that separate words and those that end a piece."""
    out = np.zeros(256, np.uint8)
    out[list(gap)] = GAP
    out[list(stop)] = BREAK
    return out


class Words(NamedTuple):
    """Words in text order: the row and piece of each. A piece number is used once."""

    words: list[pa.Array]
    row: np.ndarray
    piece: np.ndarray


def cut(texts: pa.Array, kind: np.ndarray) -> Words:
    """The words of each row; null counts as the empty text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return Words([], np.zeros(0, np.int64), np.zeros(0, np.int64))
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    words, rows, pieces, breaks = [], [], [], 0
    for a, b in _blocks(data, kind):
        part, sort = data[a:b], kind[data[a:b]]
        inside = sort == WORD
        if not inside.any():
            breaks += int((sort == BREAK).sum())
            continue
        first = np.zeros(len(part) + 1, bool)  # rows begin here
        own = ends[np.searchsorted(ends, a):np.searchsorted(ends, b, "right")] - a
        first[own] = True
        before = np.concatenate([[False], inside[:-1]])
        start = np.flatnonzero(inside & (~before | first[:-1]))
        after = np.concatenate([inside[1:], [False]])
        end = np.flatnonzero(inside & (~after | first[1:])) + 1
        row = np.searchsorted(ends, start + a, "right") - 1
        stops = np.cumsum(sort == BREAK)
        size = end - start
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        words.append(pa.BinaryArray.from_buffers(
            pa.binary(), len(size),
            [None, pa.py_buffer(offsets), pa.py_buffer(LOWER[part[inside]])]))
        rows.append(row)
        pieces.append(breaks + stops[start] + row)
        breaks += int(stops[-1])
    none = np.zeros(0, np.int64)
    return Words(words, np.concatenate([none, *rows]), np.concatenate([none, *pieces]))


def _blocks(data: np.ndarray, kind: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of about ``BLOCK`` bytes that end after a separator (or at the end)."""
    start = 0
    while start < len(data):
        end = min(len(data), start + BLOCK)
        while end < len(data):
            near = np.flatnonzero(kind[data[end - 4096 if end - start > 4096 else start:end]])
            if len(near):
                end -= min(4096, end - start) - int(near[-1]) - 1
                break
            end = min(len(data), end + BLOCK)
        yield start, end
        start = end


def numbered(words: list[pa.Array]) -> tuple[np.ndarray, pa.Array]:
    """A number for each word, and the distinct words in byte order that they count."""
    if not words:
        return np.zeros(0, np.int64), pa.array([], pa.binary())
    # as one array: the dictionaries of many would each be read again for each other
    whole = pa.chunked_array(words, pa.binary()).cast(pa.large_binary()).combine_chunks()
    coded = whole.dictionary_encode()
    table = coded.dictionary.cast(pa.binary())
    order = pc.array_sort_indices(table)
    rank = np.empty(len(table), np.int64)
    rank[order.to_numpy()] = np.arange(len(table))
    return rank[coded.indices.to_numpy()], table.take(order)
