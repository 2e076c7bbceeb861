"""Anchors: places in a text that any two equal stretches of it agree on.

The anchor of a ``SPAN``-byte string is the place in it whose ``GRAM`` bytes hash lowest
(leftmost of equals). It depends on nothing outside the string, so all copies of a string,
wherever they are, have the same anchor. Consecutive strings share anchors; a text has about
one for every 35 bytes.
"""

from __future__ import annotations

import numpy as np

SPAN = 100
GRAM = 32
WIDTH = SPAN - GRAM + 1  # places of grams in a span
MIX = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes at every place (shorter by ``GRAM`` - 1)."""
    with np.errstate(over="ignore"):
        h = (raw.astype(np.uint64) + np.uint64(1)) * MIX
        h ^= h >> np.uint64(29)
        width, factor = 1, np.uint64(0xBF58476D1CE4E5B9)
        while width < GRAM:
            h = h[:-width] * factor + h[width:]
            factor = factor * factor
            width *= 2
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(30)
    return h


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:len(x) - (width - have)], x[width - have:]) if width > have else x


def anchors(raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """For texts that lie in a row in ``raw``: hash, place, first and last span of each anchor.

    Spans do not cross texts; texts shorter than a span have none.
    """
    none = np.array([], np.int64)
    if len(raw) < SPAN:
        return none.view(np.uint64), none, none, none
    h = gram_hashes(raw)
    key = (h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
    at = (sliding_least(key, WIDTH) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ends = np.repeat(np.cumsum(sizes), sizes)[:len(at)]
    spans = np.flatnonzero(np.arange(len(at)) + SPAN <= ends)
    at = at[spans]
    if not len(at):
        return none.view(np.uint64), none, none, none
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    return h[at[first]], at[first], spans[first], spans[last]
