"""Acyclic count transducers: automata over word sequences that give each its weight.

``Layers`` is a transducer spread out as a tree in sorted order: for each depth the label,
parent and weight of every node. Labels count a sorted table of words, so the nodes of a layer
are in the byte order of their sequences. ``folded`` is the automaton itself: states of equal
weight with equal arcs are one state. It is built from sorted sequences range by range, the
last layer first; what lies behind a cut is finished and never touched again.

The operations work on layers: ``union`` adds up equal sequences, ``cuts`` and ``piece`` divide
by ranges of sequences, ``looked_up`` composes a transducer with an acceptor of queries.
Weights are whole numbers from 0 up; a state that only leads on to others has weight 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from scrutiny.llm.blobs import packed, unpacked
from scrutiny.llm.encoding import slots
from scrutiny.llm.words import numbered

NONE = np.zeros(0, np.int64)
#: Odd factors that mix a state's parts into one number.
MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class Layers(NamedTuple):
    words: pa.Array
    label: list[np.ndarray]
    parent: list[np.ndarray]  # node of the layer above; 0 in the first layer
    weight: list[np.ndarray]

    def children(self, depth: int) -> np.ndarray:
        """Where the children of each node begin in the next layer, and where the last ends."""
        return np.searchsorted(self.parent[depth + 1], np.arange(len(self.label[depth]) + 1))


def grown(label: np.ndarray, parent: np.ndarray, n_labels: int, weight: np.ndarray | None = None,
          most: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct nodes of rows (label, parent) in order: label, parent, weight; and the
    node of each row. Weights are summed (or the largest taken); without them rows count."""
    size = max(1, n_labels)
    nodes, at, n = np.unique(parent * size + label, return_inverse=True, return_counts=True)
    if weight is not None:
        n = np.zeros(len(nodes), np.int64)
        (np.maximum if most else np.add).at(n, at, weight)
    return nodes % size, nodes // size, n, at


def of_rows(groups: Sequence[tuple[Sequence[np.ndarray], np.ndarray | None]], words: pa.Array,
            depth: int) -> Layers:
    """Layers of the given sequences and their prefixes: columns of labels for each length,
    and the weight of each sequence (of repeated ones the largest)."""
    label, parent, weight = [], [], []
    at = [np.zeros(len(columns[0]), np.int64) for columns, _ in groups]
    for d in range(depth):
        live = [k for k, (columns, _) in enumerate(groups) if len(columns) > d]
        worth = [groups[k][1] if len(groups[k][0]) == d + 1 and groups[k][1] is not None
                 else np.zeros(len(at[k]), np.int64) for k in live]
        a, b, w, node = grown(np.concatenate([NONE, *(groups[k][0][d] for k in live)]),
                              np.concatenate([NONE, *(at[k] for k in live)]), len(words),
                              np.concatenate([NONE, *worth]), most=True)
        for k, part in zip(live, np.split(node, np.cumsum([len(at[k]) for k in live])[:-1])):
            at[k] = part
        label.append(a)
        parent.append(b)
        weight.append(w)
    return Layers(words, label, parent, weight)


def counted(first: np.ndarray, word: np.ndarray, piece: np.ndarray, words: pa.Array,
            longest: int = 3) -> Layers:
    """Counts of all word sequences up to ``longest`` that stay in a piece, below ``first``."""
    label, parent, weight = [], [], []
    at = np.zeros(len(word), np.int64)
    for d in range(longest + 1):
        if d < 2:
            rows, step = (first if d == 0 else word), at
        else:
            far = d - 1
            inside = piece[far:] == piece[:-far] if far < len(piece) else np.zeros(0, bool)
            step = at[:len(inside)][inside]
            rows = word[far:][inside]
        a, b, n, node = grown(rows, step, len(words))
        if d >= 2:
            spread = np.zeros(len(word), np.int64)
            spread[:len(inside)][inside] = node
            node = spread
        at = node
        label.append(a)
        parent.append(b)
        weight.append(n)
    return Layers(words, label, parent, weight)


def union(parts: Sequence[Layers], most: bool = False) -> Layers:
    """All sequences of the parts; weights of equal ones are added (or the largest taken)."""
    codes, words = numbered([p.words for p in parts])
    codes = np.split(codes, np.cumsum([len(p.words) for p in parts])[:-1])
    depth = len(parts[0].label)
    label, parent, weight = [], [], []
    at = [np.zeros(1, np.int64)] * len(parts)
    for d in range(depth):
        a, b, w, node = grown(
            np.concatenate([c[p.label[d]] for c, p in zip(codes, parts)]),
            np.concatenate([up[p.parent[d]] for up, p in zip(at, parts)]), len(words),
            np.concatenate([p.weight[d] for p in parts]), most)
        at = np.split(node, np.cumsum([len(p.label[d]) for p in parts])[:-1])
        label.append(a)
        parent.append(b)
        weight.append(w)
    return Layers(words, label, parent, weight)


def chosen(layers: Layers, keep: list[np.ndarray]) -> Layers:
    """The nodes to keep and those that lead to them; only words still in use."""
    keep = [k.copy() for k in keep]
    for d in range(len(keep) - 1, 0, -1):
        keep[d - 1][layers.parent[d][keep[d]]] = True
    label = [a[k] for a, k in zip(layers.label, keep)]
    parent = [layers.parent[0][keep[0]]]
    for d in range(1, len(keep)):
        parent.append((np.cumsum(keep[d - 1]) - 1)[layers.parent[d][keep[d]]])
    return _trimmed(layers.words, label, parent, [w[k] for w, k in zip(layers.weight, keep)])


def _trimmed(words: pa.Array, label: list[np.ndarray], parent: list[np.ndarray],
             weight: list[np.ndarray]) -> Layers:
    used = np.zeros(len(words), bool)
    for a in label:
        used[a] = True
    number = np.cumsum(used) - 1
    return Layers(words.take(pa.array(np.flatnonzero(used))), [number[a] for a in label], parent,
                  weight)


def cuts(layers: Layers, splitters: Sequence[Sequence[bytes]]) -> list[np.ndarray]:
    """For each layer, how many of its nodes lie before each splitter (a prefix comes before
    its extensions), with 0 in front and the number of nodes at the end."""
    depth = len(layers.label)
    below = [layers.children(d) for d in range(depth - 1)]
    known = sorted({w for s in splitters for w in s})
    spot, exact = _places(layers.words, known)
    place = {w: (int(p), bool(e)) for w, p, e in zip(known, spot, exact)}
    out = np.zeros((depth, len(splitters) + 2), np.int64)
    for k, s in enumerate(splitters, 1):
        lo, hi = 0, len(layers.label[0])
        for d in range(depth):
            code, is_there = place[s[d]] if d < len(s) else (0, False)
            at = lo + int(np.searchsorted(layers.label[d][lo:hi], code)) if d < len(s) else lo
            there = is_there and at < hi and layers.label[d][at] == code
            out[d, k] = at + (there and d + 1 < len(s))
            if d + 1 < depth:
                lo = int(below[d][at])
                hi = int(below[d][at + 1]) if there else lo
    out[:, -1] = [len(a) for a in layers.label]
    return list(out)


def _places(words: pa.Array, wanted: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Where each word stands or would stand in the table, and whether it is there."""
    if not wanted:
        return NONE, np.zeros(0, bool)
    codes, table = numbered([words, pa.array(wanted, pa.binary())])
    there = np.zeros(len(table) + 1, np.int64)
    there[codes[:len(words)] + 1] = 1
    spot = np.cumsum(there)[codes[len(words):]]
    return spot, there[codes[len(words):] + 1] == 1


def piece(layers: Layers, low: Sequence[int], high: Sequence[int]) -> Layers:
    """The sequences between two cuts, with the states that lead to them."""
    depth = len(layers.label)
    low, high = list(map(int, low)), list(map(int, high))
    first, last = low[:], high[:]
    for d in range(depth - 1, 0, -1):
        if first[d] < last[d]:
            up = layers.parent[d]
            a, b = int(up[first[d]]), int(up[last[d] - 1]) + 1
            first[d - 1], last[d - 1] = ((min(a, low[d - 1]), max(b, high[d - 1]))
                                         if low[d - 1] < high[d - 1] else (a, b))
    weight = []
    for d in range(depth):
        w = layers.weight[d][first[d]:last[d]].copy()
        w[:max(0, low[d] - first[d])] = 0
        w[max(0, high[d] - first[d]):] = 0
        weight.append(w)
    label = [a[i:j] for a, i, j in zip(layers.label, first, last)]
    parent = [layers.parent[0][first[0]:last[0]]] + [
        layers.parent[d][first[d]:last[d]] - first[d - 1] for d in range(1, depth)]
    return _trimmed(layers.words, label, parent, weight)


def found(layers: Layers, columns: Sequence[np.ndarray]) -> np.ndarray:
    """The node of each sequence of labels (-1: there is none); a label of -1 is no word."""
    n = max(1, len(layers.words))
    at = np.zeros(len(columns[0]), np.int64)
    for d, label in enumerate(columns):
        keys = layers.parent[d] * n + layers.label[d]
        spot = np.minimum(np.searchsorted(keys, at * n + label), max(0, len(keys) - 1))
        good = (at >= 0) & (label >= 0)
        if len(keys):
            good &= keys[spot] == at * n + label
        else:
            good[:] = False
        at = np.where(good, spot, -1)
    return at


def translated(source: pa.Array, target: pa.Array) -> np.ndarray:
    """For each word of a table its number in another one (-1: not there)."""
    return pc.fill_null(pc.index_in(source, target), -1).to_numpy(False).astype(np.int64)


def looked_up(layers: Layers, queries: Layers) -> list[np.ndarray]:
    """Composition with an acceptor: the node of each query node, layer by layer (-1: none)."""
    code, n = translated(queries.words, layers.words), max(1, len(layers.words))
    out: list[np.ndarray] = []
    for d, label in enumerate(queries.label):
        up = out[-1][queries.parent[d]] if d else np.zeros(len(label), np.int64)
        keys, wanted = layers.parent[d] * n + layers.label[d], up * n + code[label]
        good = (up >= 0) & (code[label] >= 0)
        spot = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
        good &= keys[spot] == wanted if len(keys) else False
        out.append(np.where(good, spot, -1))
    return out


def stacked(parts: Sequence[Layers]) -> Layers:
    """The nodes of all parts side by side, layer by layer, nothing united: one acceptor to look
    up instead of many. Its nodes are not in the order of their sequences."""
    codes, words = numbered([p.words for p in parts])
    codes = np.split(codes, np.cumsum([len(p.words) for p in parts])[:-1])
    label, parent, weight = [], [], []
    first = [0] * len(parts)
    for d in range(len(parts[0].label)):
        label.append(np.concatenate([c[p.label[d]] for c, p in zip(codes, parts)]))
        parent.append(np.concatenate([p.parent[d] + at for at, p in zip(first, parts)]))
        weight.append(np.concatenate([p.weight[d] for p in parts]))
        first = np.cumsum([0, *(len(p.label[d]) for p in parts[:-1])]).tolist()
    return Layers(words, label, parent, weight)


def apart(whole: Layers, parts: Sequence[Layers]) -> list[list[np.ndarray]]:
    """The weights of stacked parts, for each part."""
    layers = [np.split(w, np.cumsum([len(p.label[d]) for p in parts])[:-1])
              for d, w in enumerate(whole.weight)]
    return [list(own) for own in zip(*layers)]


def weights_at(layers: Layers, depth: int, nodes: np.ndarray) -> np.ndarray:
    """Weights of nodes of a layer; 0 for -1."""
    return np.append(layers.weight[depth], 0)[nodes]


def _equal_states(weight: np.ndarray, first: np.ndarray, n: np.ndarray, label: np.ndarray,
                  target: np.ndarray) -> np.ndarray:
    """For each node a node with the same weight and the same arcs (itself, or an earlier one)."""
    mixed = weight.astype(np.uint64) * MIX[0]
    full = n > 0
    if full.any():
        arcs = (label.astype(np.uint64) * MIX[1]) ^ ((target.astype(np.uint64) + MIX[0]) * MIX[2])
        arcs *= MIX[0]
        arcs ^= arcs >> np.uint64(29)
        mixed[full] ^= np.add.reduceat(arcs, first[full]) * MIX[2]
    _, where, at = np.unique(mixed, return_index=True, return_inverse=True)
    like = where[at]
    same = (weight == weight[like]) & (n == n[like])
    check = np.flatnonzero(same & full & (like != np.arange(len(like))))
    if len(check):  # the number only proposes; the arcs decide
        size = n[check]
        mine, other = slots(first[check], size), slots(first[like[check]], size)
        equal = (label[mine] == label[other]) & (target[mine] == target[other])
        same[check] = np.logical_and.reduceat(equal, np.cumsum(size) - size)
    return np.where(same, like, np.arange(len(like)))


def folded(layers: Layers) -> bytes:
    """The automaton as bytes: arcs of the root, then for each depth the states (weight and
    number of arcs) and, in their order, the arcs (label and state of the next depth)."""
    label, state, tables = NONE, NONE, []
    for d in range(len(layers.label) - 1, -1, -1):
        size = len(layers.label[d])
        bounds = layers.children(d) if d + 1 < len(layers.label) else np.zeros(size + 1, np.int64)
        n = np.diff(bounds)
        like = _equal_states(layers.weight[d], bounds[:-1], n, label, state)
        kept = np.flatnonzero(like == np.arange(size))
        arcs = slots(bounds[:-1][kept], n[kept])
        tables = [layers.weight[d][kept], n[kept], label[arcs], state[arcs], *tables]
        number = np.zeros(size, np.int64)
        number[kept] = np.arange(len(kept))
        label, state = layers.label[d], number[like]
    return packed([label, state, *tables], layers.words)


def unfolded(blob: bytes) -> Layers:
    """The layers of an automaton."""
    (label, state, *tables), words = unpacked(blob)
    out = Layers(words, [label], [np.zeros(len(label), np.int64)], [tables[0][state]])
    for d in range(0, len(tables) - 4, 4):
        n, arc_label, arc_state = tables[d + 1], tables[d + 2], tables[d + 3]
        size = n[state]
        arcs = slots((np.cumsum(n) - n)[state], size)
        out.parent.append(np.repeat(np.arange(len(state)), size))
        out.label.append(arc_label[arcs])
        state = arc_state[arcs]
        out.weight.append(tables[d + 4][state])
    return out


def sequence(layers: Layers, depth: int, nodes: np.ndarray) -> list[np.ndarray]:
    """The labels from the root to each of some nodes of a layer."""
    out = []
    for d in range(depth, -1, -1):
        out.append(layers.label[d][nodes])
        nodes = layers.parent[d][nodes]
    return out[::-1]
