"""Self-join of 64-bit fingerprints within a Hamming budget, by walking a binary trie in pairs.

The root of the trie is split over the cluster first. Cut into ``budget + 2`` blocks of bits,
two fingerprints within the budget agree on at least two whole blocks; so for each choice of
two blocks a trie is built that starts with their bits, and no walk has to leave the subtree
that those bits name. Each subtree is a bucket; a task walks its buckets from pairs of nodes
to pairs of their children, adds up the bits in which the two sides differ and leaves a pair
of nodes as soon as it is over the budget. A trie node is a range of the sorted fingerprints.

What comes out are not all pairs: in each bucket the members of a linked group are tied to
one of them, and each to its nearest, so the rows stay in proportion to the input however
large a group is, and no connection is lost.

``apart`` is for callers that check the pairs of a walk by the similarity of sets, under which ties
that fail leave others undecided: it gives the pairs between groups that are not connected yet.
Nodes may bring the parities of their sets: of each class of elements (by hash) whether the set
has an odd number. Two sets differ in at least as many elements as parities, so a pair whose
parities differ in more than the similarity allows is left out, and no similar one is.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutiny.llm.common import partitions

WALK = 1 << 19  # pairs of nodes looked at together
ROWS = 200_000  # fingerprints of whole buckets worked on together
SMALL = 16  # pairs of leaves below which they are compared at once
ROW_BYTES = 256  # longer rows count more than once


def blocks(budget: int) -> list[tuple[int, int]]:
    """Start (from the highest bit) and width of each of ``budget + 2`` blocks."""
    n = budget + 2
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def reordered(fp: np.ndarray, order: list[tuple[int, int]]) -> np.ndarray:
    """The bits of the named blocks in that order, from the highest bit down."""
    out, used = np.zeros(len(fp), np.uint64), 0
    for start, width in order:
        part = (fp >> np.uint64(64 - start - width)) & np.uint64((1 << width) - 1)
        used += width
        out |= part << np.uint64(64 - used)
    return out


def links(nodes: DataFrame, budget: int = 4) -> DataFrame:
    """``a, b, bits`` over ``nodes`` (``node, fp``; one node for each fingerprint).

    The graph of these rows has the same connected groups as the graph of all pairs within
    the budget, and holds a nearest partner of each node for each bucket.
    """
    return tied(nodes, budget).groupBy("a", "b").agg(F.min("bits").alias("bits"))


def tied(nodes: DataFrame, budget: int) -> DataFrame:
    """The rows of ``links``, some of them several times. With a column ``seed`` (one node for each
    of its fingerprints) all seeds are walked in one pass."""
    cut = blocks(budget)
    choices = list(combinations(range(len(cut)), 2))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, fp, node in whole_buckets(batches, ("bucket", "fp", "node")):
            a, b, bits = walked(bucket, fp, node, cut, choices, budget)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b), pa.array(bits)], ["a", "b", "bits"])

    return (dealt(nodes, cut, choices, [c for c in ("fp", "node", "seed") if c in nodes.columns])
            .mapInArrow(walk, "a bigint, b bigint, bits int"))


def dealt(nodes: DataFrame, cut: list, choices: list, columns: list[str]) -> DataFrame:
    """Rows (one column is ``fp``) in every bucket of theirs, whole buckets together.

    Values of different ``seed``, if there is such a column, never meet.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                part = batch.slice(at, 8192)
                fp = part.column("fp").to_numpy().view(np.uint64)
                seed = part.column("seed").to_numpy() if "seed" in columns else np.zeros(len(fp), np.int64)
                keys, n = [], len(choices)
                for c, (i, j) in enumerate(choices):
                    wide = cut[i][1] + cut[j][1]
                    top = reordered(fp, [cut[i], cut[j]]) >> np.uint64(64 - wide)
                    keys.append((seed * n + c) << 40 | top.astype(np.int64))
                again = pa.array(np.tile(np.arange(len(fp)), n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), *(part.column(c).take(again) for c in columns)],
                    ["bucket", *columns])

    kinds = ", ".join(f"{c} {nodes.schema[c].dataType.simpleString()}" for c in columns)
    return (nodes.select(*columns).mapInArrow(spread, f"bucket bigint, {kinds}")
            .repartition(partitions(nodes.sparkSession), "bucket").sortWithinPartitions("bucket"))


def apart(nodes: DataFrame, budget: int, least: float, leading: bool) -> DataFrame:
    """``a, b``: pairs within the budget whose labels differ and whose sizes allow the similarity.

    ``nodes`` has ``node, fp, seed, label, low, high, weight``: any number of nodes for a
    fingerprint, the range of a node's set sizes, and how much a node stands for others. A column
    ``parity`` (see ``parity``; null: unknown) leaves out pairs that cannot be similar. With
    ``leading`` only the heaviest partner of each node in each bucket comes out, else every pair.
    """
    cut = blocks(budget)
    choices = list(combinations(range(len(cut)), 2))
    columns = ["fp", "node", "seed", "label", "low", "high", "weight"]
    columns += ["parity"] if "parity" in nodes.columns else []

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_buckets(batches, ("bucket", *columns)):
            rest, roots, depth, order = laid_out(rows[0], rows[1], cut, choices, rows[4])
            bucket, fp, node, _, label, low, high, weight, *more = (x[order] for x in rows)
            parities = Parities(more[0]) if more else None
            heavy = np.full(len(node), -1)
            own = (bucket >> 40) % len(choices)
            rank = np.empty(len(node), np.int64)  # heaviest first, then the smallest node
            rank[np.lexsort((-node, weight))] = np.arange(len(node))
            by_rank = np.argsort(rank)
            for i, j, _ in close_pairs(rest, roots, depth, budget, label):
                some = ((label[i] != label[j]) & (high[i] >= least * low[j]) & (high[j] >= least * low[i]))
                i, j = i[some], j[some]
                if parities:
                    differ = parities.differ(i, j)
                    some = differ * (1 + least) <= (high[i] + high[j]) * (1 - least) + 1e-6
                    i, j = i[some], j[some]
                if leading:
                    np.maximum.at(heavy, i, rank[j])
                    np.maximum.at(heavy, j, rank[i])
                    continue
                once = first_choice(fp[i] ^ fp[j], cut, choices) == own[i]
                yield pair_batch(node[i[once]], node[j[once]])
            if leading:
                has = np.flatnonzero(heavy >= 0)
                yield pair_batch(node[has], node[by_rank[heavy[has]]])

    return dealt(nodes, cut, choices, columns).mapInArrow(walk, "a bigint, b bigint").distinct()


def parity(hashes: np.ndarray, most: int = 8192) -> bytes:
    """Of each class of hashes whether their number is odd, a bit each; about two classes a hash."""
    n = min(most, 1 << max(6, (2 * len(hashes) - 1).bit_length()))
    odd = np.bincount((hashes & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


class Parities:
    """Parities of many sets. The classes of a wider one are halves of those of a narrower one, so
    a pair is compared by the narrower one's, to which the other is folded."""

    def __init__(self, each: np.ndarray):
        each = [p or b"" for p in each]
        self.width = np.fromiter((len(p) // 8 for p in each), np.int64, len(each))
        self.start = np.cumsum(self.width) - self.width
        self.words = np.frombuffer(b"".join(each), "<u8")

    def differ(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """In how many parities the pairs differ; 0 where one is unknown."""
        out = np.zeros(len(i), np.int64)
        common = np.minimum(self.width[i], self.width[j])
        for width in np.unique(common[common > 0]).tolist():
            own = np.flatnonzero(common == width)
            for at in range(0, len(own), 4 * WALK // width):
                some = own[at:at + 4 * WALK // width]
                out[some] = np.bitwise_count(
                    self.folded(i[some], width) ^ self.folded(j[some], width)).sum(1)
        return out

    def folded(self, i: np.ndarray, width: int) -> np.ndarray:
        out = np.zeros((len(i), width), np.uint64)
        for at in range(0, int(self.width[i].max()), width):
            more = np.flatnonzero(self.width[i] > at)
            out[more] ^= self.words[(self.start[i[more]] + at)[:, None] + np.arange(width)]
        return out


def pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def first_choice(differ: np.ndarray, cut: list, choices: list) -> np.ndarray:
    """The first choice of blocks in which pairs with these differing bits agree."""
    differ = differ.view(np.uint64)
    agree = [(reordered(differ, [block]) == 0) for block in cut]
    out = np.full(len(differ), -1)
    for c in range(len(choices) - 1, -1, -1):
        i, j = choices[c]
        out[agree[i] & agree[j]] = c
    return out


def whole_buckets(batches: Iterator[pa.RecordBatch], columns: tuple) -> Iterator[tuple[np.ndarray, ...]]:
    """Gather batches and cut them where a bucket ends."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for batch in batches:
        held.append(tuple(batch.column(c).to_numpy(False) for c in columns))
        size += max(batch.num_rows, batch.nbytes // ROW_BYTES)
        if size >= ROWS:
            rows = tuple(np.concatenate(x) for x in zip(*held))
            last = int(np.searchsorted(rows[0], rows[0][-1]))
            if last:
                yield tuple(x[:last] for x in rows)
            held, size = [tuple(x[last:] for x in rows)], len(rows[0]) - last
    if size:
        yield tuple(np.concatenate(x) for x in zip(*held))


def walked(bucket: np.ndarray, fp: np.ndarray, node: np.ndarray, cut: list, choices: list,
           budget: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ties among the fingerprints of whole buckets."""
    rest, roots, depth, order = laid_out(bucket, fp, cut, choices)
    ties = Ties(len(node))
    for i, j, bits in close_pairs(rest, roots, depth, budget):
        ties.add(i, j, bits)
    return ties.rows(node[order])


def laid_out(bucket: np.ndarray, fp: np.ndarray, cut: list, choices: list,
             label: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
    """The tries of whole buckets: their sorted values, roots and depth, and the order of the rows."""
    rest = np.zeros(len(fp), np.uint64)
    depth = 0
    for c in np.unique(bucket >> 40).tolist():
        own = (bucket >> 40) == c
        left = [cut[k] for k in range(len(cut)) if k not in choices[c % len(choices)]]
        rest[own] = reordered(fp[own].view(np.uint64), left)
        depth = max(depth, sum(w for _, w in left))
    order = np.lexsort((rest, bucket) if label is None else (label, rest, bucket))
    bucket, rest = bucket[order], rest[order]
    starts = np.flatnonzero(np.concatenate([[True], np.diff(bucket) != 0]))
    ends = np.concatenate([starts[1:], [len(bucket)]])
    big = ends - starts > 1
    return rest, np.stack([starts[big], ends[big], starts[big], ends[big], np.zeros(big.sum(), np.int64)]), depth, order


def close_pairs(rest: np.ndarray, roots: np.ndarray, depth: int, budget: int,
                label: np.ndarray | None = None):
    """Index pairs within the budget. A pair of nodes is a column: two ranges and the bits so far.

    With labels, pairs of nodes under one and the same label are left out.
    """
    zeros: dict[int, np.ndarray] = {}
    if label is not None:
        run = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
    todo = [(0, roots)]
    while todo:
        level, pairs = todo.pop()
        if pairs.shape[1] > WALK:
            half = pairs.shape[1] // 2
            todo += [(level, pairs[:, :half]), (level, pairs[:, half:])]
            continue
        if label is not None:
            u0, u2, v0, v2, _ = pairs
            pairs = pairs[:, (run[u0] != run[u2 - 1]) | (run[v0] != run[v2 - 1]) | (label[u0] != label[v0])]
        size = (pairs[1] - pairs[0]) * (pairs[3] - pairs[2])
        done = (size <= SMALL) | (level >= depth if label is None else False)
        if done.any():
            yield from compared(rest, pairs[:4, done], budget)
        pairs = pairs[:, ~done]
        if not pairs.shape[1]:
            continue
        if level < depth and level not in zeros:
            bit = (rest >> np.uint64(63 - level)) & np.uint64(1)
            zeros[level] = np.concatenate([[0], np.cumsum(bit == 0)])
        u0, u2, v0, v2, bits = pairs
        if level < depth:
            z = zeros[level]
            u1, v1, more = u0 + z[u2] - z[u0], v0 + z[v2] - z[v0], bits + 1
        else:  # equal values, in the order of their labels
            u1, v1, more = (u0 + u2) // 2, (v0 + v2) // 2, bits
        same = u0 == v0  # a node with itself: its crossed children come once
        children = [np.stack([u0, u1, v0, v1, bits]), np.stack([u1, u2, v1, v2, bits]),
                    np.stack([u0, u1, v1, v2, more]), np.stack([u1, u2, v0, v1, more])[:, ~same]]
        children = np.concatenate(children, 1)
        alive = ((children[0] < children[1]) & (children[2] < children[3])
                 & (children[4] <= budget)
                 & ~((children[0] == children[2]) & (children[1] - children[0] == 1)))
        todo.append((level + 1, children[:, alive]))


def compared(rest: np.ndarray, pairs: np.ndarray, budget: int):
    """All leaves of one side with all of the other, each pair once, in bounded portions."""
    n = (pairs[1] - pairs[0]) * (pairs[3] - pairs[2])
    stops = np.cumsum(n)
    at = 0
    while at < len(n):
        upto = max(at + 1, int(np.searchsorted(stops, (stops[at - 1] if at else 0) + 4 * WALK, "right")))
        some, k = pairs[:, at:upto], n[at:upto]
        which = np.repeat(np.arange(len(k)), k)
        inner = np.arange(len(which)) - np.repeat(np.cumsum(k) - k, k)
        wide = (some[3] - some[2])[which]
        i, j = some[0][which] + inner // wide, some[2][which] + inner % wide
        once = (some[0] != some[2])[which] | (i < j)
        i, j = i[once], j[once]
        bits = np.bitwise_count(rest[i] ^ rest[j]).astype(np.int32)
        near = bits <= budget
        yield i[near], j[near], bits[near]
        at = upto


class Ties:
    """Groups and nearest partners of indices, fed with linked pairs in any order."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.near = np.full(n, np.iinfo(np.int64).max)

    def add(self, i: np.ndarray, j: np.ndarray, bits: np.ndarray) -> None:
        if not len(i):
            return
        rank = bits.astype(np.int64) << 40
        np.minimum.at(self.near, i, rank | j)
        np.minimum.at(self.near, j, rank | i)
        while True:
            a, b = self.root[i], self.root[j]
            low, high = np.minimum(a, b), np.maximum(a, b)
            if (low == high).all():
                return
            np.minimum.at(self.root, high, low)
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up

    def rows(self, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ties (smaller node first): to the group's first index, and to the nearest partner."""
        mine = np.flatnonzero(self.root != np.arange(len(node)))
        has = np.flatnonzero(self.near != np.iinfo(np.int64).max)
        near = self.near[has]
        a = np.concatenate([node[mine], node[has]])
        b = np.concatenate([node[self.root[mine]], node[near & ((1 << 40) - 1)]])
        bits = np.concatenate([np.full(len(mine), 64), near >> 40]).astype(np.int32)
        return np.minimum(a, b), np.maximum(a, b), bits
