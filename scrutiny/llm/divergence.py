"""Source divergence audit: how far the word use of each source is from the others' and from
its language's, over a K-squared tree of the group-term count matrix.

Counts. Shards of texts count terms for each language and source and hand blocks of terms (by
hash) to tasks, one compressed table each; a block adds its tables up and keeps the terms in
enough documents. Sources of a language are dealt into tiles of bounded size.

Trees. For each block of terms and each tile, the count matrix (sources by terms) is a
K-squared tree. The trees of two tiles of the same block are walked together for all pairs of
their sources: a pair of all-zero quadrants costs one multiplication whatever its size,
because where both counts are zero the figure is the same for all terms; the other leaves are
computed one by one. All arithmetic is in whole numbers.

Defined results: null text, language and source are the empty string; rows without an
identifier and repeated rows count like any other; a group without terms has count 0 for
every kept term; a language without kept terms has pairs of value 0; ties in value are ranked
by the item's bytes; texts of any length are read whole; an empty table gives no row; columns
other than text, language and source are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scrutiny.llm import automata, k2tree
from scrutiny.llm.automata import Layers, grown
from scrutiny.llm.blobs import packed, unpacked
from scrutiny.llm.common import give_back, stored, text_slices, top_rows
from scrutiny.llm.encoding import slots
from scrutiny.llm.words import GAP, WORD, cut, numbered

KINDS = np.full(256, GAP, np.uint8)
KINDS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = WORD
SHARD_BYTES = 6 << 20
BLOCK_BYTES = 8 << 20  # of text behind a block of terms
TILE = 64  # sources of a language in one tile, about
SCALE = 10**9


def audit(docs: DataFrame, min_docs: int = 3, smooth: int = 1, top: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank``: all other sources of the language (``pair``)
    and the ``top`` terms a source uses more than its language (``term``)."""
    rows = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    groups = stored(rows.select("lang", "source").distinct(), "divergence-groups")
    size = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    most = groups.groupBy("lang").count().agg(F.max("count").alias("n")).first()["n"] or 1
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    n_tiles = math.ceil(most / TILE)

    shards = rows.mapInArrow(_shards(blocks), "block int, blob binary")
    counts = stored(shards.groupBy("block").applyInArrow(
        _counted(min_docs, n_tiles), "kind string, lang string, block int, tile int, source string, n bigint, blob binary"),
        "divergence-counts")
    tiles, totals = _tiles(groups, counts, n_tiles)
    terms = counts.where("kind = 'terms'").select("lang", "block", "n", F.col("blob").alias("terms"))
    cells = counts.where("kind = 'cells'").select("lang", "block", "tile", F.col("blob").alias("cells"))
    framed = stored(terms.join(tiles, "lang").join(cells, ["lang", "block", "tile"], "left"),
                    "divergence-tiles")

    values = "lang string, source string, item string, value bigint"
    term = top_rows(framed.where("cells IS NOT NULL").mapInArrow(_terms(smooth, top), values),
                    ["lang", "source"], [F.desc("value"), F.asc("item")], top)
    left = framed.drop("terms")
    right = left.select("lang", "block", *(F.col(c).alias(f"{c}_b") for c in ("tile", "members", "cells")))
    summed = (left.join(right, ["lang", "block"]).mapInArrow(_pairs(smooth), values)
              .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    other = totals.select("lang", F.col("source").alias("item"))
    pair = (totals.select("lang", "source").join(other, "lang").where("source <> item")
            .join(summed, ["lang", "source", "item"], "left")
            .withColumn("value", F.coalesce("value", F.lit(0)))
            .withColumn("rank", F.row_number().over(
                Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))))
    names = ["lang", "source", "part", "item", "value", "rank"]
    return (pair.withColumn("part", F.lit("pair")).select(*names)
            .unionByName(term.withColumn("part", F.lit("term")).select(*names)))


def _shards(blocks: int):
    """Tables of language, term (documents) and source (occurrences), by block of terms."""

    def made(words, langs, sources, row) -> Iterator[pa.RecordBatch]:
        codes, table = numbered([*words, *langs, *sources])
        n, n_rows = sum(map(len, words)), sum(map(len, langs))
        word, lang, source = np.split(codes, [n, n + n_rows])
        size = len(table)
        seen, times = np.unique(np.concatenate(row) * size + word, return_counts=True)
        row, word = seen // size, seen % size  # a term once for each document
        langs_, _, _, at_lang = grown(lang[row], np.zeros(len(row), np.int64), size)
        term, up, docs, at_term = grown(word, at_lang, size)
        src, up_src, count, _ = grown(source[row], at_term, size, times)
        salt = np.array([zlib.crc32(w) for w in table.to_pylist()], np.int64)
        block = (salt[term] * 31 + salt[langs_[up]]) % blocks
        order = np.argsort(block, kind="stable")
        ends = np.searchsorted(block[order], np.arange(blocks + 1))
        first = np.searchsorted(up_src, np.arange(len(term) + 1))
        out = []
        for b in range(blocks):
            nodes = order[ends[b]:ends[b + 1]]
            if not len(nodes):
                continue
            own, parent = np.unique(up[nodes], return_inverse=True)
            n_src = first[nodes + 1] - first[nodes]
            entries = slots(first[nodes], n_src)
            part = automata._trimmed(
                table, [langs_[own], term[nodes], src[entries]],
                [np.zeros(len(own), np.int64), parent, np.repeat(np.arange(len(nodes)), n_src)],
                [np.zeros(len(own), np.int64), docs[nodes], count[entries]])
            out.append((b, _written(part)))
        columns = list(zip(*out)) if out else [[], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary())], ["block", "blob"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, langs, sources, row = [], [], [], []
        n_rows = held = 0
        for batch in text_slices(batches, "text"):
            own = cut(batch.column("text"), KINDS)
            words += own.words
            langs.append(batch.column("lang").cast(pa.binary()))
            sources.append(batch.column("source").cast(pa.binary()))
            row.append(own.row + n_rows)
            n_rows += batch.num_rows
            held += pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
            if held >= SHARD_BYTES:
                yield from made(words, langs, sources, row)
                words, langs, sources, row = [], [], [], []
                n_rows = held = 0
                give_back()
        if n_rows:
            yield from made(words, langs, sources, row)
            give_back()

    return build


def _written(layers: Layers) -> bytes:
    return packed([*layers.label, *layers.parent, *layers.weight], layers.words)


def _read(blob: bytes) -> Layers:
    arrays, words = unpacked(blob)
    return Layers(words, arrays[:3], arrays[3:6], arrays[6:])


def _counted(min_docs: int, n_tiles: int):
    """A block's kept terms and their counts: a row of terms for each language, a row of cells
    for each tile of its sources, and what each source adds to its total."""

    def count(group: pa.Table) -> pa.Table:
        block = group.column("block")[0].as_py()
        whole = automata.union([_read(b) for b in group.column("blob").to_pylist()])
        kept = whole.weight[1] >= min_docs
        whole = automata.chosen(whole, [np.zeros(len(whole.label[0]), bool), kept,
                                        kept[whole.parent[2]]])
        spelled = whole.words.to_pylist()
        tile_of = np.array([zlib.crc32(w) % n_tiles for w in spelled], np.int64)
        terms_of, cells_of = whole.children(0), whole.children(1)
        out = []
        for k, code in enumerate(whole.label[0].tolist()):
            lang = spelled[code].decode()
            a, b = terms_of[k], terms_of[k + 1]
            i, j = cells_of[a], cells_of[b]
            term, src, n = whole.parent[2][i:j] - a, whole.label[2][i:j], whole.weight[2][i:j]
            totals = np.zeros(b - a, np.int64)
            np.add.at(totals, term, n)
            out.append(("terms", lang, block, None, None, int(b - a),
                        packed([totals], whole.words.take(pa.array(whole.label[1][a:b])))))
            own, at = np.unique(src, return_inverse=True)
            sums = np.zeros(len(own), np.int64)
            np.add.at(sums, at, n)
            for s, m in zip(own.tolist(), sums.tolist()):
                out.append(("total", lang, block, None, spelled[s].decode(), m, None))
            for t in np.unique(tile_of[own]).tolist():
                here = tile_of[src] == t
                names, number = np.unique(src[here], return_inverse=True)
                out.append(("cells", lang, block, t, None, int(here.sum()), packed(
                    [number, term[here], n[here]], whole.words.take(pa.array(names)))))
        columns = list(zip(*out)) if out else [[]] * 7
        types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)],
                        ["kind", "lang", "block", "tile", "source", "n", "blob"])

    return count


def _tiles(groups: DataFrame, counts: DataFrame, n_tiles: int) -> tuple[DataFrame, DataFrame]:
    """The members of each tile with their totals, by source; and all groups."""
    own = counts.where("kind = 'total'").groupBy("lang", "source").agg(F.sum("n").alias("total"))
    totals = (groups.join(own, ["lang", "source"], "left")
              .withColumn("total", F.coalesce("total", F.lit(0)))
              .withColumn("tile", F.pmod(F.crc32(F.col("source").cast("binary")), F.lit(n_tiles)).cast("int")))
    size = counts.where("kind = 'terms'").groupBy("lang").agg(F.sum("n").alias("n_kept"))
    whole = totals.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    tiles = (totals.groupBy("lang", "tile")
             .agg(F.sort_array(F.collect_list(F.struct("source", "total"))).alias("members"))
             .join(size, "lang").join(whole, "lang"))
    return tiles, totals


def shares(count: np.ndarray, total: np.ndarray, smooth: int) -> np.ndarray:
    """``1 + floor(10^9 * (count + smooth) / total)`` without leaving 64 bits: a digit group of
    three at a time."""
    out, rest = np.divmod(count + smooth, total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digits
    return out + 1


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _members(row: dict, side: str = "") -> tuple[list[str], np.ndarray]:
    members = row["members" + side]
    return [m["source"] for m in members], np.array([m["total"] for m in members], np.int64)


def _cells(blob: bytes | None, names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and count of the cells of a tile."""
    if blob is None:
        return (np.zeros(0, np.int64),) * 3
    (number, term, n), words = unpacked(blob)
    place = {name: k for k, name in enumerate(names)}
    row = np.array([place[w.decode()] for w in words.to_pylist()], np.int64)
    return row[number], term, n


def _values(rows: list[tuple[str, list, list, np.ndarray]]) -> pa.RecordBatch:
    lang = [name for name, items, _, _ in rows for _ in items]
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.string()), pa.array([s for r in rows for s in r[1]], pa.string()),
         pa.array([s for r in rows for s in r[2]], pa.string()),
         pa.array(np.concatenate([np.zeros(0, np.int64), *(r[3] for r in rows)]), pa.int64())],
        ["lang", "source", "item", "value"])


def _single_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _terms(smooth: int, top: int):
    """Terms that a source uses more than its language: the ``top`` of one block and tile."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _single_rows(batches):
            names, total = _members(r)
            row, column, n = _cells(r["cells"], names)
            (of_lang,), words = unpacked(r["terms"])
            p = shares(n, (total + smooth * r["n_kept"])[row], smooth)
            q = shares(of_lang, np.int64(r["lang_total"] + smooth * r["n_kept"]), smooth)[column]
            more = np.flatnonzero(p > q)
            value = gaps(p[more], q[more])
            order = np.lexsort((column[more], -value, row[more]))  # columns are in byte order
            more, value = more[order], value[order]
            first = np.searchsorted(row[more], row[more])
            best = np.arange(len(more)) - first < top
            more, value = more[best], value[best]
            item = words.take(pa.array(column[more])).cast(pa.string()).to_pylist()
            yield _values([(r["lang"], [names[k] for k in row[more].tolist()], item,
                            value)])

    return compute


def _pairs(smooth: int):
    """Sums over the terms of one block for all pairs of sources of two tiles."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _single_rows(batches):
            sides = []
            height = max(k2tree.side_height(len(r["members" + s])) for s in ("", "_b"))
            for s in ("", "_b"):
                names, total = _members(r, s)
                size = total + smooth * r["n_kept"]
                row, column, n = _cells(r["cells" + s], names)
                tree = k2tree.grow(row, column, shares(n, size[row], smooth), r["n"], height)
                sides.append((names, tree, shares(np.zeros(len(names), np.int64), size, smooth)))
            (names_a, a, zero_a), (names_b, b, zero_b) = sides
            out = np.zeros((len(names_a), len(names_b)), np.int64)
            empty = np.zeros_like(out)
            for now in k2tree.joint(a, b, len(names_a), len(names_b), empty):
                p = np.where(now.a >= 0, np.append(a.value, 0)[now.a], zero_a[now.row_a])
                q = np.where(now.b >= 0, np.append(b.value, 0)[now.b], zero_b[now.row_b])
                np.add.at(out, (now.row_a, now.row_b), gaps(p, q))
            out += empty * gaps(zero_a[:, None], zero_b[None, :])
            i, j = np.nonzero(np.array(names_a)[:, None] != np.array(names_b)[None, :])
            yield _values([(r["lang"], [names_a[k] for k in i.tolist()],
                            [names_b[k] for k in j.tolist()], out[i, j])])

    return compute
