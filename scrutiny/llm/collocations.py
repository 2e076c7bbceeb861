"""Phrase collocations from weighted acyclic automata.

Every shard of texts (a bounded number of bytes) sorts its sequences of one to three words,
below their language, and builds an acyclic count transducer for each of the sampled prefix
ranges, one after the other in sorted order. Where there are many ranges it builds one for each
group of neighbouring ranges; bundles of these are united and divided further, round by round.
So a transducer is never cut into more than ``FAN_OUT`` pieces, and work and pieces follow the
text, not the number of shards times that of ranges. A range's transducers are united and their
weights summed in one task; what no candidate can use (weight under ``least``) is left out.
The little that is left is held by fewer, wider ranges of about equal size.
The parts of candidates are looked up by composition: a range sends acceptors of the parts to
the ranges that hold them, which answer with the same automaton weighted by counts. The
acceptors carry the weights of longer candidates, so a range learns which of its phrases are
covered. Only automata travel, never single occurrences.

Defined results: a null text is empty, a null language ``und``; rows without an identifier
and repeated rows count like any other; texts of any length are read whole (cut at separators
inside a task); ties are settled by the phrase's bytes; an empty table gives no row; columns
other than the text and the language are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutiny.llm import automata
from scrutiny.llm.automata import Layers
from scrutiny.llm.common import give_back, partitions, stored, text_slices, top_rows
from scrutiny.llm.words import cut, kinds, numbered

KINDS = kinds(gap=b" \t", stop=b".,;:!?\n\v\f\r")
#: Text bytes behind one automaton of a shard, behind a bundle; and behind one range, at least.
SHARD_BYTES = BUNDLE_BYTES = 6 << 20
RANGE_BYTES = 8 << 20
#: Documents looked at for the splitters, for each range; every so many-th sequence is a sample.
SAMPLE_DOCS, SAMPLE_STEP = 60, 64
#: Pieces that one transducer is divided into, at most.
FAN_OUT = 128
#: Bytes of finished counts (folded) behind one range of the lookups; and ranges of a small table.
PART_BYTES, FEWEST = 512 << 10, 32
#: Candidates scored at once.
SCORED = 1 << 15
#: Steps of a sequence of pairs of numbers that fills 0 to 1 without gaps or heaps.
EVEN = 0.7548776662466927, 0.5698402909980532
DEPTH = 4  # the language and up to three words
PIECES = "to int, bundle int, blob binary"
BLOBS = "to int, source int, kind string, blob binary"


def mine(docs: DataFrame, least: int = 10, covered: int = 50, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best phrases of two or three words.

    ``least``: occurrences of a candidate; ``covered``: share (per cent) of a phrase's
    occurrences inside a longer candidate from which on it is dropped.
    """
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    ranges = max(partitions(docs.sparkSession), math.ceil((size["b"] or 0) / RANGE_BYTES))
    splitters = _splitters(rows, ranges, size["n"])
    steps = _steps(len(splitters) + 1)
    bundles = [math.ceil((size["b"] or 0) * step / ((len(splitters) + 1) * BUNDLE_BYTES)) or 1
               for step in steps]
    pieces = rows.mapInArrow(_shards(splitters[steps[0] - 1::steps[0]], bundles[0]), PIECES)
    for k, step in enumerate(steps[1:], 1):
        pieces = pieces.groupBy("to", "bundle").applyInArrow(
            _divided(splitters[step - 1::step], steps[k - 1] // step, bundles[k - 1:k + 1]), PIECES)
    counts = stored(pieces.groupBy("to").applyInArrow(_united(least), "to int, blob binary"),
                    "phrase-counts")
    starts = _wider(counts, partitions(docs.sparkSession))
    wide = counts.mapInArrow(_renumbered(starts), "to int, blob binary")
    asked = wide.groupBy("to").applyInArrow(
        _asked([splitters[k - 1] for k in starts[1:]]), BLOBS)
    answers = stored(asked.groupBy("to").applyInArrow(_composed(covered), BLOBS), "phrase-parts")
    found = answers.groupBy("to").applyInArrow(
        _scored, "lang string, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")
    best = top_rows(found, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _layers(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[Layers]:
    """Counts of shards of about ``limit`` bytes of text."""
    words, langs, row, piece = [], [], [], []
    n_rows = n_pieces = held = 0

    def made() -> Layers:
        codes, table = numbered([*words, *langs])
        n = sum(map(len, words))
        return automata.counted(codes[n:][np.concatenate(row)], codes[:n], np.concatenate(piece),
                                table)

    for batch in text_slices(batches, "text"):
        own = cut(batch.column("text"), KINDS)
        words += own.words
        langs.append(batch.column("lang").cast(pa.binary()))
        row.append(own.row + n_rows)
        piece.append(own.piece + n_pieces)
        n_rows += batch.num_rows
        n_pieces += int(own.piece[-1]) + 1 if len(own.piece) else 0
        held += pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
        if held >= limit:
            whole = made()
            words, langs, row, piece = [], [], [], []
            n_rows = n_pieces = held = 0
            yield whole
            del whole
            give_back()
    if n_rows:
        yield made()


def _steps(ranges: int) -> list[int]:
    """How many ranges a piece holds after each round: as few rounds as keep to ``FAN_OUT``,
    dividing alike; 1 at the end."""
    rounds = 1
    while FAN_OUT ** rounds < ranges:
        rounds += 1
    width = 1
    while width ** rounds < ranges:
        width += 1
    return [width ** k for k in range(rounds - 1, -1, -1)]


def _shards(splitters: list[tuple[bytes, ...]], bundles: int):
    """The pieces of shards, those of a shard in the same bundle; shards are dealt out evenly."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for layers in _layers(batches, SHARD_BYTES):
            bundle = int((task * EVEN[0] + n * EVEN[1]) % 1 * bundles)
            yield _rows([(to, bundle, automata.folded(part))
                         for to, part in _pieces(layers, splitters)], ["to", "bundle", "blob"])
            n += 1
            del layers
            give_back()

    return build


def _divided(splitters: list[tuple[bytes, ...]], width: int, bundles: list[int]):
    """A bundle of a group's transducers as one, in pieces for the ``width`` parts of the group.
    There were and will be so many bundles of each group and part."""

    def divide(group: pa.Table) -> pa.Table:
        to, bundle = (group.column(c)[0].as_py() for c in ("to", "bundle"))
        whole = automata.union([automata.unfolded(b) for b in group.column("blob").to_pylist()])
        inner = splitters[to * width:(to + 1) * width - 1]
        out = [(to * width + k, bundle * bundles[1] // bundles[0], automata.folded(part))
               for k, part in _pieces(whole, inner)]
        del whole
        give_back()
        return pa.Table.from_batches([_rows(out, ["to", "bundle", "blob"])])

    return divide


def _pieces(layers: Layers, splitters: list[tuple[bytes, ...]]) -> Iterator[tuple[int, Layers]]:
    """The non-empty ranges of a transducer, in order."""
    at = automata.cuts(layers, splitters)
    for k in range(len(splitters) + 1):
        low, high = [a[k] for a in at], [a[k + 1] for a in at]
        if any(a < b for a, b in zip(low, high)):
            yield k, automata.piece(layers, low, high)


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds_of = {"to": pa.int32(), "bundle": pa.int32(), "source": pa.int32(), "kind": pa.string(),
                "blob": pa.binary()}
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds_of[n]) for c, n in zip(columns, names)], names)


def _splitters(rows: DataFrame, ranges: int, n_docs: int) -> list[tuple[bytes, ...]]:
    """Sequences that divide the shards' sequences evenly, from a sample of documents.

    They only balance the work. Spark ranges the sample; one row a range reaches the driver.
    """
    if ranges < 2 or not n_docs:
        return []

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for layers in _layers(batches, SHARD_BYTES):
            keys = []
            for d in range(1, DEPTH):
                nodes = np.arange(SAMPLE_STEP // 2, len(layers.label[d]), SAMPLE_STEP)
                columns = [layers.words.take(pa.array(c)).to_pylist()
                           for c in automata.sequence(layers, d, nodes)]
                keys += zip(*columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array([list(k) for k in keys], pa.list_(pa.binary()))], ["key"])

    share = min(1.0, SAMPLE_DOCS * ranges / n_docs)
    some = rows.sample(share, seed=7) if share < 1 else rows
    keys = some.mapInArrow(sampled, "key array<binary>").repartitionByRange(ranges, "key")
    least = keys.groupBy(F.spark_partition_id()).agg(F.min("key").alias("key")).collect()
    found = sorted({tuple(bytes(w) for w in r["key"]) for r in least})
    return found[1:]


def _united(least: int):
    """A range's transducer, without what no candidate can use."""

    def unite(group: pa.Table) -> pa.Table:
        to = group.column("to")[0].as_py()
        whole = automata.union([automata.unfolded(b) for b in group.column("blob").to_pylist()])
        keep = [whole.weight[0] > 0] + [w >= least for w in whole.weight[1:]]
        out = automata.folded(automata.chosen(whole, keep))
        del whole
        give_back()
        return pa.Table.from_batches([_rows([(to, out)], ["to", "blob"])])

    return unite


def _wider(counts: DataFrame, fewest: int) -> list[int]:
    """The first range of each wider one. One small row a range reaches the driver."""
    sizes = sorted(tuple(r) for r in counts.select("to", F.octet_length("blob")).collect())
    whole = sum(n for _, n in sizes)
    parts = max(math.ceil(whole / PART_BYTES), min(fewest, FEWEST))
    starts, last, before = [0], 0, 0
    for to, n in sizes:
        part = (2 * before + n) * parts // (2 * whole)
        if part > last and before:
            starts.append(to)
            last = part
        before += n
    return starts


def _renumbered(starts: list[int]):
    def renumber(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to = np.searchsorted(starts, batch.column("to").to_numpy(), "right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(to, pa.int32()), batch.column("blob")], ["to", "blob"])

    return renumber


def _asked(splitters: list[tuple[bytes, ...]]):
    """A wider range's transducer, and acceptors of the parts of its candidates for all ranges."""

    def ask(group: pa.Table) -> pa.Table:
        to = group.column("to")[0].as_py()
        whole = automata.union([automata.unfolded(b) for b in group.column("blob").to_pylist()])
        out = [(to, to, "counts", automata.folded(whole))]
        for target, part in _pieces(_parts(whole), splitters):
            out.append((target, to, "parts", automata.folded(part)))
        del whole
        give_back()
        return pa.Table.from_batches([_rows(out, ["to", "source", "kind", "blob"])])

    return ask


def _candidates(layers: Layers, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    nodes = np.flatnonzero(layers.weight[depth] > 0)
    return nodes, automata.sequence(layers, depth, nodes)


def _parts(layers: Layers) -> Layers:
    """All parts that the candidates are cut into; parts of three words' weight on the twos."""
    _, (lang2, a2, b2) = _candidates(layers, 2)
    three, (lang3, a3, b3, c3) = _candidates(layers, 3)
    weight = layers.weight[3][three]
    return automata.of_rows(
        [((lang2, a2), None), ((lang2, b2), None), ((lang3, a3), None), ((lang3, c3), None),
         ((lang3, a3, b3), weight), ((lang3, b3, c3), weight)], layers.words, DEPTH)


def _composed(covered: int):
    """Answers to all acceptors, and the range's own candidates without covered ones."""

    def compose(group: pa.Table) -> pa.Table:
        to = group.column("to")[0].as_py()
        rows = list(zip(*(group.column(c).to_pylist() for c in ("source", "kind", "blob"))))
        own = [automata.unfolded(b) for _, kind, b in rows if kind == "counts"]
        counts = own[0] if own else None
        out = []
        longer = np.zeros(len(counts.label[2]) + 1 if own else 1, np.int64)
        for sources, blobs in _together([(s, b) for s, kind, b in rows if kind == "parts"]):
            if counts is None:
                break
            asked = [automata.unfolded(b) for b in blobs]
            every = automata.stacked(asked)
            nodes = automata.looked_up(counts, every)
            np.maximum.at(longer, nodes[2], every.weight[2])  # -1 is the spare place at the end
            found = every._replace(weight=[automata.weights_at(counts, d, n)
                                           for d, n in enumerate(nodes)])
            for source, one, weight in zip(sources, asked, automata.apart(found, asked)):
                out.append((source, to, "answer", automata.folded(one._replace(weight=weight))))
        if counts is not None:
            gone = (longer[:-1] > 0) & (100 * longer[:-1] >= covered * counts.weight[2])
            weight = list(counts.weight)
            weight[2] = np.where(gone, 0, weight[2])
            out.append((to, to, "counts", automata.folded(counts._replace(weight=weight))))
        return pa.Table.from_batches([_rows(out, ["to", "source", "kind", "blob"])])

    return compose


def _together(rows: list[tuple[int, bytes]]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Acceptors that are looked up at once: about ``PART_BYTES``, or one larger."""
    start = held = 0
    for i, (_, blob) in enumerate(rows):
        if i > start and held + len(blob) > PART_BYTES:
            yield tuple(map(list, zip(*rows[start:i])))
            start, held = i, 0
        held += len(blob)
    if rows[start:]:
        yield tuple(map(list, zip(*rows[start:])))


def _scored(group: pa.Table) -> pa.Table:
    """Candidates of a range with their parts and scores, in exact arithmetic."""
    kinds_of, blobs = (group.column(c).to_pylist() for c in ("kind", "blob"))
    counts = [automata.unfolded(b) for k, b in zip(kinds_of, blobs) if k == "counts"]
    answers = [automata.unfolded(b) for k, b in zip(kinds_of, blobs) if k == "answer"]
    out: list[pa.Table] = [_phrases([])]
    if counts and answers:
        layers, known = counts[0], automata.union(answers)
        code = automata.translated(layers.words, known.words)

        def parts(*columns: np.ndarray) -> list[int]:
            nodes = automata.found(known, [code[c] for c in columns])
            return automata.weights_at(known, len(columns) - 1, nodes).tolist()

        for depth in (2, 3):
            nodes, columns = _candidates(layers, depth)
            for start in range(0, len(nodes), SCORED):
                lang, *words = (c[start:start + SCORED] for c in columns)
                weight = layers.weight[depth][nodes[start:start + SCORED]].tolist()
                spelled = [layers.words.take(pa.array(c)).to_pylist() for c in (lang, *words)]
                pairs = [(parts(lang, *words[:k]), parts(lang, *words[k:]))
                         for k in range(1, depth)]
                rows = []
                for i, (a, n) in enumerate(zip(weight, _totals(known, code[lang]))):
                    score, k = min((1_000_000 * a * a // (l[i] * r[i]), k)
                                   for k, (l, r) in enumerate(pairs))
                    rows.append((spelled[0][i], b" ".join(w[i] for w in spelled[1:]), a,
                                 pairs[k][0][i], pairs[k][1][i], n, score))
                out.append(_phrases(rows))
    return pa.concat_tables(out)


def _phrases(rows: list[tuple]) -> pa.Table:
    names = ("lang", "phrase", "a", "l", "r", "n", "score")
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.table({n: pa.array(c, pa.binary()).cast(pa.string()) if n in ("lang", "phrase")
                     else pa.array(c, pa.int64()) for n, c in zip(names, columns)})


def _totals(known: Layers, lang: np.ndarray) -> list[int]:
    return automata.weights_at(known, 0, automata.found(known, [lang])).tolist()
