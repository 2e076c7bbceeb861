"""Count transducers and phrases, K-squared trees and divergence, piecewise hashes."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scrutiny.llm import automata, collocations, divergence, fuzzy_hash, k2tree, quality_rules
from scrutiny.llm.common import top_rows
from scrutiny.llm.words import cut, kinds, numbered
from tests.llm.conftest import EXTRA, awkward_rows

WORD = st.sampled_from(["a", "b", "c", "é", "the", "\x00", "zz"])
PIECES = st.lists(st.lists(WORD, min_size=1, max_size=6), max_size=6)


def low(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# --- transducers ---------------------------------------------------------------


def transducer(pieces: list[list[str]]) -> automata.Layers:
    flat = [w.encode() for p in pieces for w in p]
    codes, table = numbered([pa.array(flat, pa.binary()), pa.array([b"xx"] * len(flat), pa.binary())])
    piece = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
    return automata.counted(codes[len(flat):], codes[:len(flat)], piece, table)


def counts(pieces: list[list[str]]) -> Counter:
    out: Counter = Counter()
    for p in pieces:
        for i in range(len(p)):
            out[("xx",)] += 1
            for n in (1, 2, 3):
                if i + n <= len(p):
                    out[("xx", *p[i:i + n])] += 1
    return out


def spelled(layers: automata.Layers) -> Counter:
    words = [w.decode() for w in layers.words.to_pylist()]
    out: Counter = Counter()
    for d in range(len(layers.label)):
        nodes = np.arange(len(layers.label[d]))
        for *s, n in zip(*automata.sequence(layers, d, nodes), layers.weight[d].tolist()):
            if n:
                out[tuple(words[k] for k in s)] += n
    return out


@settings(max_examples=60, deadline=None)
@given(parts=st.lists(PIECES.filter(bool), min_size=1, max_size=3))
def test_transducers_count_unite_and_fold(parts):
    made = [transducer(p) for p in parts]
    for layers, p in zip(made, parts):
        assert spelled(layers) == counts(p)
        assert spelled(automata.unfolded(automata.folded(layers))) == counts(p)
    whole = automata.union(made)
    assert spelled(whole) == sum((counts(p) for p in parts), Counter())
    order = [tuple(s) for s in zip(*automata.sequence(whole, 3, np.arange(len(whole.label[3]))))]
    assert order == sorted(order)


@settings(max_examples=60, deadline=None)
@given(pieces=PIECES.filter(bool), cut_at=st.lists(
    st.lists(st.sampled_from([b"", b"xx", b"a", b"b", b"bb", b"the", b"zz", b"zzz"]), min_size=1, max_size=5)
    .map(tuple), max_size=4))
def test_ranges_divide_sequences(pieces, cut_at):
    layers, splitters = transducer(pieces), sorted(set(cut_at))
    at = automata.cuts(layers, splitters)
    found: Counter = Counter()
    for k in range(len(splitters) + 1):
        part = automata.piece(layers, [a[k] for a in at], [a[k + 1] for a in at])
        own = spelled(automata.unfolded(automata.folded(part)))
        for s in own:
            key = tuple(w.encode() for w in s)
            assert (k == 0 or splitters[k - 1] <= key) and (k == len(splitters) or key < splitters[k])
        found += own
    assert found == counts(pieces)


@settings(max_examples=40, deadline=None)
@given(pieces=PIECES.filter(bool), asked=PIECES.filter(bool))
def test_composition_answers_with_counts(pieces, asked):
    layers, queries = transducer(pieces), transducer(asked)
    nodes = automata.looked_up(layers, queries)
    answer = queries._replace(weight=[automata.weights_at(layers, d, n) for d, n in enumerate(nodes)])
    want = counts(pieces)
    assert spelled(answer) == Counter({s: want[s] for s in counts(asked) if want[s]})


def test_equal_states_are_one_state():
    same = transducer([["a", "x"], ["b", "x"], ["c", "x"], ["d", "y"]])
    from scrutiny.llm.blobs import unpacked

    tables, _ = unpacked(automata.folded(same))
    first_words = tables[2 + 4]  # weights of the states behind one word
    assert len(same.label[1]) == 6 and len(first_words) == 4  # a, b and c lead to the same


def test_words_of_blocks_and_rows(monkeypatch):
    from scrutiny.llm import words

    monkeypatch.setattr(words, "BLOCK", 7)
    texts = ["Aé b.c", None, "", "  x" * 40, "y" * 50 + " z", ".", "a.b"]
    got = cut(pa.array(texts, pa.string()), kinds(b" \t", b"."))
    spelled_ = [w.decode() for part in got.words for w in part.to_pylist()]
    want = [(i, k, w) for i, t in enumerate(texts) for k, p in enumerate((t or "").split("."))
            for w in low(p).split()]
    assert [(int(i), w) for i, w in zip(got.row, spelled_)] == [(i, w) for i, _, w in want]
    keys = [(i, k) for i, k, _ in want]
    assert [a == b for a, b in zip(got.piece, got.piece[1:])] == [a == b for a, b in zip(keys, keys[1:])]


# --- phrases -------------------------------------------------------------------


def phrases(rows, least, covered, top):
    f: dict = defaultdict(Counter)
    n: Counter = Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for p in re.split(r"[.,;:!?\x0A-\x0D]", low(text or "")):
            w = re.findall(r"[^\x20\x09]+", p)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        found = []
        for s, a in c.items():
            if len(s) < 2 or a < least:
                continue
            if len(s) == 2 and any(len(x) == 3 and m >= least and s in (x[:2], x[1:])
                                   and 100 * m >= covered * a for x, m in c.items() if m >= least):
                continue
            score, k = min((10**6 * a * a // (c[s[:k]] * c[s[k:]]), k) for k in range(1, len(s)))
            found.append((-score, -a, " ".join(s).encode(), c[s[:k]], c[s[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("range_bytes", [1 << 30, 40_000])
def test_phrases_equal_brute_force(awkward, monkeypatch, range_bytes):
    monkeypatch.setattr(collocations, "RANGE_BYTES", range_bytes)
    got = collocations.mine(awkward, least=3, covered=50, top=300)
    assert sorted(map(tuple, got.collect())) == phrases(awkward_rows(), 3, 50, 300)


@pytest.mark.parametrize("fan_out, rounds", [(1000, 1), (8, 2), (4, 3)])
def test_pieces_follow_the_text_not_the_number_of_ranges(spark, make_docs, monkeypatch, fan_out, rounds):
    rows = [(i, " ".join(f"w{(i * i + j * j) % 23} v{j % 7} u{(i + j) % 5}{'.' * (j % 11 == 0)}" for j in range(90)),
             ("en", "fr", None)[i % 3], "s") for i in range(120)]
    sent, kept, own_shards = spark.sparkContext.accumulator(0), {}, collocations._shards

    def shards(*args):
        build = own_shards(*args)

        def counted(batches):
            for batch in build(batches):
                sent.add(batch.num_rows)
                yield batch

        return counted

    def stored(frame, label, own=collocations.stored):
        out = own(frame, label)
        kept[label] = out.count()
        return out

    for name, value in (("RANGE_BYTES", 2000), ("SHARD_BYTES", 9000), ("BUNDLE_BYTES", 9000),
                        ("FAN_OUT", fan_out), ("_shards", shards), ("stored", stored), ("SCORED", 50)):
        monkeypatch.setattr(collocations, name, value, raising=False)
    got = collocations.mine(make_docs(rows).repartition(4), least=4, covered=50, top=300)
    assert sorted(map(tuple, got.collect())) == phrases(rows, 4, 50, 300)
    assert sent.value <= 4 * fan_out  # a shard for each task
    assert kept["phrase-counts"] <= 60 and kept["phrase-parts"] <= 8 * 8 + 8  # 8 wide ranges
    assert len(collocations._steps(kept["phrase-counts"])) == rounds


def test_steps_reach_every_range(monkeypatch):
    for fan_out in (2, 3, 7, 128):
        monkeypatch.setattr(collocations, "FAN_OUT", fan_out)
        for n in (1, 2, 3, 5, 64, 127, 128, 129, 1270, 6300):
            whole, steps = [*collocations._steps(n), 1][0], collocations._steps(n)
            assert steps[-1] == 1 and -(-n // whole) <= fan_out
            assert all(a % b == 0 and a // b <= fan_out for a, b in zip(steps, steps[1:]))


def test_words_of_many_arrays_are_read_once():
    import time

    def took(k):
        parts = [pa.array([b"%07d" % i for i in range(j, 100_000, k)], pa.binary()) for j in range(k)]
        began = time.process_time()
        codes, table = numbered(parts)
        spent = time.process_time() - began
        assert table.to_pylist() == [b"%07d" % i for i in range(100_000)]
        assert codes[:2].tolist() == [0, k] and len(codes) == 100_000
        return spent

    assert min(took(400) for _ in range(3)) < 10 * min(took(2) for _ in range(3)) + 0.1


def test_phrases_of_nothing(nothing):
    assert collocations.mine(nothing).collect() == []


def test_top_rows_of_a_hot_group(spark):
    from pyspark.sql import functions as F

    rows = spark.range(5000).select(F.lit("hot").alias("g"), (F.col("id") % 700).alias("v"), "id")
    got = top_rows(rows, ["g"], [F.desc("v"), F.asc("id")], 9, salts=7).collect()
    want = sorted(((i % 700, -i) for i in range(5000)), reverse=True)[:9]
    assert sorted((r["rank"], r.v, r.id) for r in got) == [(k, v, -i) for k, (v, i) in enumerate(want, 1)]


# --- divergence ----------------------------------------------------------------


@settings(max_examples=80, deadline=None)
@given(data=st.data(), rows=st.integers(1, 9), other=st.integers(1, 9), columns=st.integers(1, 40))
def test_trees_walked_together_meet_every_cell(data, rows, other, columns):
    cells = st.dictionaries(st.tuples(st.integers(0, 8), st.integers(0, columns - 1)),
                            st.integers(1, 9), max_size=25)
    height = k2tree.side_height(max(rows, other))
    dense, trees = [], []
    for size in (rows, other):
        found = {k: v for k, v in data.draw(cells).items() if k[0] < size}
        full = np.zeros((size, columns), np.int64)
        for (i, j), v in found.items():
            full[i, j] = v
        i, j = np.nonzero(full)
        trees.append(k2tree.grow(i, j, full[i, j], columns, height))
        dense.append(full)
    empty = np.zeros((rows, other), np.int64)
    seen = []
    for now in k2tree.joint(*trees, rows, other, empty):
        p = np.where(now.a >= 0, np.append(trees[0].value, 0)[now.a], 0)
        q = np.where(now.b >= 0, np.append(trees[1].value, 0)[now.b], 0)
        seen += zip(now.row_a.tolist(), now.row_b.tolist(), now.column.tolist(), p.tolist(), q.tolist())
    want = [(i, j, c, int(dense[0][i, c]), int(dense[1][j, c])) for i in range(rows)
            for j in range(other) for c in range(columns) if dense[0][i, c] or dense[1][j, c]]
    assert sorted(seen) == want
    none = (dense[0] == 0).astype(int) @ (dense[1] == 0).astype(int).T
    assert (empty == none).all()


def test_shares_are_exact():
    rng = np.random.default_rng(1)
    total = rng.integers(1, 9 * 10**15, 500)
    n = (total * rng.random(500)).astype(np.int64)
    got = divergence.shares(n, total, 1)
    assert got.tolist() == [1 + 10**9 * (a + 1) // b for a, b in zip(n.tolist(), total.tolist())]


def audited(rows, top):
    docs = [(a or "", b or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(text or "")))
            for _, text, a, b, *_ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in set(d[2]))
        kept = {t for t, n in df.items() if n >= 3}
        c = {"": Counter(t for d in own for t in d[2] if t in kept)}
        sources = {d[1] for d in own}
        for s in sources:
            c["s" + s] = Counter(t for d in own if d[1] == s for t in d[2] if t in kept)
        p = {g: {t: 1 + 10**9 * (n[t] + 1) // (sum(n.values()) + len(kept)) for t in kept}
             for g, n in c.items()}
        for s in sources:
            a = p["s" + s]
            pair = [(sum((a[t] - q) ** 2 // q for t, q in p["s" + o].items()), o) for o in sources - {s}]
            term = [((a[t] - p[""][t]) ** 2 // p[""][t], t) for t in kept
                    if c["s" + s][t] and a[t] > p[""][t]]
            for part, found, most in (("pair", pair, len(pair)), ("term", term, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k) for k, (v, item) in enumerate(found[:most], 1)]
    return sorted(out)


def divergent_rows():
    rows = [(r[0], r[1], r[2], f"s{k % 5}" if k % 4 else r[3]) for k, r in enumerate(awkward_rows())]
    rows += [(100 + k, f"Éa bb cc{k % 4} {'dd ' * (k % 7)}", "fr", f"t{k % 9}") for k in range(60)]
    return [*rows, (200, None, "xx", "lonely"), (201, "9 1 .", "fr", "no terms"), (202, "q", "xx", None)]


@pytest.mark.parametrize("tile, block", [(64, 1 << 30), (2, 30_000)])
def test_divergence_equals_brute_force(make_docs, monkeypatch, tile, block):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "BLOCK_BYTES", block)
    docs = make_docs(divergent_rows(), EXTRA).repartition(3)
    got = divergence.audit(docs, top=7)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == audited(divergent_rows(), 7)


def test_divergence_of_nothing(nothing):
    assert divergence.audit(nothing).collect() == []


# --- piecewise hashes ----------------------------------------------------------


def edit_distance(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            above, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, above + (x != y))
    return d[-1]


@settings(max_examples=60, deadline=None)
@given(pairs=st.lists(st.tuples(*[st.text("ABz/9", min_size=1, max_size=64)] * 2), min_size=1, max_size=9))
def test_bit_vectors_give_the_edit_distance(pairs):
    a, b = map(list, zip(*pairs))
    assert fuzzy_hash.distances(a, b).tolist() == [edit_distance(x, y) for x, y in pairs]


def plain_fingerprint(text: bytes) -> str:
    """The definition, byte by byte."""
    if not text:
        return "0::"
    levels = []
    for i in range(len(text)):
        x = 0
        for c in (bytes(8) + text)[i + 1:i + 9]:
            x = (x * fuzzy_hash.ROLL + c) % 2**32
        x ^= x >> 15
        x = x * 0x2C1B3C6D % 2**32
        x ^= x >> 12
        levels.append((x & -x).bit_length() - 1 if x else 32)

    def stops(k):
        return [*(i + 1 for i in range(len(text) - 1) if levels[i] >= k), len(text)]

    def symbols(k):
        out, s, at = "", 0, stops(k)
        for e in at if len(at) <= 64 else [*at[:63], at[-1]]:
            h = sum((c + 1) * pow(fuzzy_hash.CHUNK, j, 2**64) for j, c in enumerate(text[s:e])) % 2**64
            h ^= h >> 31
            out, s = out + fuzzy_hash.SYMBOLS[h * 0xD6E8FEB86659FD93 % 2**64 >> 58], e
        return out

    k = next(k for k in range(40) if len(stops(k)) <= 64)
    k -= k > 0 and len(stops(k)) < 16
    return f"{k}:{symbols(k)}:{symbols(k + 1)}"


TEXTS = ["", "a", "ab" * 700, "x" * 300, "é" * 40, "The quick brown fox. " * 9, "".join(
    chr(97 + (i * i * 7 + i // 3) % 26) for i in range(3000))]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint_is_its_definition(text):
    assert fuzzy_hash.fingerprint(text.encode()) == plain_fingerprint(text.encode())


def test_blocks_do_not_matter(monkeypatch):
    whole = [fuzzy_hash.fingerprint(t.encode()) for t in TEXTS]
    monkeypatch.setattr(fuzzy_hash, "BLOCK", 37)
    assert [fuzzy_hash.fingerprint(t.encode()) for t in TEXTS] == whole


def test_likeness_follows_the_edits(tiny_docs):
    texts = [r["text"] for r in tiny_docs if r["text"] and len(r["text"]) > 400][:80]
    prints = [fuzzy_hash.fingerprint(t.encode()) for t in texts]
    assert (fuzzy_hash.likeness(prints, prints) == 1).all()
    small = [t[:len(t) // 2] + " one edit " + t[len(t) // 2:] for t in texts]
    near = fuzzy_hash.likeness(prints, [fuzzy_hash.fingerprint(t.encode()) for t in small])
    assert near.min() > 0.4 and np.median(near) > 0.9
    different = [(a, b) for a, b, x, y in zip(prints, prints[1:], texts, texts[1:])
                 if not set(x.split("\n")) & set(y.split("\n"))]
    assert np.median(fuzzy_hash.likeness(*map(list, zip(*different)))) == 0


def neighbours(rows):
    def key(r):
        return (r[0] is None, -(r[0] or 0))

    rows = sorted(((r[0], r[1] or "") for r in rows), key=key)
    groups = defaultdict(list)
    for k, t in rows:
        groups[k].append(t)
    return groups, rows


def test_neighbours_of_awkward_rows(awkward):
    got = fuzzy_hash.edited_neighbours(awkward).collect()
    groups, rows = neighbours(awkward_rows())
    assert Counter(r.doc_id for r in got) == Counter(k for k, _ in rows)
    # The order inside equal identifiers is the operator's: every other next text is determined.
    order = list(dict.fromkeys(k for k, _ in rows))
    for at, k in enumerate(order):
        mine = [r for r in got if r.doc_id == k]
        following = groups[order[(at + 1) % len(order)]]
        for r in mine:
            options = []
            for text in groups[k]:
                for nxt in [*following, *groups[k]]:
                    half = len(text) // 2
                    edited = (text[:len(text) - half] + nxt[:half]).encode()
                    options.append((len(text), hashlib.sha256(edited).hexdigest(),
                                    fuzzy_hash.fingerprint(text.encode()), fuzzy_hash.fingerprint(edited)))
            assert tuple(r)[1:5] in options
            assert r.near_edited == fuzzy_hash.likeness([r.fingerprint], [r.edited_fingerprint])[0]
            prints = {fuzzy_hash.fingerprint(t.encode()) for t in [*following, *groups[k]]}
            assert r.near_next in {float(fuzzy_hash.likeness([r.fingerprint], [p])[0]) for p in prints}


def test_neighbours_in_one_row_and_none(make_docs, nothing):
    (row,) = fuzzy_hash.edited_neighbours(make_docs([(5, "abcdef")])).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and row.near_next == 1.0
    assert fuzzy_hash.edited_neighbours(nothing).collect() == []


def test_fingerprints_and_pairs(awkward, spark):
    rows = fuzzy_hash.fingerprints(awkward).collect()
    want = Counter((r[0], fuzzy_hash.fingerprint((r[1] or "").encode())) for r in awkward_rows())
    assert Counter(map(tuple, rows)) == want
    pairs = spark.createDataFrame([("0::", "0::"), ("0:a:", None), ("0:abcdefgh:abcd", "0:abcdefgx:abcd")],
                                  "a string, b string")
    assert [r.likeness for r in fuzzy_hash.compared(pairs, "a", "b").collect()] == [1.0, None, 1.0]


def test_features_are_joined_in_row_order():
    column = pa.chunked_array([pa.array([b"abcd", None, b"", b"efgh"], pa.binary()).slice(1),
                               pa.array([], pa.binary()), pa.array([b"ijklmnop"], pa.binary())])
    for kind in (pa.binary(), pa.large_binary()):
        assert quality_rules._joined(column.cast(kind), "<u4").tobytes() == b"efghijklmnop"
    assert len(quality_rules._joined(column.slice(0, 0), np.float16)) == 0


def test_fit_gives_its_memory_back(spark, make_docs, monkeypatch):
    calls = []
    monkeypatch.setattr(quality_rules, "give_back", lambda: calls.append(1))
    docs = make_docs([(i, "plain words of prose here" if i % 2 else "#$ %% ** zq zq") for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2, int(i % 4 == 0)) for i in range(40)],
                                   "doc_id bigint, quality int, toxic int")
    model = quality_rules.fit(docs, labels)
    assert model.junk and model.toxic and calls
