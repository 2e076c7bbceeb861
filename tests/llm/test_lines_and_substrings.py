"""Line dedup and substring dedup against plain Python."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scrutiny.llm import anchors, line_dedup, suffix_dedup
from scrutiny.llm.cuckoo import CuckooFilter, filter_of
from tests.llm.conftest import LINE, awkward_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lines_by_hand(rows: list[tuple], min_docs: int = 5) -> dict:
    """Rows with an identifier: number of lines, dropped lines, text."""
    def key(line):
        k = line.strip(" \t\n\v\f\r").translate(LOWER)
        return k if len(k) >= 40 else None

    held = collections.defaultdict(list)
    for doc, text in rows:
        if doc is not None:
            for k in {key(x) for x in (text or "").split("\n")} - {None}:
                held[k].append(doc)
    hot = {k: max(v) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or hot.get(key(x), doc) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return collections.Counter(out)


def got_lines(frame):
    return collections.Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "")
                               for r in frame.select("doc_id", "n_lines", "n_dropped", "text").collect())


def test_lines_of_awkward_rows(awkward):
    got = line_dedup.dedup_lines(awkward)
    assert set(awkward.columns) == set(got.columns)  # n_lines and n_dropped were there already
    assert got_lines(got) == lines_by_hand([r[:2] for r in awkward_rows()])
    assert line_dedup.dedup_lines(awkward, counts=False).columns == awkward.columns


def test_lines_of_tiny(spark, tiny_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = lines_by_hand([(r["doc_id"], r["text"]) for r in tiny_docs])
    assert got_lines(line_dedup.dedup_lines(docs)) == want


def test_lines_of_nothing(nothing):
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_hot_line_in_parts(make_docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "PART_ROWS", 50)
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 3)
    rows = [(i, f"{LINE}\n{'other line of more than forty characters ' * 2}{i % 7}") for i in range(400)]
    assert got_lines(line_dedup.dedup_lines(make_docs(rows))) == lines_by_hand(rows)


def test_index_is_reversible(spark, make_docs, tmp_path):
    base = [(i, f"{LINE}\nown {i}") for i in range(4)]
    more = [(i, f"own {i}\n{LINE}\n{LINE}") for i in range(4, 8)]
    index = line_dedup.LineIndex(spark, str(tmp_path / "index"), shards=2)
    index.insert(make_docs(base))
    assert got_lines(index.apply(make_docs(base))) == lines_by_hand(base)  # four documents: nothing goes
    index.insert(make_docs(more))
    assert got_lines(index.apply(make_docs(base + more))) == lines_by_hand(base + more)
    index.delete(make_docs(more))
    assert index.references().count() == 0
    assert got_lines(index.apply(make_docs(base))) == lines_by_hand(base)
    index.insert(make_docs(more[:1]))
    assert got_lines(index.apply(make_docs(base + more[:1]))) == lines_by_hand(base + more[:1])


def test_index_builds_full_filters_anew(spark, make_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(CuckooFilter, "for_keys", classmethod(lambda cls, n: cls(16)))
    index = line_dedup.LineIndex(spark, str(tmp_path / "full"), shards=1, min_docs=1)
    rows = [(i, f"line number {i} of more than forty characters in all") for i in range(40)]
    index.insert(make_docs(rows))
    assert got_lines(index.apply(make_docs(rows))) == lines_by_hand(rows, 1)


def keys(n: int, salt: str = "") -> list[bytes]:
    return [hashlib.blake2b(f"{salt}{i}".encode(), digest_size=16).digest() for i in range(n)]


def test_cuckoo_filter():
    held, others = keys(5000), keys(20_000, "x")
    made = filter_of(held)
    assert made.contains(held).all()
    assert made.contains(others).mean() < 0.01
    again = CuckooFilter.loaded(made.dump())
    again.remove(held[:2500])
    assert again.contains(held[2500:]).all() and again.contains(held[:2500]).mean() < 0.02
    assert not CuckooFilter(16).add(keys(500))


def substrings_by_hand(rows: list[tuple[int, bytes]]) -> list[tuple]:
    seen: set[bytes] = set()
    out = []
    for doc, raw in sorted(rows, key=lambda r: r[0]):
        gone = bytearray(len(raw))
        for p in range(len(raw) - 99):
            part = raw[p:p + 100]
            if part in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(part)
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1]))
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got_substrings(docs):
    rows = suffix_dedup.dedup_substrings(docs, with_text=False).collect()
    return sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
                  for r in rows if r["doc_id"] is not None)


def test_substrings_of_tiny(spark, tiny_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    want = substrings_by_hand([(r["doc_id"], (r["text"] or "").encode()) for r in tiny_docs])
    assert got_substrings(docs) == want


@pytest.mark.parametrize("chunk", [4 << 20, 3000])
def test_substrings_with_edges(make_docs, monkeypatch, chunk):
    """Runs, overlaps, shared middles with other surroundings, and periodic texts."""
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", chunk)
    rng = np.random.default_rng(3)
    word = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    base = word(700)
    rows = [(0, base), (1, word(50) + base[100:260] + word(50)), (2, base[:99] + "é" + base[99:199]),
            (3, "ab" * 400), (4, "x" * 350), (5, "ab" * 100 + base[350:450]), (6, base[351:450]),
            (7, base), (8, word(30) + base[200:420] + "ß" + base[300:520]), (9, ""), (10, None),
            (11, "Of Of " * 90), (12, base[150:350] + base[150:350])]
    want = substrings_by_hand([(d, (t or "").encode()) for d, t in rows])
    assert got_substrings(make_docs(rows).repartition(3)) == want


def test_substrings_of_awkward_rows(awkward):
    rows = suffix_dedup.dedup_substrings(awkward).collect()
    assert len(rows) == len(awkward_rows())
    by = collections.defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    assert all(r["n_removed"] == 0 for r in by[None])
    assert {r["n_bytes"] for r in by[6]} == {len(awkward_rows()[6][1])}
    assert sorted(r["n_removed"] for r in by[5])[-1] == by[5][0]["n_bytes"]  # the repeated row


def test_null_ids_before_named_rows_lose_nothing(make_docs):
    """Also identifiers that are equal as floats."""
    text = "".join(np.random.default_rng(8).choice(list("abcdefgh "), 300))
    rows = [(None, "null " + text), (2**53 + 1, text), (None, None), (5, "five"), (2**53, text), (3, "three")]
    got = suffix_dedup.dedup_substrings(make_docs(rows).coalesce(1)).collect()
    assert collections.Counter((r["doc_id"], r["n_bytes"]) for r in got) == collections.Counter(
        (d, len(t or "")) for d, t in rows)
    assert {r["doc_id"]: r["n_removed"] for r in got if r["doc_id"]} == {3: 0, 5: 0, 2**53: 0, 2**53 + 1: 300}


def test_substrings_of_nothing(nothing):
    assert suffix_dedup.dedup_substrings(nothing).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", max_size=400), min_size=1, max_size=4))
def test_equal_strings_have_equal_anchors(texts):
    raws = [t.encode() for t in texts]
    _, at, first, last = anchors.anchors(
        np.frombuffer(b"".join(raws), np.uint8), np.array([len(r) for r in raws]))
    place = {}
    whole = b"".join(raws)
    for a, b, c in zip(at.tolist(), first.tolist(), last.tolist()):
        for p in range(b, c + 1):
            assert place.setdefault(whole[p:p + 100], a - p) == a - p
    assert sum((last - first + 1).tolist()) == sum(max(0, len(r) - 99) for r in raws)


def test_an_index_is_opened_again_and_repeated_inserts_count_once(spark, tmp_path, make_docs):
    line = "a line of more than forty characters in many documents"
    docs = make_docs([(i, f"{line}\nown line {i}") for i in range(5)])
    path = str(tmp_path / "index")
    first = line_dedup.LineIndex(spark, path, shards=2)
    first.insert(docs)
    first.insert(docs.where("doc_id = 0"))  # again
    first.delete(docs.where("doc_id = 0"))  # once: it is still held

    def dropped(index):
        return sum(r.n_dropped for r in index.apply(docs).collect())

    assert first.references().count() == 1 and dropped(first) == 4
    again = line_dedup.LineIndex(spark, path, shards=2)
    assert again.version == first.version and dropped(again) == 4
    again.delete(docs.where("doc_id = 0"))
    assert again.references().count() == 0 and dropped(again) == 0
    again.insert(docs.where("doc_id = 0"))
    assert dropped(line_dedup.LineIndex(spark, path, shards=2)) == 4


def test_leads_stay_whole_in_linear_time():
    import time

    import pyarrow as pa

    def batches(leads, step):
        flat = sorted(leads)
        for i in range(0, len(flat), step):
            part = flat[i:i + step]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x + b"tail" for x in part]), pa.array(range(len(part)))], ["suffix", "spot"])

    rng = random.Random(3)
    leads = [bytes([rng.randrange(6)]) * 32 for _ in range(900)]
    for least in (1, 7, 300, 10**6):
        got = list(suffix_dedup.whole_leads(batches(leads, 11), least))
        assert sum(b.num_rows for b in got) == len(leads)
        seen = [{v.as_py()[:32] for v in b.column("suffix")} for b in got]
        assert sum(map(len, seen)) == len(set(leads))  # no lead is in two
    times = []
    for n in (100_000, 400_000):
        start = time.process_time()
        list(suffix_dedup.whole_leads(batches([b"x" * 32] * n, 1000), 1000))
        times.append(time.process_time() - start)
    assert times[1] < 12 * max(times[0], 0.05)
