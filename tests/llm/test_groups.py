"""Fingerprints, the trie self-join, components and near duplicates against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from scrutiny.llm import simhash, trie_join
from scrutiny.llm.components import components
from tests.llm.conftest import awkward_rows


def fingerprint_by_hand(text: str | None, size: int = 4, seed: int = 42) -> int:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = ([" ".join(words[i:i + size]) for i in range(len(words) - size + 1)]
             if len(words) >= size else [" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(p.encode(), seed) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(values: dict) -> dict:
    """Smallest key reachable over values at four bits or fewer."""
    ids = sorted(values)
    fps = np.array([values[i] for i in ids], np.uint64)
    root = list(range(len(ids)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= 4) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return {k: ids[find(i)] for i, k in enumerate(ids)}


def test_groups_of_tiny(spark, tiny_docs):
    got = {r["doc_id"]: r for r in simhash.group(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()}
    values = {r["doc_id"]: fingerprint_by_hand(r["text"]) for r in tiny_docs}
    assert {k: r["fp"] & (1 << 64) - 1 for k, r in got.items()} == values
    assert {k: r["component_id"] for k, r in got.items()} == grouped(values)


def test_groups_of_awkward_rows(awkward):
    got = simhash.group(awkward).collect()
    assert len(got) == len(awkward_rows())
    blank = {r["component_id"] for r in got if r["fp"] == 0}
    assert blank == {0}  # null, empty and blank texts, also without an identifier
    assert simhash.group(awkward.limit(0)).count() == 0


@pytest.mark.parametrize("n", [3, 400])
def test_trie_join_on_dense_and_random_values(spark, monkeypatch, n):
    """Chains, dense balls and random values; small limits make every branch run."""
    monkeypatch.setattr(trie_join, "WALK", 1 << 9)
    monkeypatch.setattr(trie_join, "ROWS", 100)
    rng = random.Random(n)
    values = {rng.getrandbits(64) for _ in range(n)}
    for base in list(values)[:3]:
        values |= {base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 4))) for _ in range(n)}
        chain = base
        for _ in range(20):
            chain ^= sum(1 << b for b in rng.sample(range(64), 4))
            values.add(chain)
    values |= {0, (1 << 64) - 1, 15, 31}
    by_node = dict(enumerate(sorted(values)))
    signed = [(i, v - (1 << 64) if v >> 63 else v) for i, v in by_node.items()]
    ties = trie_join.links(spark.createDataFrame(signed, "node bigint, fp bigint"))
    assert all(bin(by_node[r["a"]] ^ by_node[r["b"]]).count("1") == r["bits"]
               for r in ties.collect() if r["bits"] < 64)
    found = {r["node"]: r["component"] for r in components(ties).collect()}
    assert {i: found.get(i, i) for i in by_node} == grouped(by_node)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 300)] + [(7, 7), (300, 301)]
    edges += [(b, a) for a, b in edges[:20]]
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in
           components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(300)}}
    want[301] = 100
    assert {k: got[k] for k in got} == {k: want.get(k, 100) for k in got}
    assert set(got) == set(range(61)) | set(range(100, 400)) | {301}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def text_of(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(n)]


def test_near_copies_are_found_and_others_left(make_docs):
    rng = random.Random(11)
    rows, copies = [], {}
    for i in range(40):
        words = text_of(rng, 300)
        rows.append((10 * i, " ".join(words)))
        if i < 20:
            for k in (1, 2):
                own = list(words)
                for p in rng.sample(range(300), 2):
                    own[p] = "changed"
                rows.append((10 * i + k, " ".join(own)))
                copies[10 * i + k] = 10 * i
    rows += [(1000, rows[0][1]), (1001, rows[0][1].upper())]
    copies |= {1000: 0, 1001: 0}
    rng.shuffle(rows)
    kept = sorted(r["doc_id"] for r in simhash.keep_one(make_docs(rows)).collect())
    assert kept == sorted({d for d, _ in rows} - set(copies))


def test_family_of_edited_copies_against_brute_force(make_docs):
    """Variants like their base but not like each other: ties among variants must not hide the base."""
    rng = random.Random(3)
    base, rows = text_of(rng, 300), []
    for i in range(1001):
        own = list(base)
        for p in rng.sample(range(10, 290), 6) if i else ():
            own[p] = f"edit{i}x{p}"
        rows.append((i, " ".join(own)))
    docs = make_docs(rows)
    fps = np.array([r["fps"] for r in simhash.sketched(docs).orderBy("doc_id").collect()]).view(np.uint64)
    sets = [{tuple(t.split()[k:k + 5]) for k in range(296)} for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(rows)):
        for j in np.flatnonzero((np.bitwise_count(fps[i + 1:] ^ fps[i]) <= 4).any(1)) + i + 1:
            a, b = find(i), find(int(j))
            if a != b and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root[max(a, b)] = min(a, b)
    want = [i for i in range(len(rows)) if find(i) == i]
    assert len(want) < 100
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs).collect()) == want


def test_pairs_apart_are_all_pairs_between_labels(spark, monkeypatch):
    """Also of equal values, whatever the limits of the walk."""
    monkeypatch.setattr(trie_join, "WALK", 1 << 9)
    monkeypatch.setattr(trie_join, "ROWS", 100)
    rng = random.Random(9)
    bases = [rng.getrandbits(63) for _ in range(3)]
    rows = [(i, rng.choice(bases) ^ sum(1 << b for b in rng.sample(range(63), rng.randrange(4))),
             i % 2, rng.randrange(4), 10, 10, rng.randrange(3)) for i in range(300)]
    rows += [(300 + i, bases[0], 0, i % 3, 10 + i % 5, 10 + i % 5, 0) for i in range(90)]
    want = {(x[0], y[0]) for x in rows for y in rows
            if x[0] < y[0] and x[2] == y[2] and x[3] != y[3] and (x[1] ^ y[1]).bit_count() <= 4
            and min(x[4], y[4]) >= 0.8 * max(x[4], y[4])}
    nodes = spark.createDataFrame(rows, ", ".join(
        f"{c} bigint" for c in ("node", "fp", "seed", "label", "low", "high", "weight")))
    assert {tuple(r) for r in trie_join.apart(nodes, 4, 0.8, False).collect()} == want
    some = {tuple(r) for r in trie_join.apart(nodes, 4, 0.8, True).collect()}
    assert some <= want and {n for p in some for n in p} == {n for p in want for n in p}


def test_unlike_variants_are_not_listed_in_pairs(make_docs, monkeypatch):
    """Fingerprints within the budget, sets too far apart: the square of the family must not come out."""
    rng = random.Random(4)
    base, rows = text_of(rng, 300), []
    for i in range(240):
        own = list(base)
        for p in rng.sample(range(10, 290), 9):
            own[p] = f"edit{i}x{p}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join(t.split()[1:])) for i, t in rows[:20]]
    asked, verified = [], simhash.verified
    monkeypatch.setattr(simhash, "verified", lambda pairs, *rest: asked.append(pairs.count()) or verified(pairs, *rest))
    docs = make_docs(rows)
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs).collect()) == list(range(240))
    assert len(asked) == 3 and sum(asked[1:]) < 2 * len(rows)


def test_parities_never_tell_more_than_the_difference():
    rng = np.random.default_rng(8)
    sizes = [0, 1, 30, 40, 300, 330, 5000, 6000, 20_000]
    pool = rng.integers(0, 1 << 63, 30_000).astype(np.uint64)
    sets = [np.unique(rng.choice(pool[:2 * n + 1], n)) for n in sizes for _ in range(3)]
    parities = trie_join.Parities(np.array([*map(trie_join.parity, sets), None], object))
    i, j = (x.ravel() for x in np.indices((len(sets) + 1,) * 2))
    got = parities.differ(i, j).reshape(len(sets) + 1, -1)
    true = np.array([[len(np.setxor1d(a, b)) for a in sets] for b in sets])
    assert (got[:-1, :-1] <= true).all() and not got[-1].any() and not got[:, -1].any()
    assert not np.diag(got).any() and (got[:-1, :-1][(true > 9) & (true < 800)] > 0).all()


def test_jobs_of_the_near_dedup_are_few(spark, make_docs):
    """The driver remembers each task of each job."""
    rng = random.Random(6)
    rows = [(i, " ".join(text_of(rng, 60))) for i in range(20)]
    rows += [(100 + i, t + " more") for i, t in rows] + [(200 + i, t) for i, t in rows]
    spark.sparkContext.setJobGroup("near-dedup", "")
    try:
        assert simhash.keep_one(make_docs(rows)).count() == 20
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("near-dedup")) < 110


def test_near_duplicates_of_awkward_rows(awkward, nothing):
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(None) == 3 and 0 in ids and 1 not in ids and 2 not in ids and 6 not in ids
    assert simhash.keep_one(nothing).count() == 0
