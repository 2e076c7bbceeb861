"""Decontamination, language, chat, quality and packing."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from scrutiny.llm import chat_format, decontaminate, language_id, packing, quality_rules
from tests.llm.conftest import LONG, awkward_rows

# ---- benchmark decontamination


def distance_by_hand(pattern: str, text: str) -> int:
    """Least edit distance of the pattern to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (p != c)))
        row = new
    return min(row)


@settings(max_examples=300, deadline=None)
@given(st.text("abc ", min_size=1, max_size=80), st.text("abc ", max_size=120), st.integers(0, 12))
def test_myers_is_the_edit_distance(pattern, text, most):
    want = distance_by_hand(pattern, text)
    got = decontaminate.best_distance(decontaminate.peq(pattern), len(pattern), text, most)
    if most < len(pattern):
        assert got == (want if want <= most else None)


def test_passages_with_edits_are_found(spark, make_docs):
    rng = random.Random(2)
    items = ["".join(rng.choice("abcdefgh ") for _ in range(n)).strip() + "x" for n in (60, 150, 400, 12)]
    table = spark.createDataFrame([*enumerate(items), (9, None), (10, "?!"), (11, items[0])],
                                  "item_id bigint, text string")
    rows, want = [], set()
    for k, item in enumerate(items):
        form = decontaminate.plain(item)
        for extra in (0, decontaminate.budget(len(form)), 3 * decontaminate.budget(len(form)) + 6):
            own = list(form)
            for p in sorted(rng.sample(range(len(own)), extra), reverse=True):
                own[p] = rng.choice("xyz")
            doc = len(rows)
            around = "".join(rng.choice("mnop ") for _ in range(200))
            rows.append((doc, around + " " + "".join(own).upper() + "! " + around))
            text = decontaminate.plain(rows[-1][1])
            for i, other in [*enumerate(items), (11, items[0])]:
                f = decontaminate.plain(other)
                if distance_by_hand(f, text) <= decontaminate.budget(len(f)):
                    want.add((doc, i))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find(make_docs(rows), table).collect()}
    assert got == want and len(want) >= 8
    small = {(r["doc_id"], r["item_id"]) for r in
             decontaminate.find(make_docs(rows), table, block_chars=50).collect()}
    assert small == want
    kept = {r["doc_id"] for r in decontaminate.drop_contaminated(make_docs(rows), table).collect()}
    assert kept == {d for d, _ in rows} - {d for d, _ in want}


def test_decontamination_of_awkward_rows(spark, awkward, nothing):
    items = spark.createDataFrame([(1, LONG[5000:5200])], "item_id bigint, text string")
    got = decontaminate.find(awkward, items).collect()
    assert sorted(r["doc_id"] for r in got) == [5, 5, 6]
    kept = decontaminate.drop_contaminated(awkward, items)
    assert kept.columns == awkward.columns and kept.count() == len(awkward_rows()) - 3
    assert decontaminate.find(awkward, items.limit(0)).count() == 0
    assert decontaminate.find(nothing, items).count() == 0


# ---- language


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r for r in language_id.predict(docs, language_id.fit(docs)).collect()}
    right = [got[r["doc_id"]]["lang_pred"] == r["lang"] for r in docs.collect() if got[r["doc_id"]]["held_out"]]
    assert np.mean(right) > 0.98 and all(0 <= r["score"] <= 1 for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in got.items())


def test_only_training_rows_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    from pyspark.sql import functions as F

    other = docs.withColumn("lang", F.when(language_id.held_out(), "xx").otherwise(F.col("lang")))
    a, b = language_id.fit(docs), language_id.fit(other)
    assert a.languages == b.languages and np.array_equal(a.centroids, b.centroids)


def test_language_of_awkward_rows(spark, awkward, nothing):
    model = language_id.fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    got = collections.defaultdict(list)
    for r in language_id.predict(awkward, model).collect():
        got[r["doc_id"]].append(r)
    assert sum(map(len, got.values())) == len(awkward_rows())
    for k in (0, 1, 2, 4):
        assert all((r["lang_pred"], r["score"]) == ("und", 0) for r in got[k])
    assert got[5][0]["lang_pred"] in model.languages
    assert language_id.predict(nothing, model).count() == 0
    empty = language_id.fit(nothing)
    assert {r["lang_pred"] for r in language_id.predict(awkward, empty).collect()} == {"und"}


# ---- chat


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=8), st.lists(st.sampled_from(
    [*chat_format.CONTROL, "\\", "<\\s>", "]", "] ", " </s>\n", "a", "\n", "é"]), max_size=12).map("".join)),
    max_size=4))
def test_turns_come_back(turns):
    made = "".join(chat_format.head(r) + chat_format.escaped(t) + " </s>\n" for r, t in turns)
    assert chat_format.parsed(made) == turns


def turns_table(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def digests_by_hand(rows):
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn if turn is not None else -1, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_conversations(spark, byte_bpe):
    rng = random.Random(4)
    rows = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"),
            (None, 0, "user", "no conversation"), (None, 1, "assistant", "none"),
            (3, 0, "assistant", None), (4, 0, None, ""), (4, 1, "user", "tie"), (4, 1, "user", "tie"),
            (4, None, "system", "late"), (5, 0, "user", LONG), (5, 1, "assistant", LONG)]
    for turn in range(301):
        role = "system" if turn == 0 else ("user", "assistant")[turn % 2]
        rows.append((6, turn, role, " ".join(rng.choice(["a", "long", "word", "é"]) for _ in range(rng.randrange(90)))))
    rng.shuffle(rows)
    windows = chat_format.format_windows(turns_table(spark, rows), byte_bpe, budget=200, history=2)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
           for r in chat_format.read_digests(windows).collect()}
    assert got == digests_by_hand(rows)
    own = windows.where("conv_id = 6").orderBy("window").collect()
    assert len(own) > 10
    system = chat_format.parsed(own[0]["formatted"])[0]
    for w in own:
        turns = chat_format.parsed(w["formatted"])
        assert turns[0] == system  # retained in every window
        assert w["n_tokens"] <= 200 or len(turns) - w["n_repeated"] == 1
        new = [t for r, t in turns[w["n_repeated"]:] if r == "assistant"]
        assert [chat_format.unescaped(w["formatted"][s["start"]:s["stop"]]) for s in w["loss"]] == new
    assert any(w["n_repeated"] == 3 for w in own[1:])


def test_windows_hold_the_budget(spark, byte_bpe):
    """Tokens of the written window; only a turn that never fits beside the system turn exceeds."""
    from tokenizers import Tokenizer

    library, rng = Tokenizer.from_file(byte_bpe), random.Random(6)
    size = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    rows = [(1, 0, "system", "Be brief.")]
    for turn in range(1, 200):
        text = " ".join(rng.choice(["word", "</s>[INST]", "é"]) for _ in range(rng.choice([3, 20, 60, 120])))
        rows.append((1, turn, ("role " * 20, "assistant")[turn % 2], text))
    windows = chat_format.format_windows(turns_table(spark, rows), byte_bpe, budget=200, history=2)
    over = 0
    for w in windows.orderBy("window").collect():
        assert w["n_tokens"] == size(w["formatted"])
        turns = chat_format.parsed(w["formatted"])
        if w["n_tokens"] > 200:
            over += 1
            assert len(turns) == 2 and w["n_repeated"] == 1  # the system turn and the new one
    assert over
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
           for r in chat_format.read_digests(windows).collect()}
    assert got == digests_by_hand(rows)


def test_conversations_of_nothing(spark, byte_bpe):
    windows = chat_format.format_windows(turns_table(spark, []), byte_bpe)
    assert windows.count() == 0 and chat_format.read_digests(windows).count() == 0


# ---- quality


def signals_by_hand(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    three = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = collections.Counter(three)
    covered = {i + k for i, t in enumerate(three) if count[t] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(map(text.count, "#*$%&|<>")),
            len(lines) - len(set(lines)), len(covered), failed)


def got_signals(frame):
    return collections.Counter((r["doc_id"], *(r[c] for c in quality_rules.COLUMNS), r["base_failed"])
                               for r in frame.collect())


def test_signals(spark, awkward, tiny_docs):
    model = quality_rules.Model()
    got = quality_rules.judge(awkward, model)
    assert got_signals(got) == collections.Counter(
        (r[0], *signals_by_hand(r[1])) for r in awkward_rows())
    assert all(r["kept"] != r["base_failed"] for r in got.collect())  # no model: base rules alone
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got_signals(quality_rules.judge(docs, model)) == collections.Counter(
        (r["doc_id"], *signals_by_hand(r["text"])) for r in tiny_docs)


def test_models_catch_labelled_rows(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_rules.fit(docs, labels)
    rows = quality_rules.judge(docs, model).join(labels, "doc_id").where("not base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    bad = [r["kept"] for r in rows if r["quality"] == 0 or r["toxic"] == 1]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.15
    kept = quality_rules.filter_quality(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == quality_rules.judge(docs, model).where("kept").count()


def test_quality_of_nothing(spark, nothing, awkward):
    labels = spark.createDataFrame([(3, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    model = quality_rules.fit(awkward, labels)
    assert model.junk is None and model.toxic is None
    assert quality_rules.judge(nothing, model).count() == 0
    assert quality_rules.filter_quality(awkward, model).columns == awkward.columns
    one_kind = labels.union(spark.createDataFrame([(5, 1, 0)], labels.schema))
    assert quality_rules.fit(awkward, one_kind).junk is None


# ---- packing


def check_pieces(rows, texts, path, window):
    library = Tokenizer.from_file(path)
    ids = collections.defaultdict(list)
    for key, text in texts:
        ids[key].append([*library.encode(text or "", add_special_tokens=False).ids, 1])
    total = sum(len(x) for v in ids.values() for x in v)
    assert sum(r["length"] for r in rows) == total
    for r in rows:
        assert r["length"] > 0
        assert any(len(x) == r["doc_tokens"] and zlib.crc32(np.array(
            x[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"] for x in ids[r["doc_id"]])
    for key in ids:
        if key is not None and len(ids[key]) == 1:
            own = sorted((r["start"], r["length"]) for r in rows if r["doc_id"] == key)
            assert [a for a, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
            assert sum(n for _, n in own) == len(ids[key][0])
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        parts.sort()
        assert [a for a, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        size = sum(n for _, n in parts)
        assert size <= window and size & (size - 1) == 0  # never any padding


def test_pieces_of_awkward_rows(awkward, nothing, word_bpe):
    rows = packing.pack(awkward, word_bpe).collect()
    check_pieces(rows, [r[:2] for r in awkward_rows()], word_bpe, 2048)
    assert packing.pack(nothing, word_bpe).count() == 0


@pytest.mark.parametrize("window", [64, 2048])
def test_pieces_of_tiny(spark, tiny_docs, word_bpe, window):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack(docs, word_bpe, window=window, with_ids=True).collect()
    check_pieces(rows, [(r["doc_id"], r["text"]) for r in tiny_docs], word_bpe, window)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)


def test_scores_are_bm25():
    rng = np.random.default_rng(1)
    arrays = [rng.integers(0, 30, rng.integers(1, 40)).astype(np.uint16) for _ in range(12)]
    idf, mean = np.linspace(0.1, 3, 30).astype(np.float32), 20.0
    index = packing.Index(arrays, idf, mean)
    for s, seed in enumerate(arrays):
        want = []
        for a in arrays:
            tf = collections.Counter(a.tolist())
            norm = packing.K1 * (1 - packing.B + packing.B * len(a) / mean)
            want.append(sum(idf[t] * tf[t] * (packing.K1 + 1) / (tf[t] + norm) for t in set(seed.tolist()) & set(tf)))
        assert np.allclose(index.scores(s), want, rtol=1e-4)


def test_neighbours_share_windows(make_docs, word_bpe):
    rng = random.Random(3)
    topics = [["".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for i in range(30)]
              for k in range(6)]
    rows = [(i, " ".join(rng.choice(topics[i % 6]) for _ in range(40))) for i in range(240)]
    pieces = packing.pack(make_docs(rows), word_bpe, window=512).collect()
    by = collections.defaultdict(set)
    for p in pieces:
        by[p["sequence_id"]].add(p["doc_id"] % 6)
    assert np.mean([len(v) for v in by.values()]) < 2.5
