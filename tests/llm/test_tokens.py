"""Encoding, token counts and token files against the library itself."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from scrutiny.llm import encoding, token_output
from scrutiny.llm.token_counts import count_tokens
from tests.llm.conftest import awkward_rows

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
PIECES = st.lists(st.sampled_from(
    ["the", "The", "of,", "don't", " ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", " ", "　",
     "é", "é", "ÀÉ", "straße", "İ", "12", "3.14", "<|endoftext|>", "<|startoftext|>", "x", "...",
     "'s", "\U0001f600", "zxqjw", "̈"]), max_size=30).map("".join)


@pytest.fixture(scope="module", params=FILES)
def pair(request):
    import public_tokenizers

    path = public_tokenizers.path(request.param)
    return encoding.UnitEncoder(path), Tokenizer.from_file(path)


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(PIECES | st.text(max_size=40), min_size=1, max_size=6))
def test_ids_are_the_librarys(pair, texts):
    ours, library = pair
    flat, sizes = ours.ids(texts)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want]
    assert flat.tolist() == [i for w in want for i in w]
    assert ours.lengths(texts).tolist() == sizes.tolist()


def test_forgetting_changes_nothing(pair, monkeypatch):
    ours, library = pair
    monkeypatch.setattr(encoding, "REMEMBERED", 3)
    for text in ("one two three four five", "six seven one two eight", "nine " * 50):
        assert ours.ids([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_counts_of_awkward_rows(awkward, byte_bpe):
    library = Tokenizer.from_file(byte_bpe)
    got = sorted(map(tuple, count_tokens(awkward, byte_bpe).collect()), key=str)
    want = []
    for key, text, *_ in awkward_rows():
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((key, len((text or "").encode()), n, n > 512))
    assert got == sorted(want, key=str)


def test_counts_of_nothing(nothing, byte_bpe):
    assert count_tokens(nothing, byte_bpe).count() == 0


def test_files_hold_every_id_in_order(spark, awkward, word_bpe, tmp_path):
    library = Tokenizer.from_file(word_bpe)
    path = str(tmp_path / "tokens")
    token_output.write_tokens(awkward, path, word_bpe, end_id=2)
    rows = awkward_rows()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    got = token_output.read_digests(spark, path).orderBy("start").collect()
    before, want = 0, []
    for key, text, *_ in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((key, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted([(r[0], r[2], r[3]) for r in got], key=str) == sorted(want, key=str)
    for r in got:
        assert r["start"] == before
        before += r["n_tokens"]
    keys = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert keys == sorted(keys)
    meta = token_output.read_metadata(spark, path)
    assert sorted(map(tuple, meta.collect()), key=str) == sorted([tuple(r)[:3] for r in got], key=str)
    one = token_output.read_documents(spark, path, [10]).collect()
    text = dict((k, t) for k, t, *_ in rows)[10]
    assert one[0]["ids"] == [*library.encode(text, add_special_tokens=False).ids, 2]


def test_file_layout(spark, make_docs, word_bpe, tmp_path):
    import glob

    import pyarrow.parquet as pq

    path = str(tmp_path / "layout")
    docs = make_docs([(i, f"text number {i} " * 20) for i in range(3000)])
    token_output.write_tokens(docs, path, word_bpe)
    meta = pq.ParquetFile(sorted(glob.glob(f"{path}/*.parquet"))[0]).metadata.row_group(0)
    by_name = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    ids = next(c for n, c in by_name.items() if n.startswith("ids"))
    assert "RLE_DICTIONARY" in ids.encodings or "PLAIN_DICTIONARY" in ids.encodings
    assert "DELTA_BINARY_PACKED" in by_name["doc_id"].encodings
    assert ids.has_offset_index and by_name["doc_id"].has_column_index


def test_files_of_nothing(spark, nothing, word_bpe, tmp_path):
    path = str(tmp_path / "none")
    token_output.write_tokens(nothing, path, word_bpe)
    assert token_output.read_digests(spark, path).count() == 0
