from __future__ import annotations

import public_tokenizers
import pytest

EXTRA = ("n_lines", "n_dropped", "node", "fp", "key", "row", "component_id", "ids", "start", "chunk",
         "held_out", "lang_pred", "kept", "tokens", "dropped", "file_no", "first", "second", "label")
LONG = " ".join(f"word{i % 977} tail{i % 31}." for i in range(60_000))
LINE = "The same line of more than forty characters, again."


def awkward_rows() -> list[tuple]:
    """Nulls, blanks, ties, repeated rows, very long and very odd texts."""
    texts = [None, "", " \n\t ", "a", "\n\n\n", LONG, LONG, "é́ \x1c x\x1c\x1dy  z",
             "no_white_space" * 3000, "\U0001f600 👩‍👩‍👧 ß ẞ İ", "<|endoftext|> a<|endoftext|>b"]
    texts += [f"{LINE}\nline {i}\n{LINE.upper()}" for i in range(6)]
    rows = [(i, t, None if i % 3 == 0 else "en", "s") for i, t in enumerate(texts)]
    return [*rows, rows[0], rows[5], rows[11], (None, LINE, "en", None), (None, None, None, None),
            (None, LONG[:3000], None, "s")]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, extra=()):
        ddl = "doc_id bigint, text string, lang string, source string" + "".join(
            f", {c} string" for c in extra)
        full = [(*r, *([None] * (4 - len(r))), *(["x"] * len(extra))) for r in rows]
        return spark.createDataFrame(full, ddl)

    return make


@pytest.fixture(scope="session")
def awkward(make_docs):
    return make_docs(awkward_rows(), EXTRA).repartition(3)


@pytest.fixture(scope="session")
def nothing(make_docs):
    return make_docs([])


@pytest.fixture(scope="session")
def word_bpe():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def byte_bpe():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def tiny_docs():
    import pyarrow.parquet as pq

    return pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist()
