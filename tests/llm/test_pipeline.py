"""The pipeline stage by stage: decisions take effect, columns stay, pieces cover what is kept."""

from __future__ import annotations

import collections

import pytest

import corpus_pipeline
from scrutiny.llm import decontaminate
from scrutiny.llm.common import stored
from tests.llm.test_lines_and_substrings import lines_by_hand
from tests.llm.test_texts import check_pieces

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, stored(stage(spark, out[-1][1], DIR), name)))
    return dict(out)


def ids(frame):
    return {r["doc_id"] for r in frame.select("doc_id").collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == list(stages)[1:]
    for name in list(stages)[:-1]:
        assert stages[name].columns == stages["documents"].columns
        assert stages[name].dtypes == stages["documents"].dtypes


def test_quality_keeps_the_good(spark, stages):
    labels = spark.read.parquet(f"{DIR}/labels.parquet").collect()
    kept = ids(stages["quality_rules"])
    words = {r["doc_id"]: len((r["text"] or "").split()) for r in stages["documents"].collect()}
    good = [r["doc_id"] in kept for r in labels if r["quality"] == 1 and r["toxic"] == 0 and words[r["doc_id"]] >= 60]
    assert sum(good) >= 0.95 * len(good)
    assert len(kept) < len(words)


def test_lines_by_hand(stages):
    before = [(r["doc_id"], r["text"]) for r in stages["quality_rules"].collect()]
    want = {d: t for d, _, _, t in lines_by_hand(before)}
    rows = stages["line_dedup"].collect()
    assert {r["doc_id"]: r["text"] or "" for r in rows} == want
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_one_of_each_group_stays(stages):
    before, after = stages["line_dedup"].collect(), ids(stages["simhash_near_dedup"])

    def shingles(text):
        w = text.lower().split()
        return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))

    sets = {r["doc_id"]: shingles(r["text"] or "") for r in before}
    for gone in set(sets) - after:  # each has a near copy with a smaller id
        assert any(k < gone and len(sets[k] & sets[gone]) >= 0.79 * len(sets[k] | sets[gone]) for k in sets)
    by = collections.defaultdict(list)
    for k in after:
        by[sets[k]].append(k)
    assert all(len(v) == 1 for v in by.values())


def test_no_item_is_left(spark, stages):
    items = [decontaminate.plain(r["text"]) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    texts = {r["doc_id"]: decontaminate.plain(r["text"] or "") for r in stages["simhash_near_dedup"].collect()}
    held = {k for k, t in texts.items() if any(i in t for i in items)}
    left = ids(stages["benchmark_decontamination"])
    assert not held & left and left <= set(texts)
    table = spark.read.parquet(f"{DIR}/benchmark.parquet")
    found = ids(decontaminate.find(stages["simhash_near_dedup"], table))
    assert set(texts) - left == found and held <= found


def test_pieces_cover_the_rest(stages, word_bpe):
    texts = [(r["doc_id"], r["text"]) for r in stages["benchmark_decontamination"].collect()]
    check_pieces(stages["packing"].collect(), texts, word_bpe, 2048)


def test_run_gives_the_same_documents(spark, stages):
    assert ids(corpus_pipeline.run(spark, DIR)) == ids(stages["packing"])


def test_stages_take_awkward_rows(spark, awkward):
    from pyspark.sql import functions as F

    docs = awkward.withColumn("n_chars", F.length("text").cast("bigint"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, DIR), "awkward")
        assert set(docs.columns) == {*awkward.columns, "n_chars"}
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), DIR).count() == 0
