"""The registered queries themselves, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from scrutiny.llm.queries import QUERIES
from scrutiny.llm.sql import ORACLES

COLUMNS = {
    1: "doc_id start:bigint n_tokens:bigint ids_crc32:bigint",
    2: "doc_id n_bytes:bigint n_removed:bigint n_spans:bigint kept_sha256:string",
    3: "doc_id",
    4: "doc_id held_out:boolean lang_pred:string score:double",
    5: "conv_id n_turns:bigint turns_sha256:string loss_chars:bigint loss_sha256:string formatted_chars:bigint",
    6: "doc_id n_bytes:bigint n_tokens:bigint over_limit:boolean",
    7: "doc_id fingerprint:string component_id:bigint",
    8: "doc_id n_lines:bigint n_dropped:bigint kept_sha256:string",
    9: "doc_id start:bigint length:bigint ids_crc32:bigint doc_tokens:bigint sequence_id:bigint offset:bigint",
    10: "doc_id n_words:bigint word_chars:bigint n_symbols:bigint n_dup_lines:bigint n_repeat_words:bigint "
        "base_failed:boolean kept:boolean",
    11: "lang:string source:string part:string item:string value:bigint rank:int",
    12: "doc_id n_chars:bigint edited_sha256:string fingerprint:string edited_fingerprint:string "
        "near_edited:double near_next:double",
    13: "lang:string rank:bigint phrase:string a:bigint l:bigint r:bigint n:bigint score:bigint",
}


@pytest.mark.parametrize("name", sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0])))
def test_query(spark, tiny, name):
    got = QUERIES[name](spark, tiny)
    kinds = dict(got.dtypes)
    for column in COLUMNS[int(name[2:].split("_")[0])].split():
        column, _, kind = column.partition(":")
        assert kinds[column] == (kind or "bigint")
    rows = got.toPandas()
    if "doc_id" in kinds and name not in ("op3_decontamination", "op9_packing"):
        n = duckdb.sql(f"SELECT count(*) FROM '{tiny}/documents.parquet'").fetchall()[0][0]
        assert len(rows) == n and rows.doc_id.is_unique
    if name == "op5_chat_format":
        assert (rows.conv_id == -1).sum() == 1 and rows.conv_id.is_unique
    if name == "op7_simhash":
        assert rows.fingerprint.str.fullmatch("[0-9a-f]{16}").all()
    if name in ORACLES:
        db = duckdb.connect()
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tiny}/documents.parquet'")
        want = db.execute(ORACLES[name]).df()
        names = sorted(want.columns)
        assert sorted(rows.columns) == names
        assert (sorted(map(tuple, rows[names].astype(str).to_numpy()))
                == sorted(map(tuple, want[names].astype(str).to_numpy())))


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
