from __future__ import annotations

import hashlib
import random
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from scrutiny.functions import scalars as S


def values(spark, ddl, rows, column):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(column).collect()]


def check(spark, ddl, cases, column):
    """The column's value for every case, whose last element is what is expected."""
    got = values(spark, ddl, [case[:-1] for case in cases], column)
    assert dict(zip(cases, got)) == {case: case[-1] for case in cases}


def test_acta_id(spark):
    check(spark, "m bigint, u string, e bigint", [
    (5507, "040102", 10, 550704010210),
    (1, "150101", 10, 115010110),
    (5507, "040102", 15, 550704010215),
    (92766, "250405", 13, 9276625040513),
    (7, "010101", 14, 701010114),
], S.acta_id("m", "u", "e"))


def test_acta_ids_do_not_collide(spark):
    rng = random.Random(7)
    keys = {(rng.randrange(1, 99999), f"{rng.randrange(10101, 259999):06d}", e)
            for _ in range(500) for e in (10, 12, 13, 14, 15)}
    ids = values(spark, "m bigint, u string, e bigint", sorted(keys), S.acta_id("m", "u", "e"))
    assert len(set(ids)) == len(keys)


def test_place_code_takes_first_known_and_pads(spark):
    rows = [("40102", None, None), (None, "140101", "9"), (None, None, "91")]
    got = values(spark, "a string, b string, c string", rows, S.place_code("a", "b", "c"))
    assert got == ["040102", "140101", "000091"]
    with pytest.raises(PySparkException, match="place code"):
        values(spark, "a string, b string", [(None, None)], S.place_code("a", "b"))


def test_place_prefix(spark):
    row = spark.createDataFrame([("140105",)], "u string").select(
        *[S.place_prefix("u", level) for level in ("department", "province", "district")]).first()
    assert tuple(row) == ("140000", "140100", "140105")


@pytest.mark.parametrize("shards", [1, 3, 7, 10, 1_000_003, 2**31 - 1])
def test_shard_of_equals_big_integer_modulo(spark, shards):
    keys = [str(k) for k in range(300)] + ["69dce34ad7b6147f63e6fe04", "ñ", ""]
    got = values(spark, "k string", [(k,) for k in keys], S.shard_of("k", shards))
    assert got == [int(hashlib.md5(k.encode()).hexdigest(), 16) % shards for k in keys]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(max_size=20), min_size=1, max_size=30), st.integers(1, 5000))
def test_shard_of_any_text(spark, keys, shards):
    rows = [(k,) for k in keys]
    got = values(spark, "k string", rows, S.shard_of("k", shards))
    assert got == [int(hashlib.md5(k.encode("utf-8", "ignore")).hexdigest(), 16) % shards
                   for k in keys]


MOMENTS = [0, 1744984800000, 1776488709960, 1700000000001, 1704085199999, 1704085200000]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_local_time_does_not_depend_on_the_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(m,) for m in MOMENTS], "ms bigint").select(
            S.lima_date("ms"), S.lima_iso("ms")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for moment, (day, iso) in zip(MOMENTS, rows):
        local = datetime.fromtimestamp(moment / 1000, tz=timezone.utc).astimezone(
            ZoneInfo("America/Lima"))
        assert day == local.strftime("%Y-%m-%d")
        assert iso == local.isoformat()


def test_electoral_district(spark):
    check(spark, "d string, p string, s bigint", [
    ("010000", "010100", 1, 1), ("060000", None, 1, 6), ("070000", None, 1, 8),
    ("130000", None, 1, 14), ("140000", "140100", 1, 15), ("140000", "140200", 1, 16),
    ("140000", None, 1, 16), ("150000", None, 1, 17), ("230000", None, 1, 25),
    ("240000", None, 1, 7), ("250000", None, 1, 26), ("920000", "920100", 2, 27),
    ("260000", None, 1, None), (None, None, 1, None), ("", None, 1, None), ("XX0000", None, 1, None),
    (None, None, 2, 27), ("140000", "140100", None, 15),
], S.electoral_district("d", "p", "s"))


def test_age_band(spark):
    check(spark, "a bigint", [
    (0, "<18"), (17, "<18"), (18, "18_25"), (25, "18_25"), (26, "26_35"), (35, "26_35"),
    (36, "36_45"), (45, "36_45"), (46, "46_60"), (60, "46_60"), (61, "61_plus"), (110, "61_plus")], S.age_band("a"))


def test_compact_date(spark):
    check(spark, "r string", [
    ("20250407", "2025-04-07"), ("20251332", "2025-13-32"), ("2025-04-07", ""), ("2025040", ""),
    ("", ""), (None, ""), ("2025040a", ""), ("20250407\n", "")], S.compact_date_to_iso("r"))


def test_institution(spark):
    check(spark, "n string", [
    ("N° 0126-2025-JNE", "JNE"), ("R.J. 000012-2025-JN/ONPE", "ONPE"), ("xx/onpe/yy", "ONPE"),
    ("RESOLUCION RENIEC 5", "RENIEC"), ("N° 1-2025-JEE-LIMA/JEE", "JEE"), ("1/JNE y RENIEC", "JNE"),
    ("ley 30000", ""), ("", "")], S.institution_of("n"))


def test_https_only(spark):
    check(spark, "u string", [
    ("https://a/b", "https://a/b"), ("http://a", ""), ("file:///etc/passwd", ""), ("", ""),
    (None, ""), ("HTTPS://A", ""), (" https://a", "")], S.https_only("u"))


def test_operation_id(spark):
    check(spark, "o string", [
    ("2388220-1", True), ("a_b.c", True), ("año-1", True), ("../../x", False), ("a b", False),
    ("", False), (None, False)], S.operation_id_is_valid("o"))


def test_title(spark):
    check(spark, "t string", [
    ("Elecciones Generales 2026", True), ("ELECCIÓN GENERALES 20 26", True), ("elección general 2026", False), ("datos EG2026", True),
    ("eg 2026.", True), ("beg2026", False), ("Resultados de la primera vuelta 2026", True),
    ("Resultado 2026", False), ("Senadores  2026", True), ("diputado 2026", True),
    ("Elecciones Generales 2021", False), ("presidenciales 2026", True), (None, False)], S.title_matches("t"))


def test_outcome_invariant(spark):
    check(spark, "s string, e string", [
        ("downloaded", None, True), ("skipped_existing", None, True), ("failed", "timeout", True),
        ("failed", None, False), ("downloaded", "x", False), ("other", None, False),
        (None, None, False)], S.outcome_is_consistent("s", "e"))


def test_file_ids(spark):
    good = "69dce34ad7b6147f63e6fe04"
    check(spark, "i string", [
        (good, True), ("ABCDEFabcdef012345678901", True), ("../etc/passwd", False), ("abc", False),
        (good[:-1], False), (good + "\n", False)], S.file_id_is_valid("i"))
    check(spark, "i string", [(good, f"p/69/dc/{good}.pdf"), ("abc", "p/abc.pdf")],
          S.sharded_path("p", "i"))


def test_freshness(spark):
    check(spark, "m double", [
    (0.0, "pass"), (-59.9, "pass"), (60.0, "warn"), (-239.0, "warn"), (240.0, "fail"),
    (None, "no data")], S.freshness_class("m"))


def test_turnout_class(spark):
    check(spark, "p double", [
    (80.0, "ge_80"), (79.99, "ge_75"), (70.0, "ge_70"), (65.0, "ge_65"), (60.0, "ge_60"),
    (50.0, "ge_50"), (49.9, "lt_50"), (0.0, "lt_50")], S.turnout_class("p"))


def test_party_color(spark):
    names = [("FUERZA POPULAR",), ("ACCIÓN POPULAR Y MÁS",), ("s/d",), (None,)]
    got = values(spark, "n string", names, S.party_color("n"))
    assert got == ["#ff6b35", "#d62828", "#95a5a6", "#95a5a6"]


def test_severity_rank(spark):
    got = values(spark, "s string", [("CRITICAL",), ("HIGH",), ("MEDIUM",), ("x",), (None,)],
                 S.severity_rank("s"))
    assert got == [0, 1, 2, 99, 99]


def test_feature_ids(spark):
    rows = [("0401", None, None), (None, "40112", None), (None, None, "140000"), (None, "", None)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = [[r[0] for r in df.select(S.feature_id("a", "b", "c", level)).collect()]
           for level in ("department", "province", "district")]
    assert got == [["0401", "40112", "140000", ""], ["040100", "40112", "140000", ""],
                   ["0401", "040112", "140000", ""]]


def test_message_is_null_if_a_value_is(spark):
    got = values(spark, "a bigint, b double", [(1, 66.7), (None, 1.0)],
                 S.message("a=", F.col("a"), " b=", F.col("b")))
    assert got == ["a=1 b=66.7", None]


def test_strict_number(spark):
    assert values(spark, "c string", [("00000014",), (None,)], S.strict_number("c")) == [14, None]
    with pytest.raises(PySparkException, match="not a number"):
        values(spark, "c string", [("1x",)], S.strict_number("c"))
