from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from scrutiny.plans import catalogue
from scrutiny.sources import documents, pages

PAGE = """<html><ARTICLE class="node"><h2><a href="/dataset/uno">Elecciones <b>Generales</b> 2026 &amp; m&aacute;s</a></h2>
<span class="x Post-Date y"> 2026-04-18 </span></ARTICLE>
<article><p>no heading</p></article><article><h3>no link</h3><h4><a href="/z">z</a></h4></article>
<article><h4 id="q"><a class='c' href='https://else.where/dos'> Padrón </a></h4></article>
<a href="/files/a.CSV">Datos</a><a href="https://x.y/b.csv.gz"></a><a href="/c.pdf">c</a>
<a href="/d.zip?x=1">d</a><a class="data-link" href="/e.xlsx"><i>E</i> e</a></html>"""
BASE = "https://d.org"


def page(spark, html=PAGE):
    return spark.createDataFrame([(1, html)], "page_id bigint, html string")


def test_entries(spark):
    rows = pages.catalogue_entries(page(spark), BASE).orderBy("position").collect()
    assert [(r.position, r.title, r.url, r.raw_date) for r in rows] == [
        (0, "EleccionesGenerales2026 & más", "https://d.org/dataset/uno", "2026-04-18"),
        (3, "Padrón", "https://else.where/dos", "")]


def test_character_references(spark):
    import html

    texts = ["a &amp;lt; b", "&#243;&#xF3;&oacute;", "&nope; & &;", "&#38;lt;", "&#128512;!", "plain", "&quot;x&apos;",
             "x&nbsp;y", "&copy 2026", "&ampx &notit;", "&&amp;&"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in rows.select(pages.unescape(F.col("t"))).collect()] == [html.unescape(t) for t in texts]


def test_downloads(spark):
    rows = pages.download_links(page(spark), BASE).orderBy("position").collect()
    assert [(r.name, r.url, r.format) for r in rows] == [
        ("Datos", "https://d.org/files/a.CSV", "csv"), ("b.csv.gz", "https://x.y/b.csv.gz", "gz"),
        ("Ee", "https://d.org/e.xlsx", "xlsx")]


def test_attributes_as_browsers_read_them(spark):
    html = """<!-- <article><h2><a href="/no">commented out</a></h2></article> -->
    <article data-class="date"><h2><a title="a>b" data-href="/x" href=/uno.csv>Uno &copy 2026</a></h2>
    <p data-class="date">no</p><span id=q class='x date'>2026-<span>04</span>-18</span></article>
    <abbr href="/no.csv">x</abbr><a href = '/dos.zip' >Dos</a ><a data-x='href="/no.csv"' HREF=/tres.xlsx>Tres</a>"""
    rows = pages.catalogue_entries(page(spark, html), BASE).collect()
    assert [(r.title, r.url, r.raw_date) for r in rows] == [("Uno © 2026", "https://d.org/uno.csv", "2026-04-18")]
    found = pages.download_links(page(spark, html), BASE).orderBy("position").collect()
    assert [r.url for r in found] == [f"https://d.org/{n}" for n in ("uno.csv", "dos.zip", "tres.xlsx")]


def test_embedded_json(spark):
    def wrap(text):
        return f'<script id="__NEXT_DATA__" type="application/json">{text}</script>'

    good = json.dumps({"props": {"pageProps": {"dispositivo": {"sumilla": "s\nt"}}}})
    rows = spark.createDataFrame(
        [(wrap(good),), (wrap("{broken"),), (wrap('{"props":{}}'),), ("<html/>",)], "html string")
    got = [r[0] for r in rows.select(pages.embedded_json("html")).collect()]
    assert got == ['{"sumilla":"s\\nt"}', None, None, None]


def registry(spark, *entries):
    fields = ["op", "tag_proceso", "tag_categoria", "notas", "fecha_publicacion", "institucion",
              "tipo_dispositivo", "nombre_dispositivo", "sumilla"]
    rows = [tuple(e.get(f) for f in fields) for e in entries]
    return documents.registry_entries(
        spark.createDataFrame([(rows,)], f"resoluciones array<{documents.REGISTRY_ENTRY}>"))


def fetched(spark, **records):
    rows = [(op, '<script id="__NEXT_DATA__" type="application/json">' + json.dumps(
        {"props": {"pageProps": {"dispositivo": rec}}}) + "</script>") for op, rec in records.items()]
    return catalogue.fetched_records(spark.createDataFrame(rows, "op string, html string"))


def test_record_wins_over_registry(spark):
    entry = {"op": "a", "institucion": "JEE", "sumilla": "vieja", "fecha_publicacion": "2025-01-01",
             "tipo_dispositivo": "LEY", "nombre_dispositivo": "viejo", "tag_categoria": "otros"}
    rec = {"fechaPublicacion": "20250407", "nombreDispositivo": "N° 1-2025-JNE", "institucion": " ",
           "sumilla": "", "urlPDF": "http://x/y.pdf", "sector": "S", "rubro": ""}
    row = catalogue.resolutions(registry(spark, entry), fetched(spark, a=rec), "https://b", "P").first()
    assert row.asDict() == {
        "op_id": "a", "fecha_publicacion": "2025-04-07", "institucion": "JNE", "tipo_dispositivo": "LEY",
        "nombre_dispositivo": "N° 1-2025-JNE", "sumilla": "vieja", "url_html": "https://b/dispositivo/NL/a",
        "url_pdf": "", "sector": "S", "rubro": None, "tag_proceso": "P", "tag_categoria": "otros",
        "url_ok": True, "notas": ""}


def test_registry_alone(spark):
    row = catalogue.resolutions(registry(spark, {"op": "z", "nombre_dispositivo": "N° 1-JNE"}),
                                fetched(spark, a={}), "https://b", "P").first()
    assert (row.url_ok, row.institucion, row.nombre_dispositivo, row.sector, row.url_pdf) == (
        False, "", "N° 1-JNE", None, "")


def test_contract_errors(spark):
    with pytest.raises(PySparkException, match="without 'op'"):
        registry(spark, {"notas": "x"}).collect()
    with pytest.raises(PySparkException, match="invalid operation"):
        fetched(spark, **{"../x": {}}).collect()


def test_monitor_and_alert(spark):
    entries = spark.createDataFrame(
        [(1, 0, "Padrón", "u1"), (1, 1, "Senadores 2026", "u2"), (2, 0, "Diputados 2026", "u3")],
        "page_id bigint, position bigint, title string, url string")
    previous = entries.filter("url = 'u2'")
    assert {(r.url, r.matches) for r in catalogue.monitor(entries, previous).collect()} == {
        ("u1", False), ("u3", True)}
    assert catalogue.alert(entries).first().url == "u2"
    assert catalogue.alert(previous.filter("false")).count() == 0


def test_feature_collections(spark, tmp_path):
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "id": "140000", "geometry": {"type": "Point", "coordinates": [1, 2]},
         "properties": {"ID": "1401", "name": "L"}}]}
    (tmp_path / "lima.json").write_text(json.dumps(doc))
    row = documents.with_feature_id(documents.read_features(spark, str(tmp_path)), "province").first()
    assert (row.source, row.feature_id, row.own_id) == ("lima", "140100", "140000")
    assert json.loads(row.geometry)["coordinates"] == [1, 2]
    assert not documents.feature_count_check(documents.read_features(spark, str(tmp_path))).first().passed
    (tmp_path / "bad.json").write_text('{"type": "Topology"}')
    with pytest.raises(PySparkException, match="FeatureCollection"):
        documents.read_features(spark, str(tmp_path)).collect()
