"""Official catalogue and resolutions: monitor, classify, merge with the registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutiny.functions.scalars import (
    compact_date_to_iso,
    https_only,
    institution_of,
    operation_id_is_valid,
    title_matches,
)
from scrutiny.operators.keys import not_in
from scrutiny.operators.ranking import top
from scrutiny.sinks.tables import grouped_summary
from scrutiny.sources.pages import embedded_json

# --- catalogue monitor --------------------------------------------------------


def new_entries(entries: DataFrame, previous: DataFrame) -> DataFrame:
    """Entries whose address the previous catalogue did not have."""
    return not_in(entries, previous, "url")


def matching_entries(entries: DataFrame) -> DataFrame:
    """Entries whose title announces the election's results."""
    return entries.filter(title_matches("title"))


def alert(entries: DataFrame, key: str = "page_id") -> DataFrame:
    """The first matching entry in catalogue order; no row if there is none."""
    return top(matching_entries(entries), [F.col(key).asc(), F.col("position").asc()], 1)


def monitor(entries: DataFrame, previous: DataFrame, key: str = "page_id") -> DataFrame:
    """New entries, each with whether it announces the results."""
    return new_entries(entries, previous).withColumn("matches", title_matches("title"))


# --- resolutions --------------------------------------------------------------

_RECORD = (
    "struct<fechaPublicacion:string,tipoDispositivo:string,nombreDispositivo:string,"
    "sumilla:string,urlPDF:string,sector:string,rubro:string,institucion:string>"
)


def fetched_records(pages: DataFrame, html: str = "html", op: str = "op") -> DataFrame:
    """The record embedded in each resolution's page; null where there is none."""
    invalid = F.raise_error(F.concat(F.lit("invalid operation id: "), F.col(op))).cast("string")
    return pages.select(
        F.when(operation_id_is_valid(op), F.col(op)).otherwise(invalid).alias("op"),
        F.from_json(embedded_json(html), _RECORD).alias("raw"),
    )


def _text(name: str) -> Column:
    """A field of the fetched record, null where empty."""
    return F.nullif(F.col(f"raw.{name}"), F.lit(""))


def _first(*values: Column) -> Column:
    return F.coalesce(*values, F.lit(""))


def resolutions(registry: DataFrame, fetched: DataFrame, base_url: str,
                process: str) -> DataFrame:
    """Registry entries completed by what was fetched: 14 columns.

    The fetched record wins field by field where it says something; an entry without a
    record keeps the registry's values and is flagged.
    """
    found = F.col("raw").isNotNull()
    name = _first(_text("nombreDispositivo"), F.col("nombre_dispositivo"))
    institution = _first(
        F.nullif(F.trim(F.col("raw.institucion")), F.lit("")),
        F.when(found, F.nullif(institution_of(name), F.lit(""))),
        F.col("institucion"),
    )
    joined = registry.join(fetched, "op", "left")
    return joined.select(
        F.col("op").alias("op_id"),
        _first(F.nullif(compact_date_to_iso("raw.fechaPublicacion"), F.lit("")),
               F.col("fecha_publicacion")).alias("fecha_publicacion"),
        institution.alias("institucion"),
        _first(_text("tipoDispositivo"), F.col("tipo_dispositivo")).alias("tipo_dispositivo"),
        name.alias("nombre_dispositivo"),
        _first(_text("sumilla"), F.col("sumilla")).alias("sumilla"),
        F.concat(F.lit(base_url + "/dispositivo/NL/"), F.col("op")).alias("url_html"),
        https_only("raw.urlPDF").alias("url_pdf"),
        _text("sector").alias("sector"),
        _text("rubro").alias("rubro"),
        F.coalesce("tag_proceso", F.lit(process)).alias("tag_proceso"),
        F.coalesce("tag_categoria", F.lit("")).alias("tag_categoria"),
        found.alias("url_ok"),
        F.coalesce("notas", F.lit("")).alias("notas"),
    )


def resolutions_summary(table: DataFrame) -> DataFrame:
    """Counts by institution, category and process, and of the fetched entries."""
    return grouped_summary(table, ["institucion", "tag_categoria", "tag_proceso", "url_ok"])
