"""Data-quality checks in four levels.

A check is a frame with one row per check: ``level, check, passed, skipped, detail``.
Checks over the same table share one pass: ``header_cube``, ``votes_audit``,
``station_audit`` and ``election_audit`` each read their table once and reduce it to a
few rows, from which the rows of all checks that need it are made. Nothing runs until
the report is used, and no figure passes through Python.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutiny import contracts as c
from scrutiny.functions.aggregates import (
    all_true,
    distinct_values,
    is_single_valued,
    total,
    total_where,
)
from scrutiny.functions.scalars import (
    drift_minutes,
    freshness_class,
    message,
    place_number,
    regional_tolerance,
    relative_drift_pct,
    strict_number,
)
from scrutiny.operators.contract_checks import require_columns
from scrutiny.operators.ranking import share_of_all, top
from scrutiny.operators.unions import union_all
from scrutiny.operators.versions import last_record, last_snapshot
from scrutiny.session import scratch_path



_FIGURES = ("totalVotosEmitidos", "totalVotosValidos", "totalElectoresHabiles")


def _counted() -> Column:
    return F.col("codigoEstadoActa") == c.STATE_COUNTED


def _check(level: int, name: str, passed: Column, detail: Column,
           skipped: bool = False) -> Column:
    return F.struct(
        F.lit(level).cast("bigint").alias("level"),
        F.lit(name).alias("check"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        F.lit(skipped).alias("skipped"),
        F.coalesce(detail, F.lit("")).alias("detail"),
    )


def _rows(one_row: DataFrame, *checks: Column) -> DataFrame:
    """The given checks of a one-row frame, one row each."""
    return one_row.select(F.inline(F.array(*checks)))


def _fields(*names: str) -> Column:
    parts: list[Column | str] = []
    for i, name in enumerate(names):
        parts += [("" if i == 0 else " ") + name + "=", F.col(name)]
    return message(*parts)


# --- audits: one pass per table -----------------------------------------------


def header_cube(header: DataFrame) -> DataFrame:
    """The header added up by election, state, department, electoral district and scope.

    A few thousand rows at most, whatever the number of actas, combined map-side: all
    counts and sums the checks need come from here, so the header is read once for them.
    """
    emitted, valid = F.col("totalVotosEmitidos"), F.col("totalVotosValidos")
    roll = F.col("totalElectoresHabiles")
    tests = {
        "emit_neg": emitted < 0,
        "val_neg": valid < 0,
        "hab_le_0": roll <= 0,
        "emit_gt_hab": emitted > roll,
        "val_gt_emit": valid > emitted,
    }
    wide = header
    for name in ("idDistritoElectoral", "idAmbitoGeografico", *_FIGURES):
        if name not in header.columns:
            wide = wide.withColumn(name, F.lit(None).cast("bigint"))
    return wide.groupBy(
        "idEleccion", "codigoEstadoActa", F.substring("ubigeoDistrito", 1, 2).alias("dep"),
        "idDistritoElectoral", "idAmbitoGeografico",
    ).agg(
        F.count(F.lit(1)).alias("n"),
        total("totalVotosEmitidos").alias("emit"),
        total("totalVotosValidos").alias("val"),
        *[F.count_if(test).alias(name) for name, test in tests.items()],
    )


def votes_per_acta(votes: DataFrame) -> DataFrame:
    """Rows, all votes and party votes of each acta and election."""
    return votes.groupBy("idActa", "idEleccion").agg(
        F.count(F.lit(1)).alias("n"),
        total("nvotos").alias("sum_tot"),
        total_where(~F.col("es_especial"), "nvotos").alias("sum_val"),
    )


#: Which grouping set a row of ``acta_cube`` belongs to.
_BY_ACTA, _BY_PARTY = "acta", "party"


def acta_cube(votes: DataFrame) -> DataFrame:
    """The votes added up by acta and by party in one pass: grouping sets over one scan.

    Rows ``level = 'acta'`` are those of ``votes_per_acta``, rows ``'party'`` the party votes of
    each election. Both sets are combined map-side before the one shuffle.
    """
    by_acta, by_party = ["idActa", "idEleccion"], ["idEleccion", "nagrupacionPolitica"]
    keys = ["idActa", "idEleccion", "nagrupacionPolitica"]
    return votes.groupingSets(
        [[F.col(k) for k in by_acta], [F.col(k) for k in by_party]], *[F.col(k) for k in keys]
    ).agg(
        F.when(F.grouping("idActa") == 0, F.lit(_BY_ACTA)).otherwise(F.lit(_BY_PARTY)).alias("level"),
        F.count(F.lit(1)).alias("n"),
        total("nvotos").alias("sum_tot"),
        total_where(~F.col("es_especial"), "nvotos").alias("sum_val"),
        F.count_if(~F.col("es_especial")).alias("n_party"),
    )


def place_cube(votes: DataFrame, header: DataFrame) -> DataFrame:
    """Party votes of actas that have a header, by election, place, electoral district and party.

    One join with the header serves the district check and the reconciliation. ``weight`` is
    1 for one header row of each acta, so that an acta with several rows counts once where
    only its presence matters and once a row where its district does.
    """
    places = header.groupBy("idActa", "idDistritoElectoral").agg(F.count(F.lit(1)).alias("_rows"))
    first = header.groupBy("idActa").agg(F.min(F.struct("idDistritoElectoral")).alias("_first"))
    places = places.join(first, "idActa").select(
        "idActa", "idDistritoElectoral", "_rows",
        F.when(F.struct("idDistritoElectoral").eqNullSafe(F.col("_first")), 1).otherwise(0).alias("_once"))
    return (
        votes.filter(~F.col("es_especial")).join(places, "idActa")
        .groupBy("idEleccion", "ubigeoDistrito", "idDistritoElectoral", "nagrupacionPolitica", "ccodigo")
        .agg(F.sum(F.col("nvotos") * F.col("_rows")).alias("by_row"),
             F.sum(F.col("nvotos") * F.col("_once")).alias("by_acta"))
    )


def _stored(cube: DataFrame, label: str) -> DataFrame:
    """A cube written to the shared folder: checks prune it differently, so only a stored one is
    computed once, and nothing stays in the executors' memory."""
    path = scratch_path(cube.sparkSession, label)
    cube.write.option("compression", "zstd").parquet(path)
    return cube.sparkSession.read.schema(cube.schema).parquet(path)


def detail_histogram(votes: DataFrame) -> DataFrame:
    """How many actas have how many detail rows."""
    per_acta = votes.groupBy("idActa", "idEleccion").agg(F.count(F.lit(1)).alias("n"))
    return per_acta.groupBy("n").agg(F.count(F.lit(1)).alias("actas")).orderBy("n")


def votes_audit(votes: DataFrame, header: DataFrame, cube: DataFrame | None = None) -> DataFrame:
    """One row: detail rows per acta, and accounting identities on counted actas.

    ``cube`` may pass in an ``acta_cube`` that is shared by checks.
    """
    counted = header.filter(F.col("codigoEstadoActa") == c.STATE_COUNTED).select(
        "idActa", "idEleccion", "totalVotosEmitidos", "totalVotosValidos",
        F.lit(True).alias("_counted"),
    )
    per_acta = votes_per_acta(votes) if cube is None else cube.filter(F.col("level") == _BY_ACTA)
    joined = per_acta.join(counted, ["idActa", "idEleccion"], "left")
    return joined.agg(
        F.min("n").alias("min_rows"),
        F.max("n").alias("max_rows"),
        F.count("_counted").alias("total_con_detalle"),
        F.count_if(F.col("sum_tot") != F.col("totalVotosEmitidos")).alias("mismatch_emit"),
        F.count_if(F.col("sum_val") != F.col("totalVotosValidos")).alias("mismatch_val"),
    )


def station_audit(header: DataFrame) -> DataFrame:
    """One row: stations, and whether all have five elections, one roll, one district."""
    per_station = header.groupBy("codigoMesa").agg(
        distinct_values("idEleccion").alias("elec"),
        is_single_valued("totalElectoresHabiles").alias("one_roll"),
        is_single_valued("ubigeoDistrito").alias("one_district"),
    )
    return per_station.agg(
        F.count(F.lit(1)).alias("mesas"),
        all_true((F.col("elec") == 5) & F.col("one_roll") & F.col("one_district")).alias("ok"),
    )


def election_audit(header: DataFrame) -> DataFrame:
    """Per election: rows and distinct actas."""
    return header.groupBy("idEleccion").agg(
        distinct_values("idActa").alias("u"), F.count(F.lit(1)).alias("n")
    )


# --- level 1 ------------------------------------------------------------------


def check_universe(header: DataFrame) -> DataFrame:
    one = election_audit(header).agg(
        F.count(F.lit(1)).alias("elections"),
        all_true(F.col("u") == F.col("n")).alias("unique"),
        F.min("n").alias("min_rows"), F.max("n").alias("max_rows"),
    )
    return _rows(one, _check(
        1, "universe_by_election", F.col("unique") & (F.col("min_rows") == F.col("max_rows")),
        _fields("elections", "min_rows", "max_rows"),
    ))


def check_votes(votes: DataFrame, header: DataFrame, cube: DataFrame | None = None) -> DataFrame:
    """Detail cardinality and accounting identities (exact, on counted actas)."""
    return _rows(
        votes_audit(votes, header, cube),
        _check(1, "detail_rows_per_acta",
               (F.col("min_rows") == c.DETAIL_ROWS_PER_ACTA)
               & (F.col("max_rows") == c.DETAIL_ROWS_PER_ACTA),
               _fields("min_rows", "max_rows")),
        _check(1, "accounting_identities",
               (F.col("mismatch_emit") == 0) & (F.col("mismatch_val") == 0),
               _fields("total_con_detalle", "mismatch_emit", "mismatch_val")),
    )


def check_header(header: DataFrame, levels: Iterable[int] = (1, 3),
                 cube: DataFrame | None = None) -> DataFrame:
    """Ranges and signs (level 1), scope coherence and universe abroad (level 3).

    Here and below, ``cube`` may pass in a ``header_cube`` that is shared by checks.
    """
    levels = set(levels)
    if 3 in levels:
        require_enriched(header)
    ranges = ("emit_neg", "val_neg", "hab_le_0", "emit_gt_hab", "val_gt_emit")
    coherent = ("de27_no_ext", "ext_no_de27", "nulls")
    district, scope = F.col("idDistritoElectoral"), F.col("idAmbitoGeografico")
    one = (header_cube(header) if cube is None else cube).agg(
        *[total_where(_counted(), name).alias(name) for name in ranges],
        total_where((district == c.ABROAD_DISTRICT) & (scope != c.SCOPE_ABROAD), "n")
        .alias("de27_no_ext"),
        total_where((scope == c.SCOPE_ABROAD) & (district != c.ABROAD_DISTRICT), "n")
        .alias("ext_no_de27"),
        total_where(district.isNull() | scope.isNull(), "n").alias("nulls"),
        total_where((district == c.ABROAD_DISTRICT)
                    & (F.col("idEleccion") == c.ELECTION_SENATE_NATIONAL), "n")
        .alias("abroad_actas"),
    )

    def all_zero(names: Iterable[str]) -> Column:
        return reduce(and_, [F.col(n) == 0 for n in names])

    checks = []
    if 1 in levels:
        checks.append(_check(1, "ranges_and_signs", all_zero(ranges), _fields(*ranges)))
    if 3 in levels:
        checks += [
            _check(3, "scope_matches_district", all_zero(coherent), _fields(*coherent)),
            _check(3, "universe_abroad", F.col("abroad_actas") == c.ABROAD_UNIVERSE,
                   _fields("abroad_actas")),
        ]
    return _rows(one, *checks)


def check_stations(header: DataFrame, station_totals: DataFrame | None = None,
                   levels: Iterable[int] = (1, 2)) -> DataFrame:
    """Coherence of every station's roll (level 1), and their number (level 2).

    The second check compares with the official station totals and needs them.
    """
    levels = set(levels)
    one = station_audit(header)
    checks = []
    if 1 in levels:
        checks.append(_check(1, "roll_coherent_by_station", F.col("ok"), _fields("mesas")))
    if 2 in levels and station_totals is not None:
        official = last_snapshot(station_totals).select(F.max(
            F.col("mesasInstaladas") + F.col("mesasPendientes") + F.col("mesasNoInstaladas")))
        one = one.withColumns({"oficial": official.scalar(), "curated": F.col("mesas")})
        checks.append(_check(2, "station_universe", F.col("oficial") == F.col("curated"),
                             _fields("oficial", "curated")))
    return _rows(one, *checks)


# --- level 2: against official aggregates -------------------------------------


def freshness(header: DataFrame, totals: DataFrame) -> DataFrame:
    """One row: minutes between the curated data and the aggregates, and its class."""
    official = totals.select(F.max("snapshot_ts_ms").alias("ts"))
    return (
        header.agg(F.max("snapshot_ts_ms").alias("curated_ts"))
        .withColumn("official_ts", official.scalar())
        .withColumn("drift_min", drift_minutes(F.col("curated_ts"), F.col("official_ts")))
        .withColumn("freshness", freshness_class("drift_min"))
    )


def check_actas_by_election(header: DataFrame, totals: DataFrame,
                            cube: DataFrame | None = None) -> DataFrame:
    official = last_snapshot(totals).select("idEleccion", F.col("totalActas").alias("ofi_tot"))
    counted = (header_cube(header) if cube is None else cube).groupBy("idEleccion").agg(
        F.sum("n").alias("cur_tot"))
    one = official.join(counted, "idEleccion", "inner").agg(
        F.count(F.lit(1)).alias("elections"),
        all_true(F.col("ofi_tot") == F.col("cur_tot")).alias("same"),
    )
    return _rows(one, _check(2, "actas_by_election", F.col("same"), _fields("elections")))


def check_presidential_votes(header: DataFrame, totals: DataFrame,
                             cube: DataFrame | None = None) -> DataFrame:
    """Emitted and valid presidential votes within 0.1 % of the official figures."""
    presidential = F.col("idEleccion") == c.ELECTION_PRESIDENT
    official = last_snapshot(totals).filter(presidential).agg(
        F.struct(F.max("totalVotosEmitidos").alias("e"), F.max("totalVotosValidos").alias("v"))
        .alias("o")
    )
    one = (
        (header_cube(header) if cube is None else cube)
        .filter(presidential & _counted())
        .agg(total("emit").alias("emit_cur"), total("val").alias("val_cur"))
        .withColumn("o", official.scalar())
        .select(
            F.col("o.e").alias("emit_ofi"), F.col("o.v").alias("val_ofi"), "emit_cur", "val_cur"
        )
        .withColumn("emit_pct", relative_drift_pct(F.col("emit_ofi"), F.col("emit_cur")))
        .withColumn("val_pct", relative_drift_pct(F.col("val_ofi"), F.col("val_cur")))
    )
    return _rows(one, _check(
        2, "presidential_votes_drift", (F.col("emit_pct") <= 0.1) & (F.col("val_pct") <= 0.1),
        message("emit_ofi=", F.col("emit_ofi"), " val_ofi=", F.col("val_ofi"),
                " emit_cur=", F.col("emit_cur"), " val_cur=", F.col("val_cur"),
                " emit_pct=", F.round("emit_pct", 3), " val_pct=", F.round("val_pct", 3)),
    ))


def check_regions(header: DataFrame, heat_map: DataFrame,
                  cube: DataFrame | None = None) -> DataFrame:
    """Counted presidential actas per department against the official heat map."""
    presidential = F.col("idEleccion") == c.ELECTION_PRESIDENT
    official = last_snapshot(heat_map).filter(presidential).select(
        F.col("ubigeoNivel01").alias("ub01"), F.col("actasContabilizadas").alias("ofi_c")
    )
    counted = (
        (header_cube(header) if cube is None else cube)
        .filter(presidential & _counted())
        .groupBy(place_number("dep").alias("ub01")).agg(F.sum("n").alias("cur_c"))
    )
    matched = F.col("cur_c").isNotNull()
    one = official.join(counted, "ub01", "left").agg(
        F.count(F.lit(1)).alias("official"),
        F.count("cur_c").alias("matched"),
        F.coalesce(F.max(F.abs(F.col("cur_c") - F.col("ofi_c"))), F.lit(0)).alias("max_delta"),
        total_where(matched, "ofi_c").alias("ofi_total"),
    ).withColumn("tolerance", regional_tolerance(F.col("ofi_total"), F.col("matched")))
    return _rows(one, _check(
        2, "regions_presidential",
        (F.col("max_delta") <= F.col("tolerance")) & (F.col("matched") == F.col("official")),
        _fields("matched", "max_delta", "tolerance"),
    ))


def check_parties(votes: DataFrame, parties: DataFrame,
                  cube: DataFrame | None = None) -> DataFrame:
    """Every official presidential party found, and total drift within 0.5 %.

    ``cube`` may pass in an ``acta_cube``.
    """
    presidential = F.col("idEleccion") == c.ELECTION_PRESIDENT
    official = last_snapshot(parties).filter(presidential).select(
        strict_number("codigoAgrupacionPolitica").alias("cod"),
        F.col("totalVotosValidos").alias("ofi_val"),
    )
    if cube is None:
        counted = (
            votes.filter(~F.col("es_especial") & presidential)
            .groupBy(F.col("nagrupacionPolitica").alias("cod"))
            .agg(total("nvotos").alias("cur_val"))
        )
    else:
        counted = cube.filter(
            (F.col("level") == _BY_PARTY) & presidential & (F.col("n_party") > 0)
        ).select(F.col("nagrupacionPolitica").alias("cod"), F.col("sum_val").alias("cur_val"))
    one = official.join(counted, "cod", "left").agg(
        F.count(F.lit(1)).alias("official"),
        F.count("cur_val").alias("matched"),
        total_where(F.col("cur_val").isNotNull(), "ofi_val").alias("ofi_total"),
        total(F.abs(F.col("cur_val") - F.col("ofi_val"))).alias("delta"),
    ).withColumn("drift_pct",
                 F.col("delta") / F.greatest(F.col("ofi_total"), F.lit(1)) * F.lit(100.0))
    return _rows(one, _check(
        2, "parties_presidential",
        (F.col("matched") == F.col("official")) & (F.col("drift_pct") <= 0.5),
        message("matched=", F.col("matched"), "/", F.col("official"),
                " drift_pct=", F.round("drift_pct", 3)),
    ))


# --- level 3: by electoral district -------------------------------------------


def require_enriched(header: DataFrame) -> DataFrame:
    return require_columns(header, ("idDistritoElectoral", "idAmbitoGeografico"),
                           "enrich the header before level 3")


def check_district_totals(header: DataFrame, district_totals: DataFrame,
                          cube: DataFrame | None = None) -> DataFrame:
    """Deputies: official actas per electoral district equal the curated ones."""
    deputies = F.col("idEleccion") == c.ELECTION_DEPUTIES
    official = last_record(
        district_totals.filter(deputies).select(
            "idDistritoElectoral", "snapshot_ts_ms", F.col("totalActas").alias("ofi_total")
        ),
        ["idDistritoElectoral"],
    )
    counted = (header_cube(header) if cube is None else cube).filter(deputies).groupBy(
        "idDistritoElectoral").agg(F.sum("n").alias("cur_total"))
    one = official.join(counted, "idDistritoElectoral", "left").agg(
        F.count(F.lit(1)).alias("official"),
        F.count("cur_total").alias("matched"),
        F.coalesce(F.max(F.abs(F.col("cur_total") - F.col("ofi_total"))), F.lit(0))
        .alias("max_delta"),
    )
    return _rows(one, _check(
        3, "district_totals_deputies",
        (F.col("max_delta") == 0) & (F.col("matched") == F.col("official")),
        message("matched=", F.col("matched"), "/", F.col("official"),
                " max_delta=", F.col("max_delta")),
    ))


def party_drift_by_district(votes: DataFrame, header: DataFrame, district_parties: DataFrame,
                            cube: DataFrame | None = None) -> DataFrame:
    """Per electoral district (deputies): official pairs, matched ones, relative drift.

    ``cube`` may pass in a ``place_cube``.
    """
    deputies = F.col("idEleccion") == c.ELECTION_DEPUTIES
    official = last_record(
        district_parties.filter(deputies).select(
            F.col("idDistritoElectoral").alias("de"),
            strict_number("codigoAgrupacionPolitica").alias("cod"),
            "snapshot_ts_ms", F.col("totalVotosValidos").alias("ofi_val"),
        ),
        ["de", "cod"],
    )
    if cube is None:
        rows = (
            votes.filter(~F.col("es_especial") & deputies)
            .join(header.select("idActa", "idDistritoElectoral"), "idActa", "inner")
            .withColumn("by_row", F.col("nvotos"))
        )
    else:
        rows = cube.filter(deputies)
    counted = rows.groupBy(
        F.col("idDistritoElectoral").alias("de"), F.col("nagrupacionPolitica").alias("cod")
    ).agg(total("by_row").alias("cur_val"))
    delta = F.abs(F.col("cur_val") - F.col("ofi_val"))
    matched = F.col("cur_val").isNotNull()
    return official.join(counted, ["de", "cod"], "left").groupBy("de").agg(
        F.count(F.lit(1)).alias("official"),
        F.count("cur_val").alias("matched"),
        F.coalesce(F.max(delta), F.lit(0)).alias("max_delta"),
        total(delta).alias("abs_delta"),
        total_where(matched, "ofi_val").alias("total"),
    ).withColumn(
        "ratio",
        F.col("abs_delta") / F.when(F.col("total") > 0, F.col("total")).otherwise(F.lit(1)),
    )


def check_district_parties(votes: DataFrame, header: DataFrame, district_parties: DataFrame,
                           cube: DataFrame | None = None) -> DataFrame:
    """Deputies: all official (district, party) pairs found, drift within 5 %."""
    one = party_drift_by_district(votes, header, district_parties, cube).agg(
        total("official").alias("official"), total("matched").alias("matched"),
        F.coalesce(F.max("max_delta"), F.lit(0)).alias("max_delta"),
        (F.coalesce(F.max("ratio"), F.lit(0.0)) * F.lit(100.0)).alias("max_drift"),
    )
    return _rows(one, _check(
        3, "district_parties_deputies",
        (F.col("matched") == F.col("official")) & (F.col("max_drift") <= 5.0),
        message("matched=", F.col("matched"), "/", F.col("official"),
                " max_delta=", F.col("max_delta"), " max_drift=", F.round("max_drift", 2)),
    ))


# --- level 4: against the official publication --------------------------------


def check_official_available(header: DataFrame, official: DataFrame | None) -> DataFrame:
    """Whether the official publication is there; not being there yet fails nothing."""
    one = header.sparkSession.range(1)
    there = official is not None
    return _rows(one, _check(
        4, "official_available", F.lit(there),
        F.lit("available" if there else "not published yet"), skipped=not there,
    ))


def reconcile_with_official(votes: DataFrame, header: DataFrame, official: DataFrame,
                            cube: DataFrame | None = None) -> DataFrame:
    """Votes by election, district and party on both sides, and their difference.

    ``official`` has ``idEleccion, ubigeoDistrito, ccodigo, votos``. Places on one side
    only count as zero votes on the other.
    """
    keys = ["idEleccion", "ubigeoDistrito", "ccodigo"]
    if cube is None:
        rows = votes.filter(~F.col("es_especial")).join(
            header.select("idActa"), "idActa", "left_semi").withColumn("by_acta", F.col("nvotos"))
    else:
        rows = cube
    ours = rows.groupBy(*keys).agg(total("by_acta").alias("cur"))
    theirs = official.groupBy(*keys).agg(total("votos").alias("ofi"))
    return ours.join(theirs, keys, "full_outer").select(
        *keys, F.coalesce("cur", F.lit(0)).alias("cur"), F.coalesce("ofi", F.lit(0)).alias("ofi")
    ).withColumn("delta", F.abs(F.col("cur") - F.col("ofi")))


def check_reconciliation(votes: DataFrame, header: DataFrame, official: DataFrame | None,
                         cube: DataFrame | None = None) -> DataFrame:
    """Every group within one vote; skipped while there is nothing to compare with."""
    if official is None:
        return _rows(header.sparkSession.range(1), _check(
            4, "reconciliation", F.lit(False), F.lit("no official data"), skipped=True))
    one = reconcile_with_official(votes, header, official, cube).agg(
        F.count(F.lit(1)).alias("groups"),
        F.count_if(F.col("delta") > c.SUM_TOLERANCE).alias("beyond"),
        F.coalesce(F.max("delta"), F.lit(0)).alias("max_delta"),
    )
    return _rows(one, _check(4, "reconciliation", F.col("beyond") == 0,
                             _fields("groups", "beyond", "max_delta")))


# --- report -------------------------------------------------------------------


def report(header: DataFrame, votes: DataFrame, aggregates: Mapping[str, DataFrame] | None = None,
           official: DataFrame | None = None, level: int = 0) -> DataFrame:
    """All checks of a level (0: all levels), with PASS, FAIL or SKIP.

    ``aggregates`` holds the official series by table name; without it, levels 2 and 3
    run only what needs none. The votes are scanned twice at most, once for each cube; the
    cubes are stored, and the checks read only those.
    """
    agg = aggregates or {}
    levels = [n for n in (1, 2, 3, 4) if level in (0, n)]
    # Small by construction (see header_cube) and read by up to six checks.
    cube = _stored(header_cube(header), "dq-header")
    acta = place = None
    if 1 in levels or (2 in levels and "participantes" in agg):
        acta = _stored(acta_cube(votes), "dq-actas")
    if (3 in levels and "participantes_de" in agg) or (4 in levels and official is not None):
        wide = header if "idDistritoElectoral" in header.columns else header.withColumn(
            "idDistritoElectoral", F.lit(None).cast("bigint"))
        place = _stored(place_cube(votes, wide), "dq-places")

    parts: list[DataFrame] = []
    if 1 in levels:
        parts += [check_universe(header), check_votes(votes, header, acta)]
    if 1 in levels or (2 in levels and "mesa_totales" in agg):
        parts.append(check_stations(header, agg.get("mesa_totales"), levels))
    if 1 in levels or 3 in levels:
        parts.append(check_header(header, levels, cube))
    if 2 in levels:
        if "totales" in agg:
            parts += [check_actas_by_election(header, agg["totales"], cube),
                      check_presidential_votes(header, agg["totales"], cube)]
        if "mapa_calor" in agg:
            parts.append(check_regions(header, agg["mapa_calor"], cube))
        if "participantes" in agg:
            parts.append(check_parties(votes, agg["participantes"], acta))
    if 3 in levels:
        if "totales_de" in agg:
            parts.append(check_district_totals(header, agg["totales_de"], cube))
        if "participantes_de" in agg:
            parts.append(check_district_parties(votes, header, agg["participantes_de"], place))
    if 4 in levels:
        parts += [check_official_available(header, official),
                  check_reconciliation(votes, header, official, place)]
    return union_all(parts).withColumn(
        "result",
        F.when(F.col("skipped"), F.lit("SKIP")).when(F.col("passed"), F.lit("PASS"))
        .otherwise(F.lit("FAIL")),
    )


def report_totals(checks: DataFrame) -> DataFrame:
    """One row: checks passed, failed, skipped and their number."""
    return checks.agg(
        *[F.count_if(F.col("result") == r).alias(r.lower()) for r in ("PASS", "FAIL", "SKIP")],
        F.count(F.lit(1)).alias("total"),
    )


# --- actas without detail -----------------------------------------------------


def counted_without_detail(header: DataFrame, votes: DataFrame) -> DataFrame:
    """Counted actas for which there is not one vote row."""
    return (
        header.filter(F.col("codigoEstadoActa") == c.STATE_COUNTED)
        .join(votes.select("idActa").distinct(), "idActa", "left_anti")
        .select("idActa", "codigoMesa", "ubigeoDistrito", "idEleccion", "estadoActa")
    )


def without_detail_distribution(missing: DataFrame) -> DataFrame:
    """Their number by election and by state, as one long frame.

    One pass: counted per pair first, then split by dimension.
    """
    pairs = missing.groupBy("idEleccion", "estadoActa").agg(F.count(F.lit(1)).alias("n"))
    both = F.explode(F.array(
        F.struct(F.lit("idEleccion").alias("dimension"),
                 F.col("idEleccion").cast("string").alias("value")),
        F.struct(F.lit("estadoActa").alias("dimension"), F.col("estadoActa").alias("value")),
    ))
    return (
        pairs.select(both.alias("p"), "n").groupBy("p.dimension", "p.value")
        .agg(F.sum("n").alias("n"))
    )


def classify_reread(missing: DataFrame, documents: DataFrame) -> DataFrame:
    """What became of actas without detail once they were read again.

    ``documents`` are the documents read again, by ``req_acta_id``; an acta whose
    document is not there, or could not be read, is an error.
    """
    again = documents.select(
        F.col("req_acta_id").alias("idActa"),
        F.col("parsed").alias("_read"),
        F.coalesce(F.size("detalle"), F.lit(0)).alias("_n"),
        F.col("codigoEstadoActa").alias("now_codigoEstadoActa"),
        F.col("estadoActa").alias("now_estadoActa"),
        "descripcionSubEstadoActa",
    )
    n_detail = F.greatest(F.coalesce("_n", F.lit(0)), F.lit(0)).cast("bigint")
    return missing.join(again, "idActa", "left").select(
        "idActa", "codigoMesa", "ubigeoDistrito", "idEleccion",
        F.coalesce("estadoActa", F.lit("")).alias("prev_estadoActa"),
        F.when(~F.coalesce("_read", F.lit(False)), F.lit("error"))
        .when(n_detail > 0, F.lit("resolved"))
        .when((F.col("now_codigoEstadoActa") == "C") & (F.col("now_estadoActa") == "N"),
              F.lit("mesa_no_instalada"))
        .otherwise(F.lit("other")).alias("bucket"),
        "now_codigoEstadoActa", "now_estadoActa", n_detail.alias("n_detalle"),
        "descripcionSubEstadoActa",
    )


def reread_verdict(classified: DataFrame) -> DataFrame:
    """Actas per bucket with their share; ``explained`` once 90 % never were installed."""
    counts = classified.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    return share_of_all(counts, "n", "pct").withColumn(
        "explained", (F.col("bucket") == "mesa_no_instalada") & (F.col("pct") >= 90.0)
    )


# --- scope segregation --------------------------------------------------------


def scope_segregation(dims: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per dimension: all, at home, abroad (null where it has no scope column)."""
    parts = []
    for name, df in dims.items():
        if "idAmbitoGeografico" in df.columns:
            home = F.count_if(F.col("idAmbitoGeografico") == c.SCOPE_HOME)
            abroad = F.count_if(F.col("idAmbitoGeografico") == c.SCOPE_ABROAD)
        else:
            home = abroad = F.max(F.lit(None).cast("bigint"))
        parts.append(df.agg(
            F.count(F.lit(1)).alias("total"), home.alias("peru"), abroad.alias("exterior")
        ).select(F.lit(name).alias("tabla"), "total", "peru", "exterior"))
    return union_all(parts)


def top_cities_abroad(stations: DataFrame, k: int = 5) -> DataFrame:
    counts = (
        stations.filter(F.col("idAmbitoGeografico") == c.SCOPE_ABROAD)
        .groupBy("ubigeoDistrito", "nombreDistrito").agg(F.count(F.lit(1)).alias("n"))
    )
    return top(counts, [F.col("n").desc(), F.col("ubigeoDistrito").asc(),
                        F.col("nombreDistrito").asc()], k)
