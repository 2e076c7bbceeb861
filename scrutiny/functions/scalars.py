"""Column functions: ids, codes, dates, classes and messages.

Every function takes columns and returns a column built from built-in expressions, so
all of them stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrutiny import contracts as c

_DAY_MS = 86_400_000
_LIMA_SHIFT_MS = c.LIMA_UTC_OFFSET_HOURS * 3_600_000


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- identifiers --------------------------------------------------------------


def acta_id(station: Column | str, ubigeo: Column | str, election: Column | str) -> Column:
    """Station, six-digit place code and two-digit election, read as one number.

    Arithmetic, because padding by text would cut stations of five or more digits.
    """
    return (
        _col(station).cast("bigint") * F.lit(100_000_000)
        + _col(ubigeo).cast("bigint") * F.lit(100)
        + _col(election).cast("bigint")
    )


def zero_fill(value: Column | str, width: int) -> Column:
    """Left-pad with zeros without ever shortening longer text."""
    text = _col(value).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def place_code(*candidates: Column | str) -> Column:
    """First non-null of several place columns, zero-filled to six; none raises."""
    found = F.coalesce(*[_col(x).cast("string") for x in candidates])
    return F.when(
        found.isNull(), F.raise_error(F.lit("row without a known place code")).cast("string")
    ).otherwise(zero_fill(found, 6))


def place_prefix(code: Column | str, level: str) -> Column:
    """Department (2 digits), province (4) or district (6) of a place code."""
    digits = {"department": 2, "province": 4, "district": 6}[level]
    return F.concat(F.substring(_col(code), 1, digits), F.lit("0" * (6 - digits)))


def place_number(code: Column | str) -> Column:
    """Department of a place code as the six-digit number official tables use."""
    return strict_number(F.substring(_col(code), 1, 2)) * F.lit(10_000)


def strict_number(code: Column | str) -> Column:
    """Padded code to number; text that is no number is an error, never null."""
    text = _col(code).cast("string")
    return F.when(
        text.isNotNull() & text.try_cast("bigint").isNull(),
        F.raise_error(F.concat(F.lit("not a number: "), text)).cast("bigint"),
    ).otherwise(text.try_cast("bigint"))


def shard_of(key: Column | str, shards: int) -> Column:
    """MD5 of the key's text, read as a 128-bit number, modulo ``shards``.

    The digest is reduced 32 bits at a time so that everything fits in a bigint.
    """
    if not 1 <= shards < 2**31:
        raise ValueError(f"shards must be between 1 and 2^31-1, got {shards}")
    digest = F.md5(_col(key).cast("string"))
    step = F.lit(2**32 % shards).cast("bigint")
    rest = F.lit(0).cast("bigint")
    for start in (1, 9, 17, 25):
        word = F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
        rest = (rest * step + word) % F.lit(shards).cast("bigint")
    return rest


def file_id_is_valid(file_id: Column | str) -> Column:
    """Exactly 24 hexadecimal characters."""
    return F.coalesce(_col(file_id).rlike(r"^[0-9a-fA-F]{24}\z"), F.lit(False))


def sharded_path(root: str, file_id: Column | str, suffix: str = ".pdf") -> Column:
    """``root/ab/cd/abcd….pdf``; ids shorter than four characters stay flat."""
    ident = _col(file_id)
    name = F.concat(ident, F.lit(suffix))
    return F.when(F.length(ident) < 4, F.concat(F.lit(root + "/"), name)).otherwise(
        F.concat(
            F.lit(root + "/"),
            F.substring(ident, 1, 2),
            F.lit("/"),
            F.substring(ident, 3, 2),
            F.lit("/"),
            name,
        )
    )


def content_hash(content: Column | str) -> Column:
    """Hexadecimal SHA-256."""
    return F.sha2(_col(content), 256)


# --- time ---------------------------------------------------------------------


def lima_date(ms: Column | str) -> Column:
    """Epoch milliseconds to the local date as ``YYYY-MM-DD`` text.

    Plain arithmetic on the fixed local offset: the answer does not depend on the time
    zone the session happens to use.
    """
    local = _col(ms).cast("bigint") + F.lit(_LIMA_SHIFT_MS)
    days = F.floor(local / F.lit(_DAY_MS)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days).cast("string")


def lima_iso(ms: Column | str) -> Column:
    """Epoch milliseconds to ISO-8601 local text; a fraction only when there is one."""
    source = _col(ms).cast("bigint")
    local = source + F.lit(_LIMA_SHIFT_MS)
    of_day = F.pmod(local, F.lit(_DAY_MS))

    def two(value: Column) -> Column:
        return F.lpad(value.cast("bigint").cast("string"), 2, "0")

    fraction = F.pmod(local, F.lit(1000))
    return F.concat(
        lima_date(source),
        F.lit("T"),
        two(F.floor(of_day / F.lit(3_600_000))),
        F.lit(":"),
        two(F.floor(of_day / F.lit(60_000)) % 60),
        F.lit(":"),
        two(F.floor(of_day / F.lit(1000)) % 60),
        F.when(fraction == 0, F.lit("")).otherwise(
            F.concat(F.lit("."), F.lpad(fraction.cast("string"), 3, "0"), F.lit("000"))
        ),
        F.lit(f"-{abs(c.LIMA_UTC_OFFSET_HOURS):02d}:00"),
    )


def compact_date_to_iso(raw: Column | str) -> Column:
    """``YYYYMMDD`` to ISO text; anything that is not eight digits gives ``""``."""
    text = _col(raw)
    return F.when(
        text.rlike(r"^[0-9]{8}\z"),
        F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)),
    ).otherwise(F.lit(""))


def drift_minutes(left_ms: Column, right_ms: Column) -> Column:
    return (left_ms - right_ms) / F.lit(60_000.0)


def freshness_class(minutes: Column | str) -> Column:
    """pass below one hour, warn below four, otherwise fail; null stays unknown."""
    size = F.abs(_col(minutes))
    return (
        F.when(size.isNull(), F.lit("no data"))
        .when(size < 60, F.lit("pass"))
        .when(size < 240, F.lit("warn"))
        .otherwise(F.lit("fail"))
    )


# --- classes ------------------------------------------------------------------


def electoral_district(department: Column | str, province: Column | str,
                       scope: Column | str) -> Column:
    """Electoral district 1..27 of a station; null where the codes do not tell."""
    dep = F.substring(_col(department), 1, 2).try_cast("int").cast("bigint")
    # How department codes map to electoral districts.
    return (
        F.when(_col(scope) == c.SCOPE_ABROAD, F.lit(c.ABROAD_DISTRICT).cast("bigint"))
        .when(dep.between(1, 6), dep)
        .when(dep.between(7, 13), dep + 1)
        .when((dep == 14) & F.coalesce(_col(province).startswith("1401"), F.lit(False)),
              F.lit(15).cast("bigint"))
        .when(dep == 14, F.lit(16).cast("bigint"))
        .when(dep.between(15, 23), dep + 2)
        .when(dep == 24, F.lit(7).cast("bigint"))
        .when(dep == 25, F.lit(26).cast("bigint"))
    )


def age_band(age: Column | str) -> Column:
    years = _col(age)
    return (
        F.when(years < 18, F.lit("<18"))
        .when(years < 26, F.lit("18_25"))
        .when(years < 36, F.lit("26_35"))
        .when(years < 46, F.lit("36_45"))
        .when(years < 61, F.lit("46_60"))
        .otherwise(F.lit("61_plus"))
    )


def is_special_row(description: Column | str) -> Column:
    """Blank, null and contested votes are not parties."""
    return F.coalesce(_col(description).isin(*c.SPECIAL_ROWS), F.lit(False))


def severity_rank(severity: Column | str) -> Column:
    rank = F.lit(c.UNKNOWN_SEVERITY_RANK)
    for name, value in c.SEVERITY_RANK.items():
        rank = F.when(_col(severity) == name, F.lit(value)).otherwise(rank)
    return rank


def turnout_class(pct: Column | str) -> Column:
    value = _col(pct)
    out = None
    for bound, name in c.TURNOUT_CLASSES:
        test = value >= bound
        out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
    return out.otherwise(F.lit("lt_50"))


def party_color(party: Column | str) -> Column:
    """Colour of the first known prefix, the neutral one otherwise."""
    name = _col(party)
    out = F.when(name.isNull(), F.lit(c.DEFAULT_COLOR))
    for prefix, color in c.PARTY_COLORS:
        out = out.when(name.startswith(prefix), F.lit(color))
    return out.otherwise(F.lit(c.DEFAULT_COLOR))


def institution_of(document_name: Column | str) -> Column:
    """Issuing institution read from a document's name, by ordered rules."""
    name = F.upper(_col(document_name))
    # Institution marks, in the order they are tried.
    return (
        F.when(name.contains("/ONPE") | name.endswith("ONPE"), F.lit("ONPE"))
        .when(name.contains("/JNE") | name.endswith("JNE"), F.lit("JNE"))
        .when(name.contains("RENIEC"), F.lit("RENIEC"))
        .when(name.contains("/JEE"), F.lit("JEE"))
        .otherwise(F.lit(""))
    )


def https_only(url: Column | str) -> Column:
    text = _col(url).cast("string")
    return F.when(text.startswith("https://"), text).otherwise(F.lit(""))


def operation_id_is_valid(op: Column | str) -> Column:
    """Letters and digits of any alphabet, underscore, dot and dash only."""
    return F.coalesce(_col(op).rlike(r"^[\p{L}\p{N}_.\-]+\z"), F.lit(False))


# Titles that announce the general election's results.
TITLE_PATTERNS = (
    r"elecci[\p{L}\p{N}_]+\s+generales?\s+20\s*26",
    r"(^|[^\p{L}\p{N}_])eg\s*2026($|[^\p{L}\p{N}_])",
    r"resultados?\s+.*\s+2026",
    r"presidenciales?\s+2026",
    r"congresales?\s+2026",
    r"diputados?\s+2026",
    r"senadores?\s+2026",
)


def title_matches(title: Column | str) -> Column:
    hit = F.lit(False)
    for pattern in TITLE_PATTERNS:
        hit = hit | _col(title).rlike("(?iu)" + pattern)
    return F.coalesce(hit, F.lit(False))


def feature_id(upper_id: Column | str, lower_id: Column | str, own_id: Column | str,
               level: str) -> Column:
    """Place code of a map feature, from ``ID``, ``id`` or the feature's own id."""
    raw = F.coalesce(
        *[F.nullif(_col(x).cast("string"), F.lit("")) for x in (upper_id, lower_id, own_id)],
        F.lit(""),
    )
    if level == "province":
        return F.when(F.length(raw) == 4, F.concat(raw, F.lit("00"))).otherwise(raw)
    if level == "district":
        return F.when(F.length(raw) == 5, F.concat(F.lit("0"), raw)).otherwise(raw)
    return raw


# --- numbers and messages -----------------------------------------------------


def relative_drift_pct(official: Column, observed: Column) -> Column:
    return F.abs(official - observed) / F.greatest(official, F.lit(1)) * F.lit(100.0)


def regional_tolerance(total: Column, regions: Column) -> Column:
    """Ten, or one percent of the mean region, whichever is larger."""
    mean = F.coalesce(total, F.lit(0)) * F.lit(0.01) / F.greatest(regions, F.lit(1))
    return F.greatest(F.lit(10).cast("bigint"), F.floor(mean).cast("bigint"))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` of floating point: over zero an infinity or NaN, not an error; null of null."""
    over_zero = (F.when(part > 0, F.lit(float("inf"))).when(part < 0, F.lit(float("-inf")))
                 .when(part == 0, F.lit(float("nan"))))
    return F.when(whole == 0, over_zero).otherwise(F.try_divide(part, whole))


def clipped_pct(value: Column, digits: int = 2) -> Column:
    return F.round(F.least(value, F.lit(100.0)), digits)


def message(*parts: Column | str) -> Column:
    """Join text and values; one null value makes the whole message null."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def outcome_is_consistent(status: Column | str, error: Column | str) -> Column:
    """Known status, and an error text exactly when the transfer failed."""
    state = _col(status)
    return F.coalesce(
        state.isin("downloaded", "skipped_existing", "failed")
        & ((state == "failed") == _col(error).isNotNull()),
        F.lit(False),
    )


def first_candidate(candidates: Column | str) -> list[Column]:
    """The four flat columns of the first candidate; nulls for an empty list."""
    first = F.try_element_at(_col(candidates), F.lit(1))
    return [
        first["apellidoPaterno"].alias("cand_apellido_paterno"),
        first["apellidoMaterno"].alias("cand_apellido_materno"),
        first["nombres"].alias("cand_nombres"),
        first["cdocumentoIdentidad"].alias("cand_doc"),
    ]
