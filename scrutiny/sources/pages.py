"""Facts read out of HTML: catalogue entries, download links, embedded JSON.

Pages are rows of a table; every extraction is a set of built-in regular-expression
functions, so pages spread over tasks and nothing is parsed on the driver.
"""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutiny.functions.scalars import _col

# Java's \s plus the no-break space, which text stripping removes as well.
_BLANK = r"[\s\u00a0]"
# What may follow a tag's name up to its end; a ``>`` inside quotes does not end it.
_REST = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_SKIP = r"""(?:[^>"']|"[^"]*+"|'[^']*+')*?"""
_LINK = rf"(?is)(<a(?=[\s>]){_REST}>.*?</a\s*>)"
# Names that browsers decode without a semicolon, longest first (from the standard library).
_BARE = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))


def without_comments(html: Column | str) -> Column:
    return F.regexp_replace(_col(html), r"(?s)<!--.*?-->", "")


def _code_points() -> Column:
    """Code points of the named character references, from the standard library."""
    pairs = [F.lit(x) for name, code in name2codepoint.items() for x in (name, code)]
    pairs += [F.lit("apos"), F.lit(39)]
    return F.create_map(*pairs)


def unescape(text: Column) -> Column:
    """Decode character references: named, decimal and hexadecimal.

    The text is cut in front of every ampersand and each piece is decoded once, so what a
    reference stands for is never decoded again. Unknown references stay as they are.
    """
    points = _code_points()

    def piece(part: Column) -> Column:
        name = F.regexp_extract(part, r"^&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z0-9]{2,8});", 1)
        code = (
            F.when(name == "", F.lit(None).cast("int"))
            .when(F.lower(F.substring(name, 1, 2)) == "#x",
                  F.conv(F.substring(name, 3, 6), 16, 10).cast("int"))
            .when(F.substring(name, 1, 1) == "#", F.substring(name, 2, 7).cast("int"))
            .otherwise(F.try_element_at(points, name))
        )
        bare = F.regexp_extract(part, rf"^&({_BARE})", 1)
        used = F.when(code.isNotNull(), F.length(name) + 3).otherwise(F.length(bare) + 2)
        code = F.coalesce(code, F.try_element_at(points, bare))
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(
            valid, F.concat(char, F.substring(part, used, F.length(part)))
        ).otherwise(part)

    decoded = F.array_join(F.transform(F.split(text, "(?=&)"), piece), "")
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def inner_text(html: Column | str) -> Column:
    """Text between the tags: every piece stripped, the pieces put together."""
    pieces = F.split(_col(html), rf"<(?=[a-zA-Z/!?]){_REST}>")
    stripped = F.transform(
        pieces, lambda t: F.regexp_replace(unescape(t), f"^{_BLANK}+|{_BLANK}+$", "")
    )
    return F.array_join(stripped, "")


def absolute(href: Column, base: str) -> Column:
    return F.when(href.startswith("/"), F.concat(F.lit(base), href)).otherwise(href)


def attribute(tag: Column, name: str) -> Column:
    """Value of a tag's attribute, quoted either way or not at all; ``""`` if it has none."""
    before = rf"(?is)^<[a-z]{_SKIP}\s{name}\s*=\s*"
    forms = [F.regexp_extract(tag, before + value, 1)
             for value in ('"([^"]*)"', "'([^']*)'", r"""([^\s"'>]+)""")]
    return unescape(F.coalesce(*[F.nullif(f, F.lit("")) for f in forms], F.lit("")))


def catalogue_entries(pages: DataFrame, base: str, html: str = "html",
                      key: str = "page_id") -> DataFrame:
    """Per article: title and address of its first heading's link, and a date.

    Articles whose first heading (h2, h3 or h4) is missing or holds no link are left
    out. ``position`` is the article's place on its page.
    """
    articles = F.regexp_extract_all(
        without_comments(html), F.lit(rf"(?is)<article(?=[\s>]){_REST}>(.*?)</article\s*>"), 1)
    rows = pages.select(key, F.posexplode(articles).alias("position", "article"))
    heading = F.regexp_extract("article", rf"(?is)<(h[234])(?=[\s>]){_REST}>(.*?)</\1\s*>", 2)
    rows = rows.withColumn("heading", heading)
    link = F.regexp_extract("heading", _LINK, 1)
    rows = rows.withColumn("link", link).filter(F.col("link") != "")
    opening = F.regexp_extract("link", rf"(?is)^<a{_REST}>", 0)
    dated = F.regexp_extract(
        "article",
        # One element of the same name may lie inside.
        rf"(?is)<([a-z][a-z0-9]*)(?=\s){_SKIP}\sclass\s*=\s*"
        r"""(?:"[^"]*date[^"]*"|'[^']*date[^']*'|[^\s"'>]*date[^\s"'>]*)"""
        rf"{_REST}>((?:[^<]++|<(?!/?\1[\s>])|<\1(?=[\s>]){_REST}>(?:[^<]++|<(?!/?\1[\s>]))*+</\1\s*>)*+)</\1\s*>",
        2,
    )
    return rows.select(
        key,
        F.col("position").cast("bigint").alias("position"),
        inner_text("link").alias("title"),
        absolute(attribute(opening, "href"), base).alias("url"),
        inner_text(dated).alias("raw_date"),
    )


def download_links(pages: DataFrame, base: str, html: str = "html",
                   key: str = "page_id") -> DataFrame:
    """Links to .csv, .xlsx, .zip and .csv.gz files: name, address, format."""
    links = F.regexp_extract_all(without_comments(html), F.lit(_LINK), 1)
    rows = pages.select(key, F.posexplode(links).alias("position", "link"))
    rows = rows.withColumn(
        "href", attribute(F.regexp_extract("link", rf"(?is)^<a{_REST}>", 0), "href")
    ).filter(F.col("href").rlike(r"(?i)\.(csv|xlsx|zip|csv\.gz)\z"))
    label = inner_text("link")
    return rows.select(
        key,
        F.col("position").cast("bigint").alias("position"),
        F.when(label != "", label).otherwise(F.substring_index("href", "/", -1)).alias("name"),
        F.when(F.col("href").startswith("http"), F.col("href"))
        .otherwise(F.concat(F.lit(base), F.col("href"))).alias("url"),
        F.lower(F.substring_index("href", ".", -1)).alias("format"),
    )


def links(pages: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """All links of a page with their text, in order."""
    found = F.regexp_extract_all(without_comments(html), F.lit(_LINK), 1)
    rows = pages.select(key, F.posexplode(found).alias("position", "link"))
    return rows.select(
        key,
        F.col("position").cast("bigint").alias("position"),
        attribute(F.regexp_extract("link", rf"(?is)^<a{_REST}>", 0), "href").alias("href"),
        inner_text("link").alias("label"),
    )


def embedded_json(html: Column | str, path: str = "$.props.pageProps.dispositivo",
                  script_id: str = "__NEXT_DATA__") -> Column:
    """JSON text at a path of the page's data script; null if absent.

    The whole blob has to be JSON: with anything missing, or anything behind its end, it is
    null. ``get_json_object`` alone would stop reading where the path is found.
    """
    blob = F.nullif(F.regexp_extract(
        _col(html), rf'(?s)<script id="{script_id}" type="application/json">(.+?)</script>', 1
    ), F.lit(""))
    return F.when(is_json(blob), F.get_json_object(blob, path))


#: Stands behind a text to see whether the parser gets that far.
_END = "_end_of_text_"


def is_json(text: Column) -> Column:
    """True if a text is one JSON value and nothing else.

    The parser stops where its first value ends. So the text stands in an array in front of a
    mark of our own: it is one value if the array is that value and the mark.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')))
    parts = F.try_variant_get(wrapped, "$", "array<variant>")
    return F.coalesce(
        ~F.contains(text, F.lit(_END)) & (F.size(parts) == 2)
        & (F.try_variant_get(wrapped, "$[1]", "string") == _END), F.lit(False))
