"""Text, number and display expressions."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from podium import constants as K


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Python's str.split() treats U+001C..U+001F as whitespace, Java's Unicode \s does not.
_WS = r"(?U)[\s\x{1c}-\x{1f}]+"


def clean_text(c) -> Column:
    """Collapse every whitespace run (NBSP and other Unicode spaces included) to
    one space and trim.  NULL stays NULL."""
    return F.trim(F.regexp_replace(_col(c).cast("string"), _WS, " "))


_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def coerce_number(c, thousands: str | None = None) -> Column:
    """Tolerant number: plain decimal / scientific text -> DOUBLE, anything else
    (``1,5``, ``435d``, ``0x10``, ``1_0``, ``NaN``, ``inf``, ``True``, '') -> NULL.

    ``thousands`` removes a grouping character first (HTML tables are read with
    ``,`` as the thousands separator, so ``85,5`` becomes 855 there).
    Numeric input columns are simply cast."""
    col = _col(c)
    text = col.cast("string")
    if thousands:
        text = F.translate(text, thousands, "")
    value = F.when(text.rlike(_NUMBER), text.try_cast("double"))  # no NaN passes the pattern
    return F.when(F.abs(value) < float("inf"), value)


def season_of(c) -> Column:
    """First ``20dd`` in the text, else ''."""
    return F.regexp_extract(_col(c), r"(20\d{2})", 1)


def half_even(c, digits: int) -> Column:
    """Round to ``digits`` decimals the numpy way: rint(x * 10^d) / 10^d."""
    scale = float(10 ** digits)
    return F.rint(_col(c).cast("double") * F.lit(scale)) / F.lit(scale)


def round_exact(c, digits: int) -> Column:
    """Round the exact binary value to ``digits`` decimals, exact ties to the even digit (Python's ``round``).

    ``x * 10^d`` rounded to a double can hide on which side of a tie x lies.  The product's rounding error is itself a
    double (two halves of 26 bits per factor multiply exactly), and its sign decides wherever the product reads as a
    tie.  From 2^53 on the product has no fraction and x stays."""
    x = _col(c).cast("double")
    scale = F.lit(float(10 ** digits))
    p = x * scale
    high = lambda a: a * F.lit(134217729.0) - (a * F.lit(134217729.0) - a)
    xh, sh = high(x), high(scale)
    xl, sl = x - xh, scale - sh
    error = ((xh * sh - p) + xh * sl + xl * sh) + xl * sl
    even = F.rint(p)
    whole = (F.when((p - even == 0.5) & (error > 0), even + 1.0)
             .when((p - even == -0.5) & (error < 0), even - 1.0).otherwise(even))
    return F.when(F.abs(p) < F.lit(float(1 << 53)), whole / scale).otherwise(x)


def format_number(c, digits: int = 1) -> Column:
    """Display number: '-' for NULL, the exact value rounded to ``digits`` decimals,
    integral values without a fraction, decimal comma."""
    v = round_exact(c, digits)
    integral = F.when(v == F.floor(v), F.floor(v).cast("bigint").cast("string"))
    as_text = F.regexp_replace(
        F.regexp_replace(F.format_string("%." + str(digits) + "f", v), "0+$", ""), r"\.$", "")
    return F.when(_col(c).isNull(), F.lit("-")).otherwise(
        F.coalesce(integral, F.regexp_replace(as_text, r"\.", ",")))


def trend_label(c, digits: int = 1) -> Column:
    """Trend wording: too few starts / +x / -x / flat."""
    col = _col(c)
    return (F.when(col.isNull(), F.lit(K.TREND_TOO_FEW))
            .when(col > 0, F.concat(F.lit(K.TREND_PREFIX + "+"), format_number(col, digits), F.lit(K.TREND_UNIT)))
            .when(col < 0, F.concat(F.lit(K.TREND_PREFIX), format_number(col, digits), F.lit(K.TREND_UNIT)))
            .otherwise(F.lit(K.TREND_FLAT)))


def null_to_text(c) -> Column:
    """NULL -> '', anything else -> its text."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def split_names(c) -> Column:
    """Split a joined name list on the separator, dropping blanks."""
    parts = F.split(null_to_text(c), r" \| ")
    return F.filter(parts, lambda x: x != "")


def strip_tags(c) -> Column:
    """Replace every tag with a space (cell text is then whitespace-cleaned)."""
    return F.regexp_replace(_col(c), r"(?s)<[^>]*>", " ")


def _numref_char(code: Column) -> Column:
    """Character of a numeric reference code ('321' or 'x141'), via its UTF-16 units."""
    cp = F.when(F.lower(code).startswith("x"), F.conv(F.substring(code, 2, 10), 16, 10)).otherwise(code) \
        .cast("long")
    bmp = F.lpad(F.hex(cp), 4, "0")
    off = cp - 0x10000
    pair = F.concat(F.hex(F.lit(0xD800) + F.shiftright(off, 10)), F.hex(F.lit(0xDC00) + off.bitwiseAND(F.lit(0x3FF))))
    units = F.when(cp < 0x10000, bmp).when(cp <= 0x10FFFF, pair)
    return F.coalesce(F.decode(F.unhex(units), "UTF-16BE"), F.lit("\ufffd"))


_REFERENCE = r"&(#[xX][0-9a-fA-F]{1,6}|#[0-9]{1,7}|[A-Za-z][A-Za-z0-9]*);"
# The references most pages use are tried before the table of all names.
_FREQUENT = {"nbsp": "\u00a0", "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
_NAMES = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}


def _reference_text(ref: Column) -> Column:
    out = F.when(ref.startswith("#"), _numref_char(F.substring(ref, 2, 10)))
    for name, text in _FREQUENT.items():
        out = out.when(ref == name, F.lit(text))
    named = F.element_at(F.from_json(F.lit(json.dumps(_NAMES)), "map<string,string>"), ref)
    return F.coalesce(out.otherwise(named), F.concat(F.lit("&"), ref, F.lit(";")))


def decode_entities(c) -> Column:
    """Decode numeric and all named character references, each once (the pieces
    between references are joined with the decoded characters); unknown names stay
    as they are, text without references is untouched."""
    col = _col(c)
    pieces = F.split(col, _REFERENCE)
    chars = F.transform(F.regexp_extract_all(col, F.lit(_REFERENCE), F.lit(1)), _reference_text)
    joined = F.array_join(F.zip_with(pieces, chars, lambda p, x: F.concat(p, F.coalesce(x, F.lit("")))), "")
    return F.when(col.rlike(_REFERENCE), joined).otherwise(col)


# Characters that a page keeps as references until its markup has been read.
_MARKUP = {"&": "&amp;", "<": "&lt;", ">": "&gt;", '"': "&quot;", "'": "&apos;"}


def decode_markup(c) -> Column:
    """Decode the five references that a page keeps until its markup has been read."""
    col = _col(c)
    text = col
    for char, name in reversed(_MARKUP.items()):  # the ampersand last
        text = F.replace(text, F.lit(name), F.lit(char))
    return F.when(F.contains(col, F.lit("&")), text).otherwise(col)


_HREF = r"""(?is)<a\s[^>]*?href\s*=\s*(?:["']([^"']*)["']|([^\s"'>]+))"""
_BARE_URL = r"https?://\S+"


_ORIGIN = r"^([a-zA-Z][a-zA-Z0-9+.-]*)(://[^/?#]*)"
_ROOTED = r"\A/[A-Za-z0-9_~%-][A-Za-z0-9_~%./-]*\z"
_ABSOLUTE = r"\A[a-zA-Z][a-zA-Z0-9+.-]*://[^\t\r\n]*\z"


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _without_dots(segments: Column) -> Column:
    """The path that the segments ('' first for a rooted path) come down to: '..' takes the segment before away, but
    none above the root; a final '.' or '..' leaves a closing slash."""
    kept = F.aggregate(segments, F.array().cast("array<string>"), lambda a, s: F.when(s == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))))
                       .when(s == ".", a).otherwise(F.concat(a, F.array(s))))
    closing = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    path = F.array_join(F.concat(kept, closing), "/")
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))


def absolute_url(href, base) -> Column:
    """Resolve ``href`` against ``base`` as browsers and RFC 3986 do: absolute URLs stay as they are, ``//host`` takes the
    scheme, ``?q`` and ``#f`` replace query and fragment, other paths are merged with the base's directory (a root-relative
    one with its host) and lose their dot segments, merged ones also their empty segments.  A base without ``scheme://`` leaves
    relative references as they are joined by text alone."""
    def cleaned(x: Column) -> Column:
        return _let(F.struct(F.regexp_replace(x["href"], r"^[\x00-\x20]+|[\t\r\n]", "").alias("h"), x["base"].alias("given"),
                             F.lower(F.regexp_extract(x["base"], r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)).alias("scheme")), reduced)

    def reduced(x: Column) -> Column:
        # the base's own scheme without a host counts as relative, and so do slashes that no host follows
        own = F.lower(x["h"]).startswith(F.concat(x["scheme"], F.lit(":"))) & ~F.substr(x["h"], F.length(x["scheme"]) + 2).startswith("//")
        h = F.when((x["scheme"] != "") & own, F.substr(x["h"], F.length(x["scheme"]) + 2)).otherwise(x["h"])
        b = F.concat(x["scheme"], F.substr(x["given"], F.length(x["scheme"]) + 1))
        return F.when(x["h"] == "", x["given"]).otherwise(
            _let(F.struct(F.regexp_replace(h, r"^//(?=[/?#]|$)", "").alias("h"), b.alias("b"), x["scheme"].alias("scheme")), split))

    def split(x: Column) -> Column:
        return _let(F.struct(x["h"].alias("h"), x["b"].alias("b"), x["scheme"].alias("scheme"),
                             F.regexp_extract(x["b"], r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1).alias("origin"),
                             F.regexp_extract(x["b"], r"^([^?#]*)", 1).alias("plain"), F.regexp_extract(x["h"], r"^([^?#]*)", 1).alias("path")), resolved)

    def resolved(x: Column) -> Column:
        h = x["h"]
        return (F.when(h == "", F.regexp_extract(x["b"], r"^([^#]*)", 1))
                .when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), h)
                .when(h.startswith("//"), F.concat(x["scheme"], F.lit(":"), h))
                .when(h.startswith("?"), F.concat(x["plain"], h))
                .when(h.startswith("#"), F.concat(F.regexp_extract(x["b"], r"^([^#]*)", 1), h))
                .when(x["origin"] == "", F.when(h.startswith("/"), h).otherwise(F.concat(F.regexp_replace(x["plain"], r"[^/]*$", ""), h)))
                .otherwise(F.concat(x["origin"], _let(segments(x), _without_dots), F.substr(h, F.length(x["path"]) + 1))))

    def segments(x: Column) -> Column:
        beside = lambda f: _let(F.concat(F.slice(f, F.lit(1), F.size(f) - F.when(F.element_at(f, -1) == "", 0).otherwise(1)), F.split(x["path"], "/")),
                                lambda s: F.filter(s, lambda v, i: (v != "") | (i == 0) | (i == F.size(s) - 1)))
        return F.when(x["path"].startswith("/"), F.split(x["path"], "/")).otherwise(
            _let(F.split(F.substr(x["plain"], F.length(x["origin"]) + 1), "/"), beside))

    # what most links are: a rooted path without dot segments, or an absolute URL; neither is changed by the steps above
    def usual(x: Column) -> Column:
        origin = F.regexp_extract(x["base"], _ORIGIN, 2)
        rooted = x["href"].rlike(_ROOTED) & ~F.contains(x["href"], F.lit("/.")) & (origin != "")
        return (F.when(rooted, F.concat(F.lower(F.regexp_extract(x["base"], _ORIGIN, 1)), origin, x["href"]))
                .when(x["href"].rlike(_ABSOLUTE), x["href"]).otherwise(_let(x, cleaned)))

    return _let(F.struct(_col(href).alias("href"), _col(base).alias("base")), usual)


_BASE_TAG = r"<[bB][aA][sS][eE]\s"  # found sooner than without regard to case
_BASE = r"""(?is)<base\s[^>]*?href\s*=\s*(?:["']([^"']*)["']|([^\s"'>]+))"""


def page_base(html, url) -> Column:
    """What a page's links are relative to: its first ``<base href>`` (itself resolved against the URL), else the URL."""
    def found(x: Column) -> Column:
        href = F.concat(F.regexp_extract(x["page"], _BASE, 1), F.regexp_extract(x["page"], _BASE, 2))
        return F.when(x["page"].rlike(_BASE_TAG) & x["page"].rlike(_BASE), absolute_url(decode_entities(href), x["url"])).otherwise(x["url"])

    return _let(F.struct(_col(html).alias("page"), _col(url).alias("url")), found)


def first_link(cell_html, base, decode=decode_entities) -> Column:
    """First ``<a href>`` made absolute against ``base``; else the first bare
    ``http(s)://`` token of the cleaned text; else ''.  ``decode`` resolves the references that are still in the cell."""
    html = _col(cell_html)
    href = F.concat(F.regexp_extract(html, _HREF, 1), F.regexp_extract(html, _HREF, 2))
    has_href = html.rlike(_HREF)
    text = clean_text(decode(strip_tags(html)))
    bare = F.regexp_extract(text, _BARE_URL, 0)
    return F.when(has_href, absolute_url(decode(href), base)).otherwise(bare)
