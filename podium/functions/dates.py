"""Free-text event dates.

Four patterns are scanned in order over the whitespace-cleaned text and their
dates concatenated, first occurrence kept:

(a) ISO ``Y-M-D``
(b) day range ``D-D.M.Y``            -> both days (not after ``.``, ``-`` or ``/``)
(c) cross-month ``D.M-D.M.Y``       -> both ends, both with year Y
(d) single ``D.M.Y``

``.``, ``-`` and ``/`` separate day, month and year; the range dash is ``-`` or
``–`` with optional spaces.  Only end points are produced; impossible dates are
dropped.  Everything is one JVM expression (regexp_extract_all + higher-order
functions), no Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from podium.functions.text import clean_text

# FIXED VALUES: the four date patterns of the results pages.
_ISO = r"(?U)\b(\d{4})-(\d{1,2})-(\d{1,2})\b"  # y m d
_DAY_RANGE = r"(?U)(?<![.\-/])\b(\d{1,2})\s*[-–]\s*(\d{1,2})[.\-/](\d{1,2})[.\-/](\d{4})\b"  # d1 d2 m y
_CROSS = r"(?U)\b(\d{1,2})[.\-/](\d{1,2})\s*[-–]\s*(\d{1,2})[.\-/](\d{1,2})[.\-/](\d{4})\b"  # d1 m1 d2 m2 y
_SINGLE = r"(?U)\b(\d{1,2})[.\-/](\d{1,2})[.\-/](\d{4})\b"  # d m y

# Whole texts of the usual shapes: an ISO date; a single date, a day range or a cross-month range.  In a range the pattern
# (d) finds the second day again, so its ends are all there is.
_WHOLE_ISO = r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"
_WHOLE = r"\A(?:[0-9]{1,2}(?:[.\-/][0-9]{1,2})? ?[-–] ?)?[0-9]{1,2}[.\-/][0-9]{1,2}[.\-/][0-9]{4}\z"

_MIN_DATE = "0001-01-01"


def _mk(y: Column, m: Column, d: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", y, m, d), "y-M-d")


def _found(text: Column, pattern: str) -> Column:
    """Each match once, as the array of its numbers (all groups of a pattern are digit runs)."""
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                       lambda m: F.regexp_extract_all(m, F.lit(r"(\d+)"), F.lit(1)))


def parse_event_dates(c) -> Column:
    """Free text -> ARRAY<DATE>, ordered, distinct, impossible dates dropped.

    The text is cleaned once: a one-element array hands it to the patterns.  A text that is a date or a range and nothing
    else gives its numbers in one scan; any other goes through the four patterns."""
    return F.element_at(F.transform(F.array(clean_text(c)), _dates_of), 1)


def _dates_of(text: Column) -> Column:
    numbers = F.array(F.regexp_extract_all(text, F.lit("([0-9]+)"), F.lit(1)))
    whole = F.when(text.rlike(_WHOLE_ISO), F.flatten(F.transform(numbers, _iso_date))) \
        .when(text.rlike(_WHOLE), F.flatten(F.transform(numbers, _range_dates)))
    found = F.coalesce(whole, _searched_dates(text))
    valid = F.filter(found, lambda x: x.isNotNull() & (x >= F.lit(_MIN_DATE).cast("date")))
    return F.coalesce(F.array_distinct(valid), F.array().cast("array<date>"))


def _iso_date(x: Column) -> Column:
    return F.array(_mk(*[F.get(x, F.lit(i)) for i in range(3)]))


def _range_dates(x: Column) -> Column:
    """``x``: d m y, d d m y or d m d m y."""
    n, g = F.size(x), lambda i: F.get(x, i if isinstance(i, Column) else F.lit(i))
    last = _mk(g(n - 1), g(n - 2), g(n - 3))
    first = _mk(g(n - 1), F.when(n == 4, g(2)).otherwise(g(1)), g(0))
    return F.when(n == 3, F.array(last)).otherwise(F.array(first, last))


def _searched_dates(text: Column) -> Column:
    g = lambda x, i: F.get(x, F.lit(i))
    iso = F.transform(_found(text, _ISO), lambda x: F.array(_mk(g(x, 0), g(x, 1), g(x, 2))))
    day_range = F.transform(_found(text, _DAY_RANGE), lambda x: F.array(
        _mk(g(x, 3), g(x, 2), g(x, 0)), _mk(g(x, 3), g(x, 2), g(x, 1))))
    cross = F.transform(_found(text, _CROSS), lambda x: F.array(
        _mk(g(x, 4), g(x, 1), g(x, 0)), _mk(g(x, 4), g(x, 3), g(x, 2))))
    single = F.transform(_found(text, _SINGLE), lambda x: F.array(_mk(g(x, 2), g(x, 1), g(x, 0))))
    return F.flatten(F.concat(iso, day_range, cross, single))


def dates_to_iso(dates) -> Column:
    """ARRAY<DATE> -> ``'YYYY-MM-DD, YYYY-MM-DD'``."""
    arr = F.col(dates) if isinstance(dates, str) else dates
    return F.array_join(F.transform(arr, lambda x: F.date_format(x, "yyyy-MM-dd")), ", ")


def any_date_between(dates, lo, hi) -> Column:
    """TRUE when any date of the array lies in [lo, hi] (inclusive)."""
    arr = F.col(dates) if isinstance(dates, str) else dates
    lo_c = F.lit(lo).cast("date") if not isinstance(lo, Column) else lo
    hi_c = F.lit(hi).cast("date") if not isinstance(hi, Column) else hi
    return F.exists(arr, lambda x: (x >= lo_c) & (x <= hi_c))


def format_day(c) -> Column:
    """DATE -> ``dd.MM.yyyy``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col, "dd.MM.yyyy")
