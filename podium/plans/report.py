"""Report queries over the gold tables: totals, first six, qualification flags,
free-text search and the interactive sort (as a position column)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium import constants as K
from podium.operators.groupwise import leaderboard

# Search key sets of the three report tables.
STANDINGS_SEARCH_KEYS = ("player", "events_top3", "champ_events", "all_starts")
STARTS_SEARCH_KEYS = ("player", "event_name", "date_text")
EVENTS_SEARCH_KEYS = ("event_name", "organizer", "date_text")


# First-click sort direction per table: standings keys place / player / championship
# place start ascending, its other keys descending; starts sort by score descending,
# everything else ascending; events always start ascending.
_ASCENDING_STANDINGS_KEYS = ("place", "player", "champ_place")


def default_direction(table: str, key: str) -> str:
    """Direction of the first sort on ``key`` in ``table`` ('standings' | 'starts' | 'events')."""
    if table == "standings":
        return "asc" if key in _ASCENDING_STANDINGS_KEYS else "desc"
    if table == "starts":
        return "desc" if key == "score" else "asc"
    return "asc"


def board_order() -> list[Column]:
    return [F.col("place").asc_nulls_last(), F.col("champ_place").asc_nulls_last()]


def totals(standings: DataFrame, events: DataFrame) -> DataFrame:
    """Report totals as (metric, value): players, starts (sum of start counts,
    missing as 0) and events."""
    r = standings.agg(F.count(F.lit(1)).cast("bigint").alias("players"),
                    F.coalesce(F.sum(F.coalesce(F.col("starts"), F.lit(0))), F.lit(0)).cast("bigint").alias("starts"))
    e = events.agg(F.count(F.lit(1)).cast("bigint").alias("value")).select(F.lit("events").alias("metric"), "value")
    return (r.select(F.lit("players").alias("metric"), F.col("players").alias("value"))
            .unionByName(r.select(F.lit("starts").alias("metric"), F.col("starts").alias("value")))
            .unionByName(e))


def top_six(board: DataFrame, n: int = K.FINAL_PLACES) -> DataFrame:
    """First ``n`` rows of the merged board in board order (may include rows
    placed only in the second window when fewer are placed in the first)."""
    first = board.orderBy(*board_order()).limit(n)
    return first.withColumn("position", F.row_number().over(Window.orderBy(*board_order())).cast("bigint")) \
        .select("position", "player", "place", "champ_place", "mean_top3")


def qualification_flags(board: DataFrame) -> DataFrame:
    """Badges: final (place <= 6) and championship (champ_place <= 3); missing -> false."""
    return board.select(
        "player", "district", "place", "champ_place",
        F.coalesce(F.col("place") <= K.FINAL_PLACES, F.lit(False)).alias("is_final"),
        F.coalesce(F.col("champ_place") <= K.CHAMPIONSHIP_PLACES, F.lit(False)).alias("is_championship"))


def search_rows(df: DataFrame, keys: Sequence[str], query: str) -> DataFrame:
    """Rows where any key column's text contains the trimmed, lower-cased query;
    an empty query keeps every row."""
    q = (query or "").strip().lower()
    if not q:
        return df
    cond = reduce(lambda a, b: a | b, [
        F.lower(F.coalesce(F.col(k).cast("string"), F.lit(""))).contains(F.lit(q)) for k in keys])
    return df.filter(cond)


def text_sort_key(c: Column) -> Column:
    """Case- and accent-insensitive Polish order with digit runs compared as numbers:
    each run is written without leading zeros behind its length, so a longer number
    sorts after a shorter one, whatever its length."""
    s = F.coalesce(c.cast("string"), F.lit(""))
    bare = lambda run: F.ltrim(run, F.lit("0"))
    runs = F.transform(F.regexp_extract_all(s, F.lit(r"(\d+)")),
                       lambda r: F.concat(F.lpad(F.char_length(bare(r)).cast("string"), 10, "0"), bare(r)))
    keyed = F.array_join(F.transform(F.split(s, r"\d+"), lambda p, i: F.concat(p, F.coalesce(F.get(runs, i), F.lit("")))), "")
    return F.collate(keyed, "pl_CI_AI")


_BLANK = r"[\t-\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]+"
_DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# prefixed whole numbers, as long as they fit 63 bits
_PREFIXED = ((r"(?i)^0x0*([0-9a-f]{1,15})$", 16), (r"(?i)^0o0*([0-7]{1,21})$", 8), (r"(?i)^0b0*([01]{1,63})$", 2))


def numeric_text(c: Column) -> Column:
    """The value of a text that a report page's script would take for a finite number ('1e3', '-3', ' 2.5 ', '0x1f'; a
    blank or missing text is 0), else NULL."""
    s = F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), f"^{_BLANK}|{_BLANK}$", "")
    decimal = F.when(s.rlike(_DECIMAL), s.try_cast("double"))
    value = F.when(s == "", F.lit(0.0)).when(F.abs(decimal) < float("inf"), decimal + 0.0)
    for pattern, base in _PREFIXED:
        value = value.when(s.rlike(pattern), F.conv(F.regexp_extract(s, pattern, 1), base, 10).cast("double"))
    return value


def sort_rows(df: DataFrame, key: str, direction: str = "asc", input_order: Sequence[Column] | None = None,
              missing_last: bool = True, position: str = "position", **place_options) -> DataFrame:
    """The interactive sort as a ``position`` column (1..n).

    Numeric columns sort numerically.  In text columns two numeric-looking texts compare by
    value and others by ``text_sort_key``; the page's comparator leaves a numeric against another
    text to collation, which is not transitive ("10" < "9a" < "9b" but 9 < 10), so here all
    numeric-looking texts come before the others.  With
    ``missing_last`` (standings table) NULL/'' go last in both directions;
    otherwise (starts/events tables) a missing value counts as 0 against
    numbers and '' against text.  Ties keep ``input_order`` (the sort is stable)."""
    dtype = df.schema[key].dataType
    numeric = isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                                 T.DoubleType, T.DecimalType))
    col = F.col(key)
    missing = col.isNull() | (col.cast("string") == "")
    if numeric:
        keys = [col.cast("double") if missing_last else F.coalesce(col.cast("double"), F.lit(0.0))]
    else:
        value = numeric_text(col)
        keys = [value.isNull(), F.coalesce(value, F.lit(0.0)), F.when(value.isNull(), text_sort_key(col)).otherwise(F.collate(F.lit(""), "pl_CI_AI"))]
    names = [f"__sk{i}" for i in range(len(keys))]
    keyed = df.withColumns({"__missing": missing if missing_last else F.lit(False), **dict(zip(names, keys))})
    if input_order is None:
        input_order = []
    ordered = [F.col("__missing").asc(),
               *[F.col(n).desc_nulls_last() if direction == "desc" else F.col(n).asc_nulls_last() for n in names],
               *input_order]
    out = leaderboard(keyed, ordered, place=position, **place_options)
    return out.drop("__missing", *names)


def _json_value(c: str, dtype: T.DataType) -> Column:
    col = F.col(f"`{c}`")
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        d = col.cast("double")
        integral = (F.abs(d) < F.lit(9.0e18)) & (d == F.floor(d))
        body = F.when(F.isnan(d), F.lit('""')) \
            .when(integral, F.floor(d).cast("bigint").cast("string")).otherwise(d.cast("string"))
    elif isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        body = col.cast("string")
    elif isinstance(dtype, T.BooleanType):
        body = F.when(col, F.lit("true")).otherwise(F.lit("false"))
    else:
        body = F.regexp_extract(F.to_json(F.struct(col.cast("string").alias("v"))), r'^\{"v":(.*)\}$', 1)
    return F.when(col.isNull(), F.lit('""')).otherwise(body)


def json_records(df: DataFrame, column: str = "json") -> DataFrame:
    """One JSON object per row (``{"a": 1, "b": ""}``): NULL and NaN -> "", integral
    floats -> integers, non-ASCII kept, ``<`` ``>`` ``&`` written as \\u003c,
    \\u003e, \\u0026 so the text is safe inside a script element."""
    import json
    parts = []
    for i, f in enumerate(df.schema.fields):
        key = json.dumps(f.name, ensure_ascii=False)
        parts.append(F.lit(("{" if i == 0 else ", ") + key + ": "))
        parts.append(_json_value(f.name, f.dataType))
    parts.append(F.lit("}"))
    text = F.concat(*parts)
    for ch, esc in (("<", "\\u003c"), (">", "\\u003e"), ("&", "\\u0026")):
        text = F.replace(text, F.lit(ch), F.lit(esc))
    return df.select(text.alias(column))
