"""Render bound rows as HTML pages, so the page scans run on data that grows
with the supplied tables (the supplied ``pages`` hold links but no tables).

Result pages: one page per results URL with a navigation table (no score
header, skipped) and the result table at position ``table_no``.  Three header
styles rotate by row: plain labels; upper-case tags, other spellings and
permuted columns; a two-level header inside <thead> followed by a repeated
header row and a row without a player.

Schedule pages: one page per block of 50 events with a navigation table, the
even-keyed events and the odd-keyed events (columns permuted, plus a short row,
a 'brak' row and re-listed events at the end).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium import constants as K

BASE_URL = "https://results.example/"
SCHEDULE_BLOCK = 50

NAV_TABLE = ('<table class="nav"><tr><th>Menu</th><th>Link</th></tr>'
             '<tr><td>Start</td><td><a href="/">home</a></td></tr></table>')


def _num(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _int_text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("bigint").cast("string"), F.lit(""))


_STYLE_ORDER = {
    0: ["lp", "player", "klass", "district", "m_skeet", "m_lane", "m_trap", "sub_shot", "m_boar", "m_buck",
        "sub_rifle", "score"],
    1: ["score", "player", "lp", "district", "klass", "m_skeet", "m_lane", "m_trap", "sub_shot", "m_boar",
        "m_buck", "sub_rifle"],
    2: ["lp", "player", "klass", "district", "m_skeet", "m_lane", "m_trap", "sub_shot", "m_boar", "m_buck",
        "sub_rifle", "score"],
}


def _spelling(canonical: str, style: int) -> str:
    """One of the accepted header spellings (fixed values in constants), rotating by style."""
    spellings = [label for label, c in K.HEADER_ALIASES.items() if c == canonical]
    return spellings[style % len(spellings)]


def _style_columns(style: int):
    """(header label, cell value) per column of a result table in the given style."""
    player = F.concat(F.lit('<a href="/p/'), F.col("row_seq").cast("string"), F.lit('">'), F.col("player"),
                      F.lit("</a>"))
    value = {
        "lp": F.concat(_int_text("lp"), F.lit(".")),
        "player": F.col("player") if style == 1 else player,
        "klass": F.col("klass"),
        "district": F.concat(F.lit("&nbsp;"), F.col("district"), F.lit(" ")),
        "score": _int_text("score"),
        **{c: _num(c) for c in ("m_skeet", "m_lane", "m_trap", "sub_shot", "m_boar", "m_buck", "sub_rifle")},
    }
    return [(_spelling(c, style), value[c]) for c in _STYLE_ORDER[style]]


def _row(cells: list[Column], td: str = "td", tr: str = "tr") -> Column:
    parts = [F.lit(f"<{tr}>")]
    for c in cells:
        parts += [F.lit(f"<{td}>"), c, F.lit(f"</{td}>")]
    parts.append(F.lit(f"</{tr}>"))
    return F.concat(*parts)


def _result_table(style: int, spans: bool = False, body_span: bool = False, td_head: bool = False) -> Column:
    cols = _style_columns(style)
    if style == 0:
        head = _row([F.lit(lbl) for lbl, _ in cols], "th")
        return F.concat(F.lit("<table>"), head, _row([v for _, v in cols]), F.lit("</table>"))
    if style == 1:
        head = _row([F.lit(lbl) for lbl, _ in cols], "TH", "TR")
        body = F.concat(F.lit("<TR>"), *[F.concat(F.lit('<TD class="c">'), v, F.lit("</TD>")) for _, v in cols],
                        F.lit("</TR>"))
        return F.concat(F.lit('<TABLE border="1">'), head, body, F.lit("</TABLE>"))
    if spans:
        # two header rows with spans: the first four labels span both rows, one group spans the rest
        group = F.concat(F.lit("<tr>"), *[F.lit(f'<th rowspan="2">{lbl}</th>') for lbl, _ in cols[:4]],
                         F.lit(f'<th colspan="{len(cols) - 4}">Wyniki</th></tr>'))
        head = _row([F.lit(lbl) for lbl, _ in cols[4:]], "th")
    else:
        # two full header rows: group labels, then the column labels
        group = _row([F.lit("Zawodnik")] * 4 + [F.lit("Wyniki")] * (len(cols) - 4), "th")
        head = _row([F.lit(lbl) for lbl, _ in cols], "th")
    # the repeated header row's class cell spans the row without a player below it
    klass_at = [c for c, _ in cols].index(_spelling("klass", 2))
    if body_span:
        repeated = F.concat(F.lit("<tr>"), *[F.lit(f'<td rowspan="2">{lbl}</td>' if i == klass_at else f"<td>{lbl}</td>")
                                             for i, (lbl, _) in enumerate(cols)], F.lit("</tr>"))
        empty = _row([F.lit("0.")] + [F.lit(" ")] * 9 + [F.lit("100")])
    else:
        repeated = _row([F.lit(lbl) for lbl, _ in cols])
        last = F.when(F.col("row_seq") % 21 == 8, F.lit("100" + _NESTED)).otherwise(F.lit("100"))
        empty = _row([F.lit("0.")] + [F.lit(" ")] * 10 + [last])
    if td_head:
        group, head = (F.regexp_replace(x, "(</?)th", "$1td") for x in (group, head))
    return F.concat(F.lit("<table><thead>"), group, head, F.lit("</thead><tbody>"), repeated, empty,
                    _row([v for _, v in cols]), F.lit("</tbody></table>"))


# tables that count for nothing: empty, hidden, commented out, made by a script
_UNCOUNTED = ('<table></table><table style="display: none"><tr><td>x</td></tr></table>'
              "<!-- <table><tr><td>x</td></tr></table> --><script>var t = '<table><tr><td>x</td></tr></table>';</script>")
_NESTED = "<table><tr><td>note</td></tr></table>"


def _dealt(rows: DataFrame, key: Column) -> DataFrame:
    """Rows dealt over all shuffle partitions: pages are many times wider than what they are made of, so partitions sized
    for the rows would leave most of a cluster idle while pages are read."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def result_pages(results: DataFrame) -> DataFrame:
    """pages(url, html): one result page per results row."""
    results = _dealt(results, F.col("row_seq"))
    style = F.col("row_seq") % 3
    # the two-level style carries header spans on one page in ten, and a body row span
    # (the fill-down path) on one page in thirty
    table = (F.when(style == 0, _result_table(0)).when(style == 1, _result_table(1))
             .when(F.col("row_seq") % 30 == 2, _result_table(2, spans=True, body_span=True))
             .when(F.col("row_seq") % 10 == 2, _result_table(2, spans=True))
             .when(F.col("row_seq") % 30 == 5, _result_table(2, td_head=True))
             .otherwise(_result_table(2)))
    tables = F.when(F.col("table_no") == 1, F.concat(table, F.lit(NAV_TABLE))) \
        .otherwise(F.concat(F.lit(NAV_TABLE), table))
    # one page in ten begins with tables that must not be counted
    before = F.when(F.col("row_seq") % 10 == 4, F.lit(_UNCOUNTED)).otherwise(F.lit(""))
    html = F.concat(F.lit("<html><body><h1>"), F.col("event_name"), F.lit("</h1>"), before, tables, F.lit("</body></html>"))
    return results.select(F.col("results_url").alias("url"), html.alias("html"))


# header label of each schedule column (fixed values live in constants)
_LABEL = {col: label for label, col in K.SCHEDULE_HEADERS.items()}
_SCHEDULE_A = [_LABEL[c] for c in ("schedule_lp", "event_name", "organizer", "venue", "date_text", "results_url")]
_SCHEDULE_B = [_LABEL[c] for c in ("date_text", "schedule_lp", "results_url", "event_name", "venue", "organizer")]


def _schedule_cells(order: list[str]) -> list[Column]:
    # every third link stands without quotes
    link = (F.when(F.col("schedule_lp").cast("bigint") % 3 == 0, F.concat(F.lit("<a href=/u/"), F.col("schedule_lp"), F.lit(">wyniki</a>")))
            .otherwise(F.concat(F.lit('<a href="/u/'), F.col("schedule_lp"), F.lit('">wyniki</a>'))))
    value = {"schedule_lp": F.col("schedule_lp"), "event_name": F.col("event_name"),
             "organizer": F.col("organizer"), "venue": F.col("venue"), "date_text": F.col("date_text"),
             "results_url": link}
    inv = {label: col for col, label in _LABEL.items()}
    return [value[inv[h]] for h in order]


def schedule_pages(events: DataFrame) -> DataFrame:
    """pages(url, html): schedule pages of ``SCHEDULE_BLOCK`` events each.

    The only grouping is by block, whose size is bounded by construction."""
    key = F.col("schedule_lp").cast("bigint")
    # the columns are dealt, their html is made behind that
    ev = _dealt(events.withColumn("__key", key).withColumn("__block", F.floor(key / SCHEDULE_BLOCK)), F.col("__block"))
    ev = ev.withColumn("__a", _row(_schedule_cells(_SCHEDULE_A))).withColumn("__b", _row(_schedule_cells(_SCHEDULE_B)))

    def rows(cond: Column, html: str) -> Column:
        items = F.sort_array(F.collect_list(F.when(cond, F.struct(F.col("__key").alias("k"), F.col(html).alias("h")))))
        return F.array_join(F.transform(items, lambda x: x["h"]), "")

    pages = ev.groupBy("__block").agg(
        rows(F.col("__key") % 2 == 0, "__a").alias("t2"),
        rows(F.col("__key") % 2 == 1, "__b").alias("t3"),
        rows(F.col("__key") % 5 == 0, "__b").alias("again"))
    head_a = "<tr>" + "".join(f"<th>{h}</th>" for h in _SCHEDULE_A) + "</tr>"
    head_b = "<tr>" + "".join(f"<td>{h}</td>" for h in _SCHEDULE_B) + "</tr>"
    short = f"<tr><td>x{_NESTED}</td></tr>"
    brak = "<tr><td>01.01.2000</td><td>0</td><td>brak wyników</td><td>Odwołane</td><td>-</td><td>-</td></tr>"
    html = F.concat(F.lit("<html><body>"), F.lit(NAV_TABLE),
                    F.lit("<table>" + head_a), F.col("t2"), F.lit("</table>"),
                    F.lit("<table>" + head_b + short), F.col("t3"), F.lit(brak), F.col("again"), F.lit("</table>"),
                    F.lit("</body></html>"))
    url = F.concat(F.lit("schedule/"), F.lpad(F.col("__block").cast("string"), 10, "0"))
    return pages.select(url.alias("url"), html.alias("html"))
