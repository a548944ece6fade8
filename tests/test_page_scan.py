"""Page scans on hand-written pages: the expected rows are stated, not derived."""

import pytest

from podium.functions.text import decode_entities, first_link
from podium.functions.dates import dates_to_iso, parse_event_dates
from podium.sources import html_tables as H
from pyspark.sql import functions as F

HEAD = "<tr><th>Lp</th><th>Nazwisko i imię</th><th>Okręg</th><th>Razem</th></tr>"


def row(n, player, score, tail=""):
    return f"<tr><td>{n}</td><td>{player}</td><td>D</td><td>{score}{tail}</td></tr>"


TABLE = f"<table>{HEAD}{row(1, 'Ala', 100)}{row(2, 'Ola', 90)}</table>"
BOTH = [("Ala", 100.0), ("Ola", 90.0)]
NESTED = "<table><tr><td>note</td></tr></table>"

CASES = {
    "plain": (TABLE, 1, BOTH),
    "nested in a cell": (f"<table>{HEAD}{row(1, 'Ala', 100, NESTED)}{row(2, 'Ola', 90)}</table>", 1, BOTH),
    "nested twice": (f"<table>{HEAD}<tr><td><table><tr><td>{NESTED}</td></tr></table>1</td><td>Ala</td><td>D</td><td>100</td></tr>{row(2, 'Ola', 90)}</table>", 1, BOTH),
    "inside a layout table": (f"<table><tr><td>menu</td><td>{TABLE}</td></tr><tr><td>foot</td></tr></table>", 2, BOTH),
    "after an empty table": ("<table></table><table><tr><td> &nbsp; </td></tr></table>" + TABLE, 1, BOTH),
    "after hidden tables": ('<table style="color:red; display: none"><tr><td>x</td></tr></table><TABLE STYLE=\'display:none\'><tr><td>x</td></tr></TABLE>' + TABLE, 1, BOTH),
    "after a table inside a hidden one": (f'<table style="display:none"><tr><td>{NESTED}</td></tr></table>' + TABLE, 1, BOTH),
    "after a commented table": (f"<!-- {NESTED} <table> -->" + TABLE, 1, BOTH),
    "after a scripted table": ("<script>var t = '<table><tr><td>x</td></tr></table>';</script>" + TABLE, 1, BOTH),
    "after a shown table": (NESTED + TABLE, 2, BOTH),
    "thead of td cells": ("<table><thead>" + HEAD.replace("th>", "td>") + f"</thead><tbody>{row(1, 'Ala', 100)}{row(2, 'Ola', 90)}</tbody></table>", 1, BOTH),
    "thead with an empty row": (f"<table><thead>{HEAD}<tr><td></td><td> </td></tr></thead>{row(1, 'Ala', 100)}{row(2, 'Ola', 90)}</table>", 1, BOTH),
    "unclosed": (f"<table>{HEAD}{row(1, 'Ala', 100)}{row(2, 'Ola', 90)}", 1, BOTH),
}


@pytest.mark.parametrize("name", CASES)
def test_result_pages(spark, name):
    html, table_no, want = CASES[name]
    pages = spark.createDataFrame([(name, f"<html><body>{html}</body></html>")], "url string, html string")
    got = H.extract_results(pages).collect()
    assert sorted((r.player, r.score) for r in got) == want and {r.table_no for r in got} == {table_no}


def test_spans_have_no_limit(spark):
    rows = "".join(f"<tr><td>{i}</td><td>P{i:03}</td>" + ('<td rowspan="150">Home</td>' if i == 0 else "") + f"<td>{i + 1}</td></tr>" for i in range(150))
    pages = spark.createDataFrame([("u", f"<table>{HEAD}{rows}</table>")], "url string, html string")
    got = H.extract_results(pages).collect()
    assert len(got) == 150 and {r.district for r in got} == {"Home"} and {r.score for r in got} == {float(i + 1) for i in range(150)}


def test_issues_name_pages_without_tables_and_events_without_page(spark):
    pages = spark.createDataFrame([("a", TABLE + NESTED), ("b", "<p>no table</p>"), ("c", None), ("d", "<table></table>")], "url string, html string")
    events = spark.createDataFrame([("a",), ("z",)], "results_url string")
    got = sorted(tuple(r) for r in H.ingest_issues(pages, events=events).collect())
    assert got == [("a", 2, "missing_headers", "player,district,score"), ("b", 0, "no_tables", ""), ("c", 0, "no_tables", ""), ("d", 0, "no_tables", ""), ("z", 0, "no_page", "")]


def test_schedule_goes_on_behind_a_nested_table_and_counts_all_tables(spark):
    head = "".join(f"<th>{h}</th>" for h in ("Lp", "Nazwa zawodów", "ZO PZŁ", "Strzelnica", "Data zawodów", "Wyniki"))
    line = lambda n, link, note="": f"<tr><td>{n}</td><td>E{n}{note}</td><td>Z</td><td>S</td><td>16&ndash;17.05.2026</td><td>{link}</td></tr>"
    page = f"<table style='display:none'></table><table><tr>{head}</tr>{line(1, '<a href=/a1>w</a>', NESTED)}{line(2, '<a class=x href=/a2>w</a>')}{line(3, '<a href=' + chr(34) + '/a3' + chr(34) + '>w</a>')}</table>"
    got = H.schedule_events(spark.createDataFrame([("s", page)], "url string, html string"), "https://h.example/x").collect()
    assert sorted((r.schedule_lp, r.results_url, r.schedule_table_no, r.date_text) for r in got) == [
        (str(n), f"https://h.example/a{n}", 2, "16–17.05.2026") for n in (1, 2, 3)]


def test_references(spark):
    texts = ["W&oacute;jcik", "16&ndash;17.05.2026", "&lstrok;&Zacute; &#322;&#x17B;", "&amp;lt; &unknown; &", "a&nbsp;b", "&apos;&quot;&lt;&gt;", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.x for r in df.select("i", decode_entities("t").alias("x")).orderBy("i").collect()]
    assert got == ["Wójcik", "16–17.05.2026", "łŹ łŻ", "&lt; &unknown; &", "a b", "'\"<>", None, ""]
    dates = spark.createDataFrame([("16&ndash;17.05.2026",)], "t string").select(dates_to_iso(parse_event_dates(decode_entities("t"))).alias("d")).first()
    assert dates.d == "2026-05-16, 2026-05-17"


def test_first_link_forms(spark):
    cells = ['<a href=/a2>x</a>', "<a href='/b'>x</a>", '<a class="c" HREF = "/c">x</a>', "<a name=x>no</a> http://h.example/d e", "none"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cells)], "i int, t string")
    got = [r.x for r in df.select("i", first_link(F.col("t"), F.lit("https://h.example/p/q")).alias("x")).orderBy("i").collect()]
    assert got == ["https://h.example/a2", "https://h.example/b", "https://h.example/c", "http://h.example/d", ""]


def test_many_tables_in_one_page(spark):
    """2,000 tables, side by side and nested: work grows with the tags, not with their square."""
    import time
    flat = "".join(f"<table><tr><td>t{i}</td></tr></table>" for i in range(2000))
    # every tenth table holds nine others, some hidden, some empty
    inner = lambda i: "".join(f"<table{' style=display:none' if k == 3 else ''}><tr><td>{'' if k == 4 else f'i{i}.{k}'}</td></tr></table>" for k in range(9))
    mixed = "".join(f"<table><tr><td>o{i}{inner(i)}</td><td>end{i}</td></tr></table>" for i in range(200))
    deep = "<table><tr><td>a" * 300 + "</td><td>z</td></tr></table>" * 300
    pages = spark.createDataFrame([("flat", flat), ("mixed", mixed), ("deep", deep), ("open", "<table><tr><td>x" * 3 + "</table>"), ("stray", "</table>" * 3 + NESTED)],
                                  "url string, html string")
    start = time.time()
    got = {}
    for r in H.page_tables(pages).collect():
        got.setdefault(r.url, {})[r.table_no] = r
    assert time.time() - start < 60
    assert [got["flat"][i + 1].table_html for i in range(2000)] == [f"<tr><td>t{i}</td></tr>" for i in range(2000)]
    assert len(got["mixed"]) == 2000 and [len(got[u]) for u in ("deep", "open", "stray")] == [300, 3, 1]
    for i in (0, 7, 199):
        assert got["mixed"][10 * i + 1].table_html == f"<tr><td>o{i}</td><td>end{i}</td></tr>"
        assert [got["mixed"][10 * i + 2 + k].table_html for k in (0, 4, 8)] == [f"<tr><td>i{i}.0</td></tr>", "<tr><td></td></tr>", f"<tr><td>i{i}.8</td></tr>"]
    assert all(r.table_html == "<tr><td>a</td><td>z</td></tr>" for r in got["deep"].values())
    shown = [r.url for r in H.page_tables(pages, shown_only=True).collect()]
    assert [shown.count(u) for u in ("flat", "mixed", "deep", "open", "stray")] == [2000, 200 * 8, 300, 3, 1]


def test_references_are_decoded_once(spark):
    cells = ["A&amp;lt;B", "&lt;b&gt;", "&#60;i&#62;", "&#38;amp;", "W&oacute;jcik&nbsp;&amp;c", "&quot;x&#39;", "&AMP;lt;", "&unknown; & &amp"]
    page = "<table>" + "".join(f"<tr><td>{c}</td></tr>" for c in cells) + "</table>"
    t = H.page_tables(spark.createDataFrame([("u", page)], "url string, html string")).first()
    got = spark.createDataFrame([(i, r) for i, r in enumerate(t.rows_html)], "i int, r string").select("i", H.row_texts(F.col("r")).alias("t")).orderBy("i").collect()
    assert [r.t[0] for r in got] == ["A&lt;B", "<b>", "<i>", "&amp;", "Wójcik &c", "\"x'", "&lt;", "&unknown; & &amp"]
