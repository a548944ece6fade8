"""Pages are read in one pass inside a task; the pass gives what the column expressions give."""

import pytest

from podium.sources import html_tables as H
from pyspark.sql import functions as F

HEAD = "<tr><th>Lp</th><th>Nazwisko i imię</th><th>Okręg</th><th>Razem</th></tr>"
ROWS = ["<td>a</td><TD class='x'> b&nbsp;c </TD><th>d</th>", "<td>1 < 2</td><td>3 > 2</td>", "<td title='<b>'>a<b>c</b></td><td>", "<td>a\u0001b</td><td>c</td>",
        "<td>&lt;i&gt; &amp;amp; &quot;x&apos;</td><tdx>y</tdx><td/>z", "x<td>  a b\x1cc\u0085d \n</td>", "<td>a<br>b<p>c</td", "<tĥ>a</tĥ><tdĥ>b", ""]


@pytest.mark.parametrize("sep", ["", " "])
def test_cell_texts(spark, sep):
    from podium.sources.page_scan import row_texts
    df = spark.createDataFrame([(i, r) for i, r in enumerate(ROWS)], "i int, r string").select("i", H.row_texts(F.col("r"), sep).alias("t"))
    assert [r.t for r in df.orderBy("i").collect()] == [row_texts(r, sep) for r in ROWS]


def test_pages_are_read_once_and_only_what_is_asked_leaves_the_task(spark, capsys):
    pages = spark.createDataFrame([("u", f"<table>{HEAD}<tr><td>1</td><td>Ala</td><td>D</td><td>100</td></tr></table>")], "url string, html string")
    for frame in (H.extract_results(pages), H.schedule_rows(pages, "https://h.example/"), H.result_tables(pages, parts=())):
        frame.explain()
        plan = capsys.readouterr().out
        assert plan.count("MapInArrow") == 1
    assert set(H.result_tables(pages, parts=()).columns) == {"url", "table_no", "labels", "canonical", "missing", "accepted"}


def test_many_pages_in_small_batches(spark, monkeypatch):
    """What has been found leaves the task in pieces: pages keep their tables, pages without any their row."""
    from podium.sources import html_tables
    monkeypatch.setattr(html_tables, "BATCH_CHARS", 300)
    one = lambda i: f"<table>{HEAD}<tr><td>{i}</td><td>P{i}</td><td>D</td><td>{i}</td></tr></table>" * (i % 3)
    pages = spark.createDataFrame([(f"u{i}", one(i) or None) for i in range(50)], "url string, html string").coalesce(1)
    got = sorted((r.url, r.table_no, r.score) for r in H.extract_results(pages).collect())
    assert got == sorted((f"u{i}", n + 1, float(i)) for i in range(50) for n in range(i % 3))
    assert H.result_tables(pages, keep_pages=True).where("table_no is null").count() == 17


def test_spans_and_headers(spark):
    page = ("<table><thead><tr><td rowspan=2>Lp</td><td rowspan=2>Nazwisko i imię</td><td colspan=2>x</td></tr><tr><td>Okręg</td><td>Razem</td></tr></thead>"
            "<tr><td>1</td><td>Ala</td><td rowspan='2'>D</td><td>9</td></tr><tr><td>2</td><td>Ola</td><td>8</td></tr><tr><td colspan=2>Ela</td><td>E</td><td>7</td></tr></table>")
    got = sorted(tuple(r) for r in H.extract_results(spark.createDataFrame([("u", page)], "url string, html string")).select("row_no", "player", "district", "score").collect())
    assert got == [(1, "Ala", "D", 9.0), (2, "Ola", "D", 8.0), (3, "Ela", "E", 7.0)]
