"""Link resolution against the standard library, page bases, and rows that the scans leave out."""

import random
from urllib.parse import urljoin

from pyspark.sql import functions as F

from podium.functions.text import absolute_url, page_base
from podium.sources import html_tables as H

BASES = ["http://h", "http://h/", "http://h/a", "http://h/a/", "http://h/a/b/c.html", "https://h.example:8080/a//b/c?x=1/2#f/g", "http://h/a/../b/c",
         "HTTP://H/a/b", "http://h?q", "http://h/a/b/./"]


def test_absolute_url_equals_urljoin(spark):
    rng = random.Random(1)
    segments = ["x", "..", ".", "", "y.html", "a b", "..."]
    refs = ["", "#f", "?q=1", "?q=../x#f", "//o.example/p/../q", "/", "/x", "/x/../y", "/../x", "http://z/a/../b", "mailto:a@b", "http:x/y", "http:", "./", "../",
            "../../..", "./x", "x/./y/../z", "x?y=../z", "x#../z", " ../x", "x//y", "//", "javascript:void(0)", ";p", "x;p=1/../y"]
    refs += ["/".join(rng.choice(segments) for _ in range(rng.randrange(1, 6))) + rng.choice(["", "?a=/../b", "#c/.."]) for _ in range(300)]
    rows = [(b, h) for b in BASES for h in refs]
    got = spark.createDataFrame(rows, "b string, h string").select("b", "h", absolute_url("h", "b").alias("u")).collect()
    assert [(r.b, r.h, r.u) for r in got if r.u != urljoin(r.b, r.h)] == []


def test_page_base(spark):
    rows = [("<a href=x>", "http://h/a/b"), ("<head><BASE target=_top href='/c/d/'></head>", "http://h/a/b"), ('<base href="../e/">', "http://h/a/b"),
            ("<base href=https://o.example/x&amp;y/>", "http://h/a/b"), ("<base target=x>", "http://h/a/b"), (None, "http://h/a/b")]
    got = spark.createDataFrame(rows, "p string, u string").select(page_base("p", F.col("u")).alias("b")).collect()
    assert [r.b for r in got] == ["http://h/a/b", "http://h/c/d/", "http://h/e/", "https://o.example/x&y/", "http://h/a/b", "http://h/a/b"]


HEAD = "<tr><th>Lp</th><th>Nazwisko i imię</th><th>Okręg</th><th>Razem</th></tr>"


def test_result_rows_are_accepted_or_rejected_with_a_reason(spark):
    body = ["<td>1</td><td>Ala</td><td>D</td><td>100</td>", "<td>2</td>", "<td>3</td><td> &nbsp; </td><td>D</td><td>9</td>",
            "<td>Lp</td><td>NAZWISKO I IMIĘ</td><td>Okręg</td><td>Razem</td>", "<td>4</td><td>Ola</td><td>D</td><td>dnf</td>", "<td>5</td><td>Ela</td><td>D</td>",
            "<td>6</td><td>Iza</td><td>D</td><td></td>", "<td>7</td><td>Ewa</td><td>D</td><td>1,250</td>"]
    page = f"<table>{HEAD}" + "".join(f"<tr>{r}</tr>" for r in body) + "</table>"
    pages = spark.createDataFrame([("u", page), ("v", "<p>none</p>"), ("w", None)], "url string, html string")
    rows = H.result_rows(pages)
    accepted = H.extract_results(pages)
    assert sorted((r.player, r.score) for r in accepted.collect()) == [("Ala", 100.0), ("Ewa", 1250.0)]
    rejected = sorted((r.row_no, r.reason, r.detail) for r in H.rejected_rows(rows).collect())
    assert rejected == [(2, "short_row", ""), (3, "blank_player", ""), (4, "repeated_header", "NAZWISKO I IMIĘ"), (5, "bad_score", "dnf"), (6, "no_score", ""),
                        (7, "no_score", "")]
    assert rows.count() == len(body)


def test_schedule_rows_and_links_with_dots_and_base(spark):
    head = "".join(f"<th>{h}</th>" for h in ("Lp", "Nazwa zawodów", "ZO PZŁ", "Strzelnica", "Data zawodów", "Wyniki"))
    line = lambda n, link: f"<tr><td>{n}</td><td>E{n}</td><td>Z</td><td>S</td><td>16.05.2026</td><td>{link}</td></tr>"
    lines = line(1, "<a href='../r/./1'>w</a>") + line(2, "brak") + "<tr><td>x</td></tr>" + line(3, "<a href='brak:x'>brak</a>") + line(4, "http://o.example/4 ok")
    page = f"<head><base href='/s/t/'></head><table><tr>{head}</tr>{lines}</table>"
    rows = H.schedule_rows(spark.createDataFrame([("s", page)], "url string, html string"), "https://h.example/x").collect()
    assert [(r.row_no, r.results_url, r.reason, r.detail) for r in sorted(rows, key=lambda r: r.row_no)] == [
        (1, "https://h.example/s/r/1", None, None), (2, "", "no_link", "brak"), (3, None, "short_row", ""), (4, "brak:x", "no_results", "brak"),
        (5, "http://o.example/4", None, None)]
