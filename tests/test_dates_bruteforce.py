"""The date parser on texts generated from known dates: each piece states the dates that it means."""

import datetime as dt
import random

from pyspark.sql import functions as F

from podium.functions import dates
from podium.functions.dates import parse_event_dates

WORDS = ["Puchar", "w dniu", "oraz", "godz. 9:00", "(sobota)", "runda II", "hala 3", "tel. 123"]


def _day(rng):
    return dt.date(rng.choice([1999, 2024, 2026, 2027, 2028]), rng.randint(1, 12), rng.randint(1, 28))


def _pad(rng, n):
    return str(n).zfill(rng.choice([1, 2]))


def _iso(rng):
    d = _day(rng)
    return f"{d.year}-{_pad(rng, d.month)}-{_pad(rng, d.day)}", 0, [d]


def _day_range(rng):
    d = _day(rng)
    last = d.replace(day=rng.randint(1, 28))
    text = f"{_pad(rng, d.day)}{rng.choice(['-', '–', ' - ', ' – '])}{_pad(rng, last.day)}.{_pad(rng, d.month)}.{d.year}"
    return text, 1, [d, last]


def _cross_month(rng):
    d, e = _day(rng), _day(rng)
    d = d.replace(year=e.year)
    text = f"{_pad(rng, d.day)}.{_pad(rng, d.month)}{rng.choice([' - ', '–', ' – '])}{_pad(rng, e.day)}.{_pad(rng, e.month)}.{e.year}"
    return text, 2, [d, e]


def _single(rng):
    d = _day(rng)
    sep = rng.choice([".", "/"])
    return f"{_pad(rng, d.day)}{sep}{_pad(rng, d.month)}{sep}{d.year}", 3, [d]


def _impossible(rng):
    return rng.choice(["31.02.2026", "0.05.2026", "2026-13-01", "15.00.2027", "99.99.2024"]), 4, []


def test_dates_of_generated_texts(spark):
    rng = random.Random(17)
    rows, want = [], []
    for i in range(1500):
        made = [rng.choice([_iso, _day_range, _cross_month, _single, _impossible])(rng) for _ in range(rng.randint(0, 3))]
        text = rng.choice(["", " ", "Puchar "])
        for piece, _, _ in made:
            text += f"{piece}, {rng.choice(WORDS)}{rng.choice([' ', chr(0xa0), '  '])}"
        # a range that ends in a full date also shows that date as a single one; forms are listed in
        # the order ISO, day range, cross month, single
        dates = [d for kind in range(4) for _, k, ds in made if k == kind for d in ds]
        dates += [ds[1] for _, k, ds in made if k in (1, 2)]
        rows.append((i, text))
        want.append(dates)
    df = spark.createDataFrame(rows, "i int, t string").select("i", parse_event_dates("t").alias("d"))
    for r in df.collect():
        assert set(r.d) == set(want[r.i]) and len(r.d) == len(set(r.d)), rows[r.i]
        isos = [d for d in r.d[: len(set(want[r.i]))]]
        assert sorted(isos) == sorted(set(want[r.i]))


def test_forms_come_in_order(spark):
    text = "1.06.2026 3-4.05.2026 2025-12-31 30.04–2.05.2026"
    got = spark.createDataFrame([(text,)], "t string").select(parse_event_dates("t").alias("d")).first().d
    assert got[:5] == [dt.date(2025, 12, 31), dt.date(2026, 5, 3), dt.date(2026, 5, 4), dt.date(2026, 4, 30), dt.date(2026, 5, 2)]
    assert got[5:] == [dt.date(2026, 6, 1)]


def test_each_pattern_stands_once_in_the_plan(spark):
    df = spark.createDataFrame([("1.1.2026",)], "t string").select(parse_event_dates("t").alias("d")).where(F.size("d") > 0)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?U)\\b(\\d{4})-(\\d{1,2})-(\\d{1,2})\\b") <= 2  # the projection, and the filter pushed below it


def test_whole_texts_are_read_without_the_four_searches(spark):
    """A text that is one date or range gives what the searches give, and the searches are not run for it."""
    rng = random.Random(5)
    rows = []
    for _ in range(2500):
        n = rng.choice([2, 3, 3, 4, 4, 5, 5, 6])
        pieces = [str(rng.choice([rng.randint(0, 32), rng.randint(0, 32), rng.randint(0, 12), 2026, 1, 123])) for _ in range(n)]
        if rng.random() < 0.7:
            pieces[0 if rng.random() < 0.2 else -1] = rng.choice(["2024", "2026", "0000", "0001", "9999"])
        rows.append(("".join(p + rng.choice([".", ".", ".", "-", "/", "–", " - ", " – ", "- ", " "]) for p in pieces[:-1]) + pieces[-1],))
    for _ in range(1200):  # the shapes themselves, with days and months that may not exist
        day = lambda: f"{rng.randint(0, 32)}{rng.choice('./-')}{_pad(rng, rng.randint(0, 13))}"
        front = rng.choice(["", _pad(rng, rng.randint(0, 32)), day()])
        rows.append((front + (rng.choice(["-", "–", " - ", " –"]) if front else "") + day() + rng.choice("./-") + rng.choice(["2026", "0000", "2024"]),))
    rows += [("٢-٣.٠٥.2026",), ("16.05.2026\n",), ("1 -  2.05.2026",), ("",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    cleaned = dates.clean_text("t")
    known = F.element_at(F.transform(F.array(cleaned), dates._searched_dates), 1)
    valid = F.array_distinct(F.filter(known, lambda x: x.isNotNull() & (x >= F.lit("0001-01-01").cast("date"))))
    both = df.select("t", parse_event_dates("t").alias("got"), F.coalesce(valid, F.array().cast("array<date>")).alias("want")).collect()
    assert [(r.t, r.got) for r in both] == [(r.t, r.want) for r in both]
    whole = df.where(cleaned.rlike(dates._WHOLE) | cleaned.rlike(dates._WHOLE_ISO)).count()
    assert 300 < whole < len(rows)
