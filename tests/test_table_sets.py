"""Published table sets, observed counts, places of CSV records, numeric-looking texts, exact display rounding."""

import os
import random
from functools import cmp_to_key

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from podium.functions.text import format_number, round_exact
from podium.plans.report import numeric_text, sort_rows
from podium.sources import html_tables as H
from podium.sources.tables import NewVersion, current_version, expire_versions, publish_tables, read_csv_text, read_tables


def frame(spark, n, start=0):
    return spark.range(start, start + n).toDF("x")


def values(df):
    return sorted(r.x for r in df.collect())


def test_a_failed_run_leaves_the_former_set_readable(spark, tmpdir_path):
    publish_tables(spark, tmpdir_path, {"a": frame(spark, 3), "b": frame(spark, 2)})
    bad = frame(spark, 5).select(F.raise_error(F.lit("stop")).cast("long").alias("x"))
    with pytest.raises(Exception, match="stop"):
        publish_tables(spark, tmpdir_path, {"a": frame(spark, 9), "b": bad})
    back = read_tables(spark, tmpdir_path, ["a", "b"])
    assert (values(back["a"]), values(back["b"])) == ([0, 1, 2], [0, 1]) and current_version(spark, tmpdir_path) == 1
    publish_tables(spark, tmpdir_path, {"a": frame(spark, 1, 7), "b": frame(spark, 1, 8)})
    assert current_version(spark, tmpdir_path) == 3
    # frames read before still see their own version
    assert values(back["a"]) == [0, 1, 2] and values(read_tables(spark, tmpdir_path, ["a"])["a"]) == [7]


def test_two_writers_have_folders_of_their_own_and_the_higher_number_counts(spark, tmpdir_path):
    with NewVersion(spark, tmpdir_path) as first:
        with NewVersion(spark, tmpdir_path) as second:
            second.write("a", frame(spark, 2, 20))
        first.write("a", frame(spark, 2, 10))
    assert (first.number, second.number) == (1, 2)
    assert values(read_tables(spark, tmpdir_path, ["a"])["a"]) == [20, 21]


def test_expired_versions_go_with_leftovers_and_the_newest_stay(spark, tmpdir_path):
    for n in range(3):
        publish_tables(spark, tmpdir_path, {"a": frame(spark, 1, n)})
    assert expire_versions(spark, tmpdir_path, keep=2) == [1]
    assert sorted(os.listdir(os.path.join(tmpdir_path, "versions"))) == ["0000000002", "0000000003"]
    assert values(read_tables(spark, tmpdir_path, ["a"])["a"]) == [2]
    assert expire_versions(spark, tmpdir_path + "/none") == [] and current_version(spark, tmpdir_path + "/none") is None


def test_rows_are_observed_while_written(spark, tmpdir_path):
    with NewVersion(spark, tmpdir_path) as new:
        new.write("a", frame(spark, 1000).repartition(7))
        new.write("none", frame(spark, 0))
        new.write("cut", frame(spark, 10).withColumn("p", F.col("x") % 3), partition_by=["p"])
    assert new.rows == {"a": 1000, "none": 0, "cut": 10}
    assert read_tables(spark, tmpdir_path, ["cut"])["cut"].columns == ["x", "p"]


def test_schedule_tables_are_observed_with_the_rows(spark, tmpdir_path):
    pages = spark.createDataFrame([("u", "<table><tr><td>1</td></tr></table><table><tr><td>2</td></tr></table>"), ("v", "none")], "url string, html string")
    seen = Observation()
    H.schedule_rows(pages, "https://h.example/", seen=seen).write.parquet(tmpdir_path + "/rows")
    assert seen.get["rows"] == 2


def test_csv_places_do_not_depend_on_the_splits(spark, tmpdir_path):
    want = []
    for part in range(3):
        lines = [f"p{part}-{i},{i}" + ("" if i % 50 else ",extra") for i in range(400)]
        want += [line.split(",")[0] for line in lines]
        with open(os.path.join(tmpdir_path, f"part-{part}.csv"), "w") as f:
            f.write("zawodnik,razem\n" + "\n".join(lines) + "\n")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    got = {}
    try:
        for size in ("128MB", "1KB"):
            spark.conf.set(key, size)
            df = read_csv_text(spark, tmpdir_path, {"zawodnik": "player", "razem": "score"}, line_no="n", malformed="bad")
            got[size] = [(r.n, r.player, r.bad) for r in df.orderBy("n").collect()]
    finally:
        spark.conf.set(key, before)
    assert got["128MB"] == got["1KB"] and [(n, p) for n, p, _ in got["1KB"]] == list(enumerate(want, 1))
    bad = [b for _, _, b in got["1KB"] if b is not None]
    assert len(bad) == 24 and bad[0] == "p0-0,0,extra"
    empty = read_csv_text(spark, tmpdir_path + "/nope", {"zawodnik": "player"}, line_no="n", malformed="bad")
    assert empty.columns == ["player", "n", "bad"] and empty.count() == 0


NUMERIC = {"1e3": 1000, "-3": -3, "2.5": 2.5, " 7 ": 7, "\u00a012": 12, "": 0, "  ": 0, ".5": 0.5, "5.": 5, "+4": 4, "-0": 0, "0x1F": 31, "0b101": 5,
           "0o17": 15, "007": 7, "1e-2": 0.01}
TEXTS = ["10 km", "9 km", "1e999", "NaN", "Infinity", "abc", "Abd", "a2", "a10", "--3", "1,5", "0x", "1e", "ABC"]


def test_numeric_texts(spark):
    df = spark.createDataFrame([(t,) for t in [*NUMERIC, *TEXTS, None]], "t string").select("t", numeric_text(F.col("t")).alias("v"))
    got = {r.t: r.v for r in df.collect()}
    assert got == NUMERIC | dict.fromkeys(TEXTS) | {None: 0.0}


@pytest.mark.parametrize("direction", ["asc", "desc"])
def test_mixed_column_against_the_comparator(spark, direction):
    rng = random.Random(4)
    words = ["alfa 2", "alfa 10", "Beta", "beta", "gamma 007"]
    texts = [rng.choice([*NUMERIC, *words, str(rng.randrange(-50, 50)), f"{rng.randrange(9)}e{rng.randrange(3)}"]) for _ in range(400)]

    def natural(t):
        return [(p.isdigit(), int(p) if p.isdigit() else p) for p in t.lower().split()]

    def compare(a, b):
        (_, s), (_, t) = a, b
        x, y = (None if v in words else NUMERIC[v] if v in NUMERIC else float(v) for v in (s, t))
        if x is not None and y is not None:
            c = (x > y) - (x < y)
        elif x is None and y is None:
            c = (natural(s) > natural(t)) - (natural(s) < natural(t))
        else:
            c = 1 if x is None else -1
        return c if direction == "asc" else -c

    want = [i for i, _ in sorted(enumerate(texts), key=cmp_to_key(compare))]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = sort_rows(df, "t", direction, input_order=[F.col("i").asc()], missing_last=False)
    assert [r.i for r in got.orderBy("position").collect()] == want


@pytest.mark.parametrize("digits", [0, 1, 2, 3])
def test_rounding_of_the_exact_value(spark, digits):
    rng = random.Random(digits)
    xs = [rng.uniform(-1000, 1000) for _ in range(50_000)] + [round(rng.uniform(0, 1000), digits + 1) for _ in range(40_000)]
    xs += [i / 8 for i in range(-3000, 3000)] + [i + 0.05 for i in range(3000)] + [66.35, -66.35, 0.0, 5e-324, 1e15 + 0.125, 2.0 ** 53, 1e22, 1e300, -1e300]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", round_exact("x", digits).alias("r"))
    assert [(r.x, r.r) for r in df.collect() if r.r != round(r.x, digits)] == []


def test_display_of_ties(spark):
    df = spark.createDataFrame([(66.35,), (85.25,), (0.15,), (-0.04,), (None,)], "x double").select(format_number("x", 1).alias("t"))
    assert [r.t for r in df.collect()] == [str(round(66.35, 1)).replace(".", ","), "85,2", str(round(0.15, 1)).replace(".", ","), "0", "-"]
