"""Groups of any size: numbers, lists and profiles where one player holds nine tenths of the rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from podium.operators.groupwise import chunked_concat, chunked_list, ordered_concat, running_number, segmented_number
from podium.plans.profile import discipline_profile


@pytest.fixture(scope="module")
def hot(spark):
    rng = random.Random(9)
    rows = [(None if i % 97 == 0 else "hot" if rng.random() < 0.9 else f"p{rng.randrange(60)}", None if i % 53 == 0 else rng.randrange(40), i) for i in range(20_000)]
    return spark.createDataFrame(rows, "player string, score int, seq long").repartition(8).cache()


def test_segmented_number_equals_the_window(spark, hot):
    order = [F.col("score").desc_nulls_last(), F.col("seq").asc()]
    got = segmented_number(hot, ["player"], order, "n", partitions=64)
    want = hot.withColumn("n", running_number(["player"], order).cast("bigint"))
    assert got.columns == ["player", "score", "seq", "n"]
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    # the written copy cuts the large group: no partition of it holds a fiftieth of the rows
    files = spark.read.parquet(*got.inputFiles()).groupBy("__pid").count().agg(F.max("count")).first()[0]
    assert files < hot.count() / 50
    # and the numbering moves (partition, player) pieces, not players
    lines = got._jdf.queryExecution().executedPlan().toString().split("\n")
    window = next(i for i, line in enumerate(lines) if "Window [" in line)
    assert "hashpartitioning(__pid" in next(line for line in lines[window:] if "Exchange" in line)


def test_segmented_number_small_cases(spark):
    empty = spark.createDataFrame([], "k string, v int")
    assert segmented_number(empty, ["k"], ["v"]).collect() == []
    one = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "k string, v int")
    assert sorted(map(tuple, segmented_number(one, ["k"], [F.col("v").desc()], "n", partitions=3).collect())) == [("a", 1, 2), ("a", 2, 1), ("b", 5, 1)]
    two = spark.createDataFrame([("a", None, i) for i in range(40)] + [("a", 1, i) for i in range(40)], "k string, l int, v int")
    got = segmented_number(two, ["k", "l"], ["v"], "n", partitions=7).collect()
    assert all(r.n == r.v + 1 for r in got) and len(got) == 80


@pytest.mark.parametrize("size", [1, 7, 1024])
def test_chunked_assembly_equals_one_step(hot, size):
    numbered = hot.withColumn("n", F.row_number().over(Window.partitionBy("player").orderBy("seq"))).withColumn("text", F.col("score").cast("string"))
    want = {r.player: r.t for r in numbered.groupBy("player").agg(ordered_concat("text", "n").alias("t")).collect()}
    got = {r.player: r.t for r in chunked_concat(numbered, ["player"], "text", "n", "t", size=size).collect()}
    assert got == want
    lists = {r.player: r.l for r in chunked_list(numbered, ["player"], F.col("seq"), "n", "l", size=size).collect()}
    assert all(v == sorted(v) for v in lists.values()) and sum(map(len, lists.values())) == hot.count()


def test_profile_cuts_a_player_before_the_shuffle(spark):
    rng = random.Random(4)
    rows = [("hot" if rng.random() < 0.9 else "p", "D", f"e{i:05}", float(rng.randrange(400)), 500.0, 50.0, "", float(rng.randrange(-1, 90))) for i in range(3000)]
    starts = spark.createDataFrame(rows, "player string, district string, event_name string, score double, event_best double, pct_of_best double, date_text string, m_trap double")
    out = discipline_profile(starts)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # three rows a player and discipline leave a map task; nothing else of a player meets in a window
    assert plan.count("Window [") == 1 and "Partial, " in plan.replace("Partial\n", "Partial, ")
    got = {r.player: r for r in out.collect()}
    for name in ("hot", "p"):
        order = sorted((r for r in rows if r[0] == name), key=lambda r: (-r[3], r[1], r[2]))
        done = [r[7] for r in order if r[7] > 0]
        r = got[name]
        assert (r.starts, r.best, r.last) == (len(done), max(done), done[-1])
        assert r.trend == pytest.approx(sum(done[-3:]) / 3 - sum(done[:-3]) / (len(done) - 3))
