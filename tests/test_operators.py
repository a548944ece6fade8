from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import results_frame
from podium.operators import best_per_group, first_per_key, leaderboard, leaderboards, top_n_per_group, union_by_name
from podium.operators.windows import window_membership, windows_frame


def test_best_per_group_first_row_wins_ties(spark):
    df = results_frame(spark, [{"player": "A", "district": "X", "event_name": "E1", "score": s} for s in (430, 440, 440)])
    out = best_per_group(df, ["player", "district", "event_name"],
                         [F.col("score").desc(), F.col("row_seq").asc()]).collect()
    assert [r["row_seq"] for r in out] == [2]


def test_first_per_key(spark):
    df = spark.createDataFrame([("u1", 3, "c"), ("u1", 1, "a"), ("u2", 2, "b")], "url string, row_seq int, v string")
    got = sorted((r["url"], r["v"]) for r in first_per_key(df, "url").collect())
    assert got == [("u1", "a"), ("u2", "b")]


def test_top_n_plans_window_group_limit(spark):
    df = results_frame(spark, [{"player": "A", "score": float(s)} for s in range(10)])
    out = top_n_per_group(df, ["player"], [F.col("score").desc()], 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sorted(r["score"] for r in out.collect()) == [7.0, 8.0, 9.0]


def test_leaderboard_matches_naive_with_heavy_ties(spark):
    rows = [(i, i % 7, f"p{i % 101:03d}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, s int, name string")
    order = [F.col("s").desc(), F.col("name").asc(), F.col("id").asc()]
    got = leaderboard(df, order, partitions=5)
    naive = df.withColumn("naive", F.row_number().over(Window.orderBy(*order)))
    joined = got.join(naive.select("id", "naive"), "id")
    assert joined.filter(F.col("place") != F.col("naive")).count() == 0
    assert got.count() == 3000
    assert sorted(r["place"] for r in got.select("place").collect()) == list(range(1, 3001))


def test_leaderboard_rank_if_and_empty(spark):
    df = spark.createDataFrame([(1, True, 5.0), (2, False, 9.0), (3, True, 7.0)], "id int, ok boolean, s double")
    out = leaderboard(df, [F.col("ok").desc(), F.col("s").desc(), F.col("id")], rank_if=F.col("ok"))
    small = leaderboard(df, [F.col("ok").desc(), F.col("s").desc(), F.col("id")], rank_if=F.col("ok"))
    assert {r["id"]: r["place"] for r in small.collect()} == {3: 1, 1: 2, 2: None}
    assert {r["id"]: r["place"] for r in out.collect()} == {3: 1, 1: 2, 2: None}
    empty = leaderboard(df.limit(0), [F.col("s").desc(), F.col("id")])
    assert empty.count() == 0 and empty.columns == ["place", "id", "ok", "s"]


def test_union_by_name_widens(spark):
    a = spark.createDataFrame([(1, "x")], "n int, a string")
    b = spark.createDataFrame([(2.5, "y")], "n double, b string")
    out = union_by_name(a, b)
    assert dict(out.dtypes)["n"] == "double"
    assert sorted((r["n"], r["a"], r["b"]) for r in out.collect()) == [(1.0, "x", None), (2.5, None, "y")]


def test_window_membership_overlapping(spark):
    df = spark.createDataFrame([("u1", "01.06.2026"), ("u2", "10.08.2026"), ("u3", "TBA")], "url string, date_text string")
    w = windows_frame(spark, {"a": ("2026-05-16", "2026-08-16"), "b": ("2026-08-01", "2026-09-09")})
    got = sorted((r["url"], r["window_id"]) for r in window_membership(df, w).collect())
    assert got == [("u1", "a"), ("u2", "a"), ("u2", "b")]


def test_leaderboards_small_and_range_agree(spark):
    df = spark.createDataFrame([(i, i % 5, (i * 7) % 11) for i in range(200)], "id int, a int, b int")
    specs = [("pa", [F.col("a").desc(), F.col("id")], None), ("pb", [F.col("b").asc(), F.col("id").desc()], None)]
    small = {r["id"]: (r["pa"], r["pb"]) for r in leaderboards(df, specs).collect()}
    big = {r["id"]: (r["pa"], r["pb"]) for r in leaderboards(df, specs, partitions=3).collect()}
    assert small == big and len(small) == 200


def test_pivot_unpivot_nest(spark):
    from podium.operators import nest_rows, pivot_ordinals, unpivot_measures
    df = spark.createDataFrame([("T", 1, "a"), ("T", 2, "b"), ("U", 1, "c")], "d string, n int, p string")
    wide = {r["d"]: r for r in df.groupBy("d").agg(*pivot_ordinals("n", "p", 3, "player_")).collect()}
    assert (wide["T"]["player_1"], wide["T"]["player_2"], wide["T"]["player_3"]) == ("a", "b", None)
    m = spark.createDataFrame([("x", 1.0, None)], "id string, m_skeet double, m_lane double")
    long = unpivot_measures(m, ["id"], ["m_skeet", "m_lane", "m_trap"])
    assert sorted((r["code"], r["value"]) for r in long.collect() if r["value"] is not None) == [("m_skeet", 1.0)]
    nested = nest_rows(df, ["d"], ["n", "p"], "items", sort_key=["n"]).filter("d = 'T'").first()["items"]
    assert [x["p"] for x in nested] == ["a", "b"]


def test_leaderboards_evaluate_their_input_once(spark):
    """With ``by`` each row is made once, however many places there are; the result is the same."""
    made = spark.sparkContext.accumulator(0)

    def see(batches):
        for rows in batches:
            made.add(len(rows))
            yield rows

    rows = [(i, i * 7 % 5, None if i % 4 == 0 else f"x{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "id long, v long, text string")
    specs = [("pb", [F.col("v").asc(), F.col("id").desc()], None), ("pa", [F.col("v").desc(), F.col("id").asc()], F.col("v") > 1)]
    want = sorted(map(tuple, leaderboards(df, specs).collect()), key=lambda r: r[2])
    got = leaderboards(df.mapInPandas(see, df.schema), specs, partitions=3, by=["id", "v"])
    assert got.columns == ["pa", "pb", "id", "v", "text"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[2]) == want
    assert made.value == len(rows)


def test_chunked_concat_with_counts_and_firsts(spark):
    from podium.operators.groupwise import chunked_concat

    rows = [(k, n, None if n == 3 else f"{k}{n}", float(n)) for k in ("a", None) for n in range(1, 8 if k else 3)]
    df = spark.createDataFrame(rows, "k string, n long, text string, v double")
    got = {r.k: (r.t, r.c, r.s, r.b) for r in chunked_concat(df, ["k"], "text", "n", "t", sep=" ", size=2, rows_as="c", first={
        "s": F.sum("v"), "b": F.max(F.when(F.col("n") == 2, F.col("v")))}).collect()}
    assert got == {"a": ("a1 a2 a4 a5 a6 a7", 7, 3.0, 2.0), None: ("None1 None2", 2, 3.0, 2.0)}
