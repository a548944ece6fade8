import json

from pyspark.sql import functions as F

from podium.plans import report as R


def test_search_rows(spark):
    df = spark.createDataFrame([("Łoś",), ("Ala",), (None,)], "player string")
    assert [r["player"] for r in R.search_rows(df, ["player"], " łoś ").collect()] == ["Łoś"]
    assert R.search_rows(df, ["player"], "  ").count() == 3


def test_sort_rows_text_polish_and_digits(spark):
    df = spark.createDataFrame([(n, i) for i, n in enumerate(["Zyta", "Łoś", "ala", "Las", "Ąb", "10.x", "2.x"])],
                               "name string, i int")
    out = R.sort_rows(df, "name", "asc", input_order=[F.col("i")])
    got = [r["name"] for r in out.orderBy("position").collect()]
    assert got == ["2.x", "10.x", "ala", "Ąb", "Las", "Łoś", "Zyta"]


def test_sort_rows_missing_last_both_directions(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 7.0)], "i int, v double")
    for d, expected in (("asc", [1, 3, 2]), ("desc", [3, 1, 2])):
        out = R.sort_rows(df, "v", d, input_order=[F.col("i")])
        assert [r["i"] for r in out.orderBy("position").collect()] == expected
    plain = R.sort_rows(df, "v", "asc", input_order=[F.col("i")], missing_last=False)
    assert [r["i"] for r in plain.orderBy("position").collect()] == [2, 1, 3]


def test_json_records(spark):
    df = spark.createDataFrame([(1.0, None, "a<b & \"c\" ł", 2.5, 3)], "x double, y double, s string, z double, n int")
    line = R.json_records(df).first()["json"]
    assert line == '{"x": 1, "y": "", "s": "a\\u003cb \\u0026 \\"c\\" ł", "z": 2.5, "n": 3}'
    back = json.loads(line)
    assert back == {"x": 1, "y": "", "s": 'a<b & "c" ł', "z": 2.5, "n": 3}


def test_flags_and_top_six(spark):
    rows = [(p, f"P{p}", None if p > 7 else p, c, float(10 - p)) for p, c in
            [(1, None), (2, 3), (3, 1), (4, None), (5, None), (6, 2), (7, None), (8, 4)]]
    board = spark.createDataFrame(rows, "k int, player string, place bigint, champ_place bigint, mean_top3 double") \
        .withColumn("district", F.lit("D"))
    flags = {r["player"]: r for r in R.qualification_flags(board).collect()}
    assert flags["P6"]["is_final"] and not flags["P7"]["is_final"] and flags["P3"]["is_championship"]
    assert not flags["P8"]["is_final"] and not flags["P8"]["is_championship"]
    assert [r["player"] for r in R.top_six(board).orderBy("position").collect()] == [f"P{i}" for i in range(1, 7)]


def test_sort_rows_range_path_with_collated_key(spark):
    names = ["Zyta", "Łoś", "ala", "Las", "Ąb", "10.x", "2.x"] * 30
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, i int")
    small = {r["i"]: r["position"] for r in R.sort_rows(df, "name", "desc", input_order=[F.col("i")]).collect()}
    big = {r["i"]: r["position"] for r in R.sort_rows(df, "name", "desc", input_order=[F.col("i")],
                                                      partitions=4).collect()}
    assert small == big


def test_default_directions():
    assert R.default_direction("standings", "place") == "asc"
    assert R.default_direction("standings", "mean_top3") == "desc"
    assert R.default_direction("starts", "score") == "desc"
    assert R.default_direction("starts", "player") == "asc"
    assert R.default_direction("events", "date_text") == "asc"


def test_json_records_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"), -0.0)], "x double, y double")
    assert R.json_records(df).first()["json"] == '{"x": "", "y": 0}'
