"""Properties (few examples each: every example runs Spark jobs)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import results_frame
from podium.operators import leaderboard
from podium.plans import boards
from podium.plans import qualification as Q

SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))

rows_strategy = st.lists(
    st.tuples(st.integers(0, 6), st.integers(0, 3), st.sampled_from(["E1", "E2", "E3", "E4"]),
              st.integers(0, 5), st.sampled_from(["10.08.2026", "01.06.2026", "20.08.2026", "TBA"])),
    min_size=1, max_size=60)


def _frame(spark, rows):
    return results_frame(spark, [
        {"player": f"p{p}", "district": f"d{d % 2}", "event_name": e, "score": float(s * 10), "date_text": t,
         "table_no": 1 + (p % 2)} for p, d, e, s, t in rows])


@SETTINGS
@given(values=st.lists(st.integers(0, 4), min_size=1, max_size=300))
def test_places_have_no_gaps_and_match_naive(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int")
    order = [F.col("v").desc(), F.col("id")]
    got = leaderboard(df, order, partitions=3)
    naive = df.withColumn("n", F.row_number().over(Window.orderBy(*order)))
    j = got.join(naive, ["id", "v"])
    assert j.filter(F.col("place") != F.col("n")).count() == 0
    assert sorted(r["place"] for r in got.collect()) == list(range(1, len(values) + 1))


@SETTINGS
@given(rows=rows_strategy)
def test_award_top3_bounded_by_total(spark, rows):
    df = _frame(spark, rows)
    aw = boards.award_board(df).withColumnRenamed("best_score", "top")
    tot = boards.with_category(df).groupBy("player", "district", "category").agg(F.sum("score").alias("total"))
    bad = aw.join(tot, ["player", "district", "category"]).filter(
        (F.col("sum_top3") > F.col("total")) | (F.col("counted") > 3))
    assert bad.count() == 0


@SETTINGS
@given(rows=rows_strategy)
def test_pct_of_best_at_most_100(spark, rows):
    st_ = Q.starts_table(_frame(spark, rows))
    assert st_.filter((F.col("score") > 0) & (F.col("pct_of_best") > 100)).count() == 0


@SETTINGS
@given(rows=rows_strategy, seed=st.integers(0, 1000))
def test_partition_permutation_does_not_change_board(spark, rows, seed):
    w = {"final": ("2026-08-01", "2026-09-09"), "championship": ("2026-05-16", "2026-08-16")}
    df = _frame(spark, rows)
    a = sorted(map(tuple, Q.qualification_board(df, w).collect()), key=repr)
    shuffled = df.repartition(3).orderBy(F.rand(seed)).repartition(5)
    b = sorted(map(tuple, Q.qualification_board(shuffled, w).collect()), key=repr)
    assert a == b
