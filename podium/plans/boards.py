"""All-season leaderboards over ``results``.

Each board costs one shuffle on its group keys (partial aggregation map-side)
plus the range shuffle of ``leaderboard`` for the global place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium import constants as K
from podium.functions.bands import threshold_band
from podium.functions.text import half_even
from podium.operators.groupwise import leaderboard, nth_largest, ordered_concat, top_n_per_group
from podium.operators.reshape import pivot_ordinals

desc = lambda c: F.col(c).desc_nulls_last()
asc = lambda c: F.col(c).asc_nulls_last()


def scored(results: DataFrame, score: str = "score") -> DataFrame:
    """Rows with a score (repeated defensively before every standings)."""
    return results.filter(F.col(score).isNotNull())


def average_board(results: DataFrame) -> DataFrame:
    """Per player x district: mean (2 dec.), total, starts, best, worst; place by
    mean, best, starts, total (then player, district)."""
    board = (scored(results).groupBy("player", "district").agg(
        half_even(F.avg("score"), 2).alias("mean_score"),
        F.sum("score").alias("total_score"),
        F.count("score").alias("starts"),
        F.max("score").alias("best_score"),
        F.min("score").alias("worst_score")))
    return leaderboard(board, [desc("mean_score"), desc("best_score"), desc("starts"), desc("total_score"),
                               asc("player"), asc("district")])


def with_category(results: DataFrame) -> DataFrame:
    """Category from the table ordinal: table 1 -> 'K', otherwise 'M'."""
    return results.withColumn("category", F.when(F.col("table_no").cast("int") == 1, F.lit(K.CATEGORY_FIRST_TABLE))
                              .otherwise(F.lit(K.CATEGORY_OTHER_TABLES)))


def award_board(results: DataFrame, ladders=None) -> DataFrame:
    """Sum of the best three scores per player x district x category, the three
    scores, the events counted, and the award band; place by sum, best, count."""
    keys = ["player", "district", "category"]
    top3 = top_n_per_group(with_category(scored(results)), keys, [desc("score"), asc("row_seq")], 3)
    board = top3.groupBy(*keys).agg(
        F.sum("score").alias("sum_top3"),
        F.count("score").alias("counted"),
        F.max("score").alias("best_score"),
        nth_largest("score", "rn", 2).alias("second_score"),
        nth_largest("score", "rn", 3).alias("third_score"),
        ordered_concat("event_name", "rn").alias("events_counted"))
    board = board.withColumn("award", threshold_band("sum_top3", "category", ladders))
    return leaderboard(board, [desc("sum_top3"), desc("best_score"), desc("counted"),
                               asc("player"), asc("district"), asc("category")])


def team_players(results: DataFrame, team_size: int = 6) -> DataFrame:
    """Per district x player: mean (2 dec.), starts, best, total and the rank in
    the district; only the best ``team_size`` players of each district."""
    players = scored(results).groupBy("district", "player").agg(
        half_even(F.avg("score"), 2).alias("player_mean"),
        F.count("score").alias("starts"),
        F.max("score").alias("best_score"),
        F.sum("score").alias("total_score"))
    return top_n_per_group(players, ["district"],
                           [desc("player_mean"), desc("best_score"), desc("starts"), desc("total_score"),
                            asc("player")], team_size, rn="rank_in_district") \
        .withColumn("rank_in_district", F.col("rank_in_district").cast("bigint"))


def team_board(results: DataFrame, team_size: int = 6) -> DataFrame:
    """Per district over its best players: mean and sum of the players' rounded
    means (exact, in hundredths), member count and the roster pivoted to
    ``player_1 .. player_<team_size>`` in one aggregation; place by mean, count, sum."""
    members = team_players(results, team_size).withColumn(
        "hundredths", F.rint(F.col("player_mean") * 100).cast("bigint"))
    board = members.groupBy("district").agg(
        F.sum("hundredths").alias("__h"),
        F.count("player").alias("members"),
        *pivot_ordinals("rank_in_district", "player", team_size, "player_"))
    board = board.select(
        "district",
        (F.rint(F.col("__h") / F.col("members")) / 100).alias("team_mean"),
        "members",
        (F.col("__h") / 100).alias("team_sum"),
        *[f"player_{k}" for k in range(1, team_size + 1)])
    return leaderboard(board, [desc("team_mean"), desc("members"), desc("team_sum"), asc("district")])
