"""Window qualification for one district (or all): best start per event,
percent of the event best, best-N per window, places, and the merged board.

Plan shape: D6 (one row per player x district x event) -> window flags as
columns, written once -> the first window by segmented numbers and chunks (its best
rows and the joined list of all starts in one pass), so that no task sorts all starts
of one player, the second by its top rows (cut in the map tasks) -> one groupBy over the
union, written once -> two range-partitioned places over the sort columns, joined back.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.functions.dates import parse_event_dates
from podium.functions.text import half_even
from podium.operators.groupwise import (CHUNK, best_per_group, chunked_concat, leaderboard, leaderboards, nth_largest, ordered_concat,
                                       running_number, segmented_number, top_n_per_group)
from podium.operators.partitioning import evaluate_once
from podium.operators.windows import window_flags
from podium.plans.boards import asc, desc, scored
from podium.session import scratch_path

START_COLUMNS = ["player", "district", "event_name", "score", "event_best", "pct_of_best", "klass",
                 "date_text", "venue", "results_url"]
MEASURES = ["m_skeet", "m_lane", "m_trap", "m_boar", "m_buck"]


def district_filter(df: DataFrame, district: str | None) -> DataFrame:
    """Case- and edge-space-insensitive district predicate (None keeps all)."""
    if district is None:
        return df
    return df.filter(F.lower(F.trim(F.col("district"))) == F.lit(district.strip().lower()))


def event_best(results: DataFrame, event_key: str = "event_name") -> DataFrame:
    """Best positive score of every event over all districts (zeros never count)."""
    return (scored(results).filter(F.col("score") > 0)
            .groupBy(event_key).agg(F.max("score").alias("event_best")))


def best_starts(results: DataFrame, district: str | None = None, event_key: str = "event_name") -> DataFrame:
    """One start per player x district x event: the highest score, earliest row on ties."""
    df = district_filter(scored(results), district)
    return best_per_group(df, ["player", "district", event_key], [desc("score"), asc("row_seq")])


def starts_table(results: DataFrame, district: str | None = None, event_key: str = "event_name") -> DataFrame:
    """Starts with the event best (over all districts) and percent of it (1 dec.)."""
    s = best_starts(results, district, event_key).join(event_best(results, event_key), event_key, "left")
    s = s.withColumn("pct_of_best", half_even(F.col("score") / F.col("event_best") * 100, 1))
    measures = [m for m in MEASURES if m in results.columns]
    return s.select(*START_COLUMNS, *measures)


def qualification_board(results: DataFrame, windows: Mapping[str, tuple], district: str | None = None,
                        first: str = "final", second: str = "championship", top: int = 5,
                        event_key: str = "event_name") -> DataFrame:
    """Merged board: window ``first`` ranks by the sum of the best three of the
    best five starts; window ``second`` by the sum of the best five; players of
    only one window keep NULLs on the other side (full-outer semantics)."""
    s = best_starts(results, district, event_key).select(
        "player", "district", event_key, "score", "date_text")
    s = window_flags(evaluate_once(s.withColumn("dates", parse_event_dates("date_text"))),
                     {first: windows[first], second: windows[second]})
    s = evaluate_once(s.drop("dates"))
    f1, f2 = "in_" + first, "in_" + second
    s = s.filter(F.col(f1) | F.col(f2))
    order = [desc("score"), asc("date_text"), asc(event_key)]
    # four reads of the same starts: one written copy instead of four date parses
    path = scratch_path(results.sparkSession, "window-starts")
    s.write.mode("errorifexists").parquet(path)
    s = results.sparkSession.read.parquet(path)
    keys = ["player", "district"]
    in1, in2 = s.filter(f1), s.filter(f2)
    # the list of all starts needs a number for every row; the best of the first window are read off the same numbers
    numbered = segmented_number(in1.select(*keys, "score", "date_text", event_key), keys, order)
    best = lambda n: F.when(F.col("rn") <= n, F.col("score"))
    part1 = chunked_concat(numbered, keys, event_key, "rn", "all_starts", size=max(CHUNK, top), rows_as="__starts", first={
        "sum_top3": F.sum(best(min(top, 3))),
        "__sum_top_first": F.sum(best(top)),
        "__n1": F.count(F.when(F.col("rn") <= top, F.lit(1))),
        **{f"best_{k}": F.max(F.when(F.col("rn") == k, best(top))) for k in range(1, 6)},
        "events_top3": ordered_concat(event_key, "rn", min(top, 3))})
    # ranks up to ``top`` are cut in the map tasks
    best2 = top_n_per_group(in2, keys, order, top).groupBy(*keys).agg(
        F.sum("score").alias("champ_sum_top5"),
        F.count(F.lit(1)).alias("__n2"),
        F.max("score").alias("__champ_best"),
        *[nth_largest("score", "rn", k).alias(f"champ_best_{k}") for k in range(1, 6)],
        ordered_concat(event_key, "rn").alias("champ_events"))
    # each part has one row per key: their union grouped once is the full outer join of both, null keys included
    g = part1.unionByName(best2, allowMissingColumns=True)
    g = g.groupBy(*keys).agg(*[F.max(c).alias(c) for c in g.columns if c not in keys])
    g = g.withColumn("__n1", F.coalesce("__n1", F.lit(0))).withColumn("__n2", F.coalesce("__n2", F.lit(0)))
    has1, has2 = F.col("__n1") > 0, F.col("__n2") > 0
    g = g.select(
        "player", "district", "sum_top3",
        half_even(F.col("sum_top3") / F.least(F.col("__n1"), F.lit(3)), 2).alias("mean_top3"),
        half_even(F.col("__sum_top_first") / F.col("__n1"), 2).alias("mean_top5_first"),
        F.when(has1, F.col("__n1")).alias("counted"),
        F.when(has1, F.col("__starts")).alias("starts"),
        *[f"best_{k}" for k in range(1, 6)],
        "champ_sum_top5",
        half_even(F.col("champ_sum_top5") / F.col("__n2"), 2).alias("champ_mean_top5"),
        F.when(has2, F.col("__n2")).alias("champ_counted"),
        F.col("__champ_best"),
        *[f"champ_best_{k}" for k in range(1, 6)],
        F.when(has1, F.col("events_top3")).alias("events_top3"),
        F.when(has2, F.col("champ_events")).alias("champ_events"),
        F.when(has1, F.col("all_starts")).alias("all_starts"),
        has1.alias("__has1"), has2.alias("__has2"))
    g = leaderboards(g, [
        ("champ_place", [F.col("__has2").desc(), desc("champ_sum_top5"), desc("__champ_best"), desc("champ_counted"),
                         asc("player"), asc("district")], F.col("__has2")),
        ("place", [F.col("__has1").desc(), desc("sum_top3"), desc("best_1"), desc("starts"),
                   asc("player"), asc("district")], F.col("__has1"))],
        by=["player", "district", "sum_top3", "best_1", "starts", "champ_sum_top5", "__champ_best", "champ_counted", "__has1", "__has2"])
    return g.select(
        "place", "player", "district", "sum_top3", "mean_top3", "mean_top5_first", "counted", "starts",
        *[f"best_{k}" for k in range(1, 6)],
        "champ_place", "champ_sum_top5", "champ_mean_top5", "champ_counted",
        *[f"champ_best_{k}" for k in range(1, 6)],
        "events_top3", "champ_events", "all_starts")


def window_board(results: DataFrame, window: tuple, district: str | None = None, top: int = 5,
                 event_key: str = "event_name") -> DataFrame:
    """Single-window best-``top`` board (the championship board on its own):
    sum, count, best, best 1..top, events, mean (2 dec.); place by sum, best, count."""
    s = best_starts(results, district, event_key).select("player", "district", event_key, "score", "date_text")
    s = window_flags(evaluate_once(s.withColumn("dates", parse_event_dates("date_text"))), {"w": window})
    s = evaluate_once(s.drop("dates")).filter(F.col("in_w"))
    s = s.withColumn("rn", running_number(["player", "district"], [desc("score"), asc("date_text"), asc(event_key)])) \
        .filter(F.col("rn") <= top)
    g = s.groupBy("player", "district").agg(
        F.sum("score").alias("sum_top"),
        F.count("score").alias("counted"),
        F.max("score").alias("best_score"),
        *[nth_largest("score", "rn", k).alias(f"best_{k}") for k in range(1, top + 1)],
        ordered_concat(event_key, "rn").alias("events_counted"))
    g = g.withColumn("mean_top", half_even(F.col("sum_top") / F.col("counted"), 2))
    return leaderboard(g, [desc("sum_top"), desc("best_score"), desc("counted"), asc("player"), asc("district")])


def events_with_starts(events: DataFrame, starts: DataFrame) -> DataFrame:
    """Events having at least one start, matched on the results URL (left semi)."""
    urls = starts.select("results_url").filter(F.col("results_url").isNotNull())
    return events.join(urls, "results_url", "left_semi").select(*events.columns)
