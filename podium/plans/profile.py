"""Per-player weakness profile over the starts table.

Input order matters: "last" and "trend" follow the order of the starts
(default: player, score descending, then district, event), which makes the
"last" value the lowest-scoring start, not the latest one.  Pass another
``order`` (e.g. the parsed event date) for a chronological reading.

Plan: figures are partial aggregates per (player, discipline); "last" and the last three values are the
top three in reversed order, cut to three a map task before they are shuffled.  No task sorts a whole player.
Positions (flat outputs, event references) are segmented numbers.  Only completed (> 0) values count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium import constants as K
from podium.functions.text import trend_label
from podium.operators.groupwise import chunked_list, leaderboard, nth_largest, segmented_number, top_n_per_group

DEFAULT_ORDER = ("-score", "district", "event_name")


def _order_cols(order) -> list[Column]:
    """Names (``-`` prefix = descending, nulls last) or Column sort expressions."""
    out = []
    for o in order:
        if isinstance(o, str):
            out.append(F.col(o[1:]).desc_nulls_last() if o.startswith("-") else F.col(o).asc_nulls_last())
        else:
            out.append(o)
    return out


def _discipline_attr(code: Column, idx: int, default=None) -> Column:
    expr = None
    for i, d in enumerate(K.DISCIPLINES):
        val = F.lit(d[idx] if idx >= 0 else i + 1)
        expr = F.when(code == d[0], val) if expr is None else expr.when(code == d[0], val)
    return expr.otherwise(F.lit(default))


def _reversed(order: Sequence[str]) -> list[Column]:
    """The order of names backwards."""
    return [F.col(o[1:]).asc_nulls_first() if o.startswith("-") else F.col(o).desc_nulls_first() for o in order]


def _named(starts: DataFrame) -> DataFrame:
    """Starts keyed by the trimmed player name; blank names are left out."""
    return starts.withColumn("player", F.trim(F.coalesce(F.col("player").cast("string"), F.lit("")))).filter(F.col("player") != "")


def positioned(starts: DataFrame, order: Sequence = DEFAULT_ORDER) -> DataFrame:
    """Starts keyed by the trimmed player name with their 1-based position."""
    return segmented_number(_named(starts), ["player"], _order_cols(order), "pos")


def discipline_long(starts: DataFrame, order: Sequence = DEFAULT_ORDER) -> DataFrame:
    """Completed discipline values, long form: player, pos, code, label, value, max_score, disc_ord."""
    codes = [d[0] for d in K.DISCIPLINES if d[0] in starts.columns]
    df = positioned(starts, order)
    long = df.select("player", "pos", *[F.col(c).cast("double").alias(c) for c in codes]) \
        .unpivot(["player", "pos"], codes, "code", "value")
    long = long.filter(F.col("value") > 0)
    return long.select(
        "player", "pos", "code",
        _discipline_attr(F.col("code"), 1).alias("label"),
        "value",
        _discipline_attr(F.col("code"), 2).cast("double").alias("max_score"),
        _discipline_attr(F.col("code"), -1).cast("int").alias("disc_ord"))


def _reference(df: DataFrame) -> tuple[Column, Column, Column]:
    """Score, event best and percent of a start as its event reference has them."""
    score = F.when(F.col("score") > 0, F.col("score").cast("double"))
    best = F.when(F.col("event_best") > 0, F.col("event_best").cast("double"))
    return score, best, F.coalesce(F.col("pct_of_best").cast("double"), score / best * 100)


def _by_code(starts: DataFrame, order: Sequence = DEFAULT_ORDER) -> DataFrame:
    """Aggregates per (player, code): discipline figures for codes; under the code '' the number of starts and the
    event-reference figures.

    The mean before the last three values follows from the sums and counts of all and of the last three."""
    codes = [d[0] for d in K.DISCIPLINES if d[0] in starts.columns]
    if all(isinstance(o, str) for o in order):
        df, last_first = _named(starts), list(order)
    else:  # expressions cannot be turned round: their positions can
        df, last_first = positioned(starts, order), ["pos"]
    score, best, pct = _reference(df)
    entries = F.array(
        F.struct(F.lit("").alias("code"), F.lit(None).cast("double").alias("value")),
        *[F.struct(F.lit(c).alias("code"), F.col(c).cast("double").alias("value")) for c in codes])
    keys = list(dict.fromkeys(o.removeprefix("-") for o in last_first))
    # order columns keep names of their own: a discipline may be one of them
    long = df.select("player", *[F.col(k).alias(f"__o_{k}") for k in keys], score.alias("ref_score"), best.alias("ref_best"), pct.alias("ref_pct"),
                     F.inline(entries).alias("code", "value"))
    completed = (F.col("code") != "") & (F.col("value") > 0)
    ref_ok = ((F.col("code") == "") & F.col("ref_score").isNotNull() & F.col("ref_best").isNotNull() & F.col("ref_pct").isNotNull())
    v = F.when(completed, F.col("value"))
    totals = long.groupBy("player", "code").agg(
        F.count(v).alias("starts"), F.sum(v).alias("__sum"), F.max(v).alias("best"), F.count(F.lit(1)).alias("__rows"),
        F.sum(F.when(ref_ok, F.rint(F.col("ref_pct") * 10))).alias("__tenths"), F.count(F.when(ref_ok, F.lit(1))).alias("__refs"))
    backwards = _reversed([o.replace(o.removeprefix("-"), "__o_" + o.removeprefix("-")) for o in last_first])
    top = top_n_per_group(long.where(completed).select("player", "code", "value", *[f"__o_{k}" for k in keys]), ["player", "code"], backwards, 3)
    recent = top.groupBy(F.col("player").alias("__p"), F.col("code").alias("__c")).agg(
        nth_largest("value", "rn", 1).alias("last"), F.sum("value").alias("__last3"), F.count(F.lit(1)).alias("__n3"))
    g = totals.join(recent, (F.col("player") == F.col("__p")) & (F.col("code") == F.col("__c")), "left")
    return g.select(
        "player", "code", "starts", F.when(F.col("starts") > 0, F.col("__sum") / F.col("starts")).alias("mean"),
        "best", "last", (F.col("__last3") / F.col("__n3")).alias("__recent"),
        F.when(F.col("starts") > 3, (F.col("__sum") - F.col("__last3")) / (F.col("starts") - 3)).alias("__earlier"),
        "__rows", "__tenths", "__refs",
        _discipline_attr(F.col("code"), 1).alias("label"),
        _discipline_attr(F.col("code"), 2).cast("double").alias("max_score"),
        _discipline_attr(F.col("code"), -1).cast("int").alias("disc_ord"))


def _profile_cols() -> list[Column]:
    return [
        "player", "code", "label", "disc_ord", "starts", "mean", "best", "last",
        (F.col("mean") / F.col("max_score") * 100).alias("mean_pct"),
        (F.col("max_score") - F.col("mean")).alias("gap_to_max"),
        F.greatest(F.lit(0.0), F.col("best") - F.col("mean")).alias("reserve_to_best"),
        (F.col("__recent") - F.col("__earlier")).alias("trend")]


def discipline_profile(starts: DataFrame, order: Sequence = DEFAULT_ORDER) -> DataFrame:
    """Per player x discipline: starts, mean, best, last, mean % of max, gap to
    max, reserve to own best, trend (mean of the last three minus mean of the
    earlier ones; NULL with three values or fewer)."""
    g = _by_code(starts, order)
    return g.filter((F.col("code") != "") & (F.col("starts") > 0)).select(*_profile_cols())


def event_refs(starts: DataFrame, order: Sequence = DEFAULT_ORDER) -> DataFrame:
    """Per start with a positive score and event best: (player, pos, event, date,
    score, event_best, pct); pct falls back to score / best * 100."""
    df = positioned(starts, order)
    score, best, pct = _reference(df)
    return df.select(
        "player", "pos",
        F.coalesce(F.col("event_name").cast("string"), F.lit("")).alias("event"),
        F.coalesce(F.col("date_text").cast("string"), F.lit("")).alias("date"),
        score.alias("score"), best.alias("event_best"), pct.alias("pct")) \
        .filter(F.col("score").isNotNull() & F.col("event_best").isNotNull() & F.col("pct").isNotNull())


def event_refs_ordered(starts: DataFrame, order: Sequence = DEFAULT_ORDER) -> DataFrame:
    """Event references numbered by pct ascending (input order on ties)."""
    return segmented_number(event_refs(starts, order), ["player"], [F.col("pct").asc(), F.col("pos").asc()], "ref_ord")


def _per_player(starts: DataFrame, order: Sequence) -> DataFrame:
    g = _by_code(starts, order)
    disc = F.when((F.col("code") != "") & (F.col("starts") > 0), F.struct(
        (F.col("mean") / F.col("max_score") * 100).alias("mean_pct"),
        (F.col("mean") - F.col("max_score")).alias("neg_gap"),
        F.col("disc_ord"), F.col("code"), F.col("label"), F.col("starts"), F.col("mean"), F.col("best"),
        F.col("last"), (F.col("max_score") - F.col("mean")).alias("gap_to_max"),
        F.greatest(F.lit(0.0), F.col("best") - F.col("mean")).alias("reserve_to_best"),
        (F.col("__recent") - F.col("__earlier")).alias("trend")))
    start_row = F.col("code") == ""
    aggs = [
        F.array_sort(F.collect_list(disc)).alias("disciplines"),
        F.max(F.when(start_row, F.col("__rows"))).alias("starts"),
        F.max(F.when(start_row & (F.col("__refs") > 0), F.col("__tenths") / F.col("__refs") / 10))
        .alias("mean_event_pct"),
    ]
    return g.groupBy("player").agg(*aggs).filter(F.size("disciplines") > 0)


def weakness_summary(starts: DataFrame, order: Sequence = DEFAULT_ORDER) -> DataFrame:
    """One row per player with at least one completed discipline: weakest
    discipline, its figures and trend text, total gap, mean %, mean event pct,
    all-starts count, and the report rank (weakest mean % ascending, total gap
    descending, player)."""
    p = _per_player(starts, order)
    # sums over at most five disciplines, folded in the report's order
    out = p.select(
        "player", "starts",
        F.col("disciplines")[0].alias("w"),
        F.aggregate("disciplines", F.lit(0.0), lambda acc, x: acc + x["gap_to_max"]).alias("overall_gap"),
        (F.aggregate("disciplines", F.lit(0.0), lambda acc, x: acc + x["mean_pct"])
         / F.size("disciplines")).alias("mean_pct"),
        "mean_event_pct")
    out = out.select(
        "player", "starts",
        F.col("w.code").alias("weakest_code"), F.col("w.label").alias("weakest_label"),
        F.col("w.mean").alias("weakest_mean"), F.col("w.mean_pct").alias("weakest_mean_pct"),
        F.col("w.gap_to_max").alias("weakest_gap"), F.col("w.reserve_to_best").alias("weakest_reserve"),
        F.col("w.trend").alias("weakest_trend"), trend_label(F.col("w.trend")).alias("trend_text"),
        "overall_gap", "mean_pct", "mean_event_pct")
    ranked = leaderboard(out.withColumn("__neg_gap", -F.col("overall_gap")),
                         [F.col("weakest_mean_pct").asc(), F.col("__neg_gap").asc(), F.col("player").asc()],
                         place="report_rank")
    return ranked.drop("__neg_gap")


def weakness_nested(starts: DataFrame, order: Sequence = DEFAULT_ORDER, ranked: bool = True) -> DataFrame:
    """The nested report: player, starts, weakest (struct), disciplines (array of
    structs, weakest first), event_refs (array, by pct), mean event pct, total gap, mean %,
    and with ``ranked`` the report rank (weakest mean % ascending, total gap descending, player)."""
    item = F.struct("pos", "event", "date", "score", "event_best", "pct")
    lists = chunked_list(event_refs_ordered(starts, order), ["player"], item, "ref_ord", "__r")
    p = _per_player(starts, order).join(lists, "player", "left")
    disc = F.transform("disciplines", lambda x: F.struct(
        x["code"].alias("code"), x["label"].alias("label"), x["starts"].alias("starts"), x["mean"].alias("avg"),
        x["best"].alias("best"), x["last"].alias("last"), x["mean_pct"].alias("avg_pct"),
        x["gap_to_max"].alias("improvement_to_max"), x["reserve_to_best"].alias("reserve_to_best"),
        x["trend"].alias("trend")))
    refs = F.coalesce(F.col("__r"), F.array())
    refs_arr = F.transform(refs, lambda x: F.struct(
        x["event"].alias("event"), x["date"].alias("date"), x["score"].alias("score"),
        x["event_best"].alias("event_best"), x["pct"].alias("pct")))
    # the mean event percentage sums in input order, as a plain loop would
    in_order = F.array_sort(F.transform(refs, lambda x: F.struct(x["pos"].alias("p"), x["pct"].alias("v"))))
    out = p.select(
        "player", "starts",
        disc[0].alias("weakest"),
        disc.alias("disciplines"),
        refs_arr.alias("event_refs"),
        F.when(F.size(refs) > 0, F.aggregate(in_order, F.lit(0.0), lambda a, x: a + x["v"]) / F.size(refs))
        .alias("avg_event_pct"),
        F.aggregate("disciplines", F.lit(0.0), lambda a, x: a + x["gap_to_max"]).alias("overall_gap"),
        (F.aggregate("disciplines", F.lit(0.0), lambda a, x: a + x["mean_pct"]) / F.size("disciplines"))
        .alias("avg_pct"))
    if not ranked:
        return out
    keyed = out.withColumn("__pct", F.col("weakest.avg_pct")).withColumn("__neg_gap", -F.col("overall_gap"))
    return leaderboard(keyed, [F.col("__pct").asc(), F.col("__neg_gap").asc(), F.col("player").asc()],
                       place="report_rank").drop("__pct", "__neg_gap")
