"""Registered queries over the bound tables (used by the driver and by bench)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from podium.functions.dates import dates_to_iso, parse_event_dates
from podium.functions.text import absolute_url, clean_text, first_link, format_number, null_to_text, split_names
from podium.operators.groupwise import (chunked_concat, first_per_key, leaderboard, nth_largest, ordered_concat, segmented_number,
                                       top_n_per_group)
from podium.operators.windows import events_in_period, period_positions, window_hull, window_membership, windows_frame
from podium.plans import bindings as B
from podium.plans import boards, oracle, rendering
from podium.plans import profile as P
from podium.plans import qualification as Q
from podium.plans import report as R
from podium.plans.supplement import CSV_HEADER, supplement_rows, with_supplement
from podium.session import scratch_path, written_once
from podium.sources import html_tables as H
from podium.sources.tables import publish_tables, read_csv_text, read_tables, run_metrics

Query = Callable[[SparkSession, str], DataFrame]


def _results(spark, d):
    return B.results(spark, d)


def q_award_board(spark, d):
    return boards.award_board(_results(spark, d))


def q_average_board(spark, d):
    return boards.average_board(_results(spark, d))


def q_team_board(spark, d):
    return boards.team_board(_results(spark, d))


def q_team_members(spark, d):
    return boards.team_players(_results(spark, d))


def q_event_best(spark, d):
    return Q.event_best(_results(spark, d))


def q_best_start_per_event(spark, d):
    return Q.best_starts(_results(spark, d)).select(
        "player", "district", "event_name", "row_seq", "score", "date_text", "results_url")


def q_pct_of_best(spark, d):
    return _starts(spark, d)


def q_qualification_board(spark, d):
    return _board(spark, d)


def q_district_qualification_board(spark, d):
    """The usual run: one district, the manual supplement included."""
    res, rows, _ = B.supplement_frames(spark, d)
    return Q.qualification_board(with_supplement(res, rows), B.WINDOWS, district=B.SUPPLEMENT_DISTRICT)


def q_championship_board(spark, d):
    return Q.window_board(_results(spark, d), B.WINDOWS["championship"])


def q_window_membership(spark, d):
    r = _results(spark, d).select("results_url", "date_text")
    return window_membership(r, windows_frame(spark, B.WINDOWS)).select("results_url", "window_id")


def q_events_in_period(spark, d):
    lo, hi = window_hull(B.WINDOWS)
    return events_in_period(B.events(spark, d), lo, hi)


def _period_events(spark, d):
    """The events in the period, written once per application: their dates are parsed once for all that read them."""
    return written_once(spark, ("period-events", d.rstrip("/")), lambda: q_events_in_period(spark, d), inputs=d)


def q_period_positions(spark, d):
    """Events in the period in report order, numbered."""
    return period_positions(q_events_in_period(spark, d))


def q_crawl_order(spark, d):
    """Events in the order in which their pages are read."""
    return H.crawl_order(B.events(spark, d)).select("event_seq", "season", "date_text", "event_name", "results_url")


def q_sorted_events(spark, d):
    """The interactive sort of the events table."""
    return R.sort_rows(q_events_in_period(spark, d), "event_name", "desc", missing_last=False,
                       input_order=[F.col("date_text").asc(), F.col("results_url").asc()])


def q_parsed_dates(spark, d):
    return B.events(spark, d).select(
        "results_url", "date_text", dates_to_iso(parse_event_dates("date_text")).alias("dates_iso"), "season")


def q_supplement_known_players(spark, d):
    _, rows, _ = B.supplement_frames(spark, d)
    return rows


def q_supplement_union(spark, d):
    res, rows, _ = B.supplement_frames(spark, d)
    return with_supplement(res, rows)


def q_events_with_starts(spark, d):
    res, rows, sev = B.supplement_frames(spark, d)
    ev = _period_events(spark, d).unionByName(sev)
    starts = Q.best_starts(with_supplement(res, rows), B.SUPPLEMENT_DISTRICT)
    return Q.events_with_starts(ev, starts)


def _starts(spark, d):
    """The starts table, written once per application (every profile query reads it)."""
    return written_once(spark, ("starts", d.rstrip("/")), lambda: Q.starts_table(_results(spark, d)), inputs=d)


def q_discipline_long(spark, d):
    return P.discipline_long(_starts(spark, d))


def q_discipline_profile(spark, d):
    return P.discipline_profile(_starts(spark, d))


def q_event_refs(spark, d):
    return P.event_refs_ordered(_starts(spark, d))


def q_weakest_discipline(spark, d):
    return P.weakness_summary(_starts(spark, d))


def q_weakness_nested(spark, d):
    return P.weakness_nested(_starts(spark, d))


def q_weakness_ranks(spark, d):
    """The rank of the nested report with its sort keys."""
    return P.weakness_nested(_starts(spark, d)).select(
        "report_rank", "player", F.col("weakest.code").alias("weakest_code"), "overall_gap")


def q_weakness_nested_flat(spark, d):
    """The nested report flattened back: one row per (player, discipline in report
    order) with the player-level figures, so its structure has an exact oracle."""
    n = P.weakness_nested(_starts(spark, d), ranked=False)
    x = n.select("player", "starts", "avg_event_pct", "overall_gap", F.col("avg_pct").alias("player_avg_pct"),
                 F.size("event_refs").cast("bigint").alias("n_refs"), F.col("weakest.code").alias("weakest_code"),
                 F.posexplode("disciplines").alias("disc_rank", "x"))
    return x.select(
        "player", "starts", "avg_event_pct", "overall_gap", "player_avg_pct", "n_refs", "weakest_code",
        (F.col("disc_rank") + 1).cast("bigint").alias("disc_rank"),
        F.col("x.code").alias("code"), F.col("x.label").alias("label"), F.col("x.starts").alias("disc_starts"),
        F.col("x.avg").alias("disc_avg"), F.col("x.best").alias("disc_best"), F.col("x.last").alias("disc_last"),
        F.col("x.avg_pct").alias("disc_avg_pct"), F.col("x.improvement_to_max").alias("improvement_to_max"),
        F.col("x.reserve_to_best").alias("reserve_to_best"), F.col("x.trend").alias("trend"))


def q_weakness_nested_refs(spark, d):
    """The nested report's event references flattened back in array order."""
    n = P.weakness_nested(_starts(spark, d), ranked=False)
    x = n.select("player", F.posexplode("event_refs").alias("ref_rank", "r"))
    return x.select("player", (F.col("ref_rank") + 1).cast("bigint").alias("ref_rank"),
                    *[F.col(f"r.{c}").alias(c) for c in ("event", "date", "score", "event_best", "pct")])


def _board(spark, d):
    """The merged standings, written once per application (every report query reads it)."""
    return written_once(spark, ("standings", d.rstrip("/")),
                        lambda: Q.qualification_board(_results(spark, d), B.WINDOWS), inputs=d)


def q_report_totals(spark, d):
    lo, hi = window_hull(B.WINDOWS)
    return R.totals(_board(spark, d), events_in_period(B.events(spark, d), lo, hi))


def q_top_six(spark, d):
    return R.top_six(_board(spark, d))


def q_qualification_flags(spark, d):
    return R.qualification_flags(_board(spark, d))


def q_sorted_board(spark, d):
    return R.sort_rows(_board(spark, d), "mean_top3", "desc", input_order=R.board_order())


def q_search_board(spark, d):
    return R.search_rows(_board(spark, d), R.STANDINGS_SEARCH_KEYS, oracle.SEARCH_QUERY)


def q_search_starts(spark, d):
    return R.search_rows(_starts(spark, d), R.STARTS_SEARCH_KEYS, oracle.STARTS_QUERY)


def q_search_events(spark, d):
    lo, hi = window_hull(B.WINDOWS)
    return R.search_rows(events_in_period(B.events(spark, d), lo, hi), R.EVENTS_SEARCH_KEYS, oracle.EVENTS_QUERY)


def q_json_records(spark, d):
    return R.json_records(_board(spark, d))


def q_clean_text_docs(spark, d):
    docs = B.fact_table(spark, d, "documents")
    c = clean_text("text")
    return docs.select("doc_id", c.alias("clean_text"), F.length(c).cast("bigint").alias("clean_chars"))


def q_search_docs(spark, d):
    docs = B.table(spark, d, "documents")
    return R.search_rows(docs, ["text", "source"], oracle.DOC_QUERY).select("doc_id", "lang", "source")


def q_table_round_trip(spark, d):
    res = _results(spark, d)
    rows = H.extract_results(rendering.result_pages(res))
    out = H.with_lineage(rows, B.events(spark, d))
    return out.select("results_url", "table_no", "lp", "player", "klass", "district", "m_skeet", "m_lane",
                      "m_trap", "m_boar", "m_buck", "sub_shot", "sub_rifle", "score", "season", "event_name",
                      "date_text", "venue")


def q_ingest_issues(spark, d):
    return H.ingest_issues(rendering.result_pages(_results(spark, d)), events=B.events(spark, d))


def q_row_rejects(spark, d):
    """A12 by row: what the result and schedule scans left out, and why."""
    result = H.rejected_rows(H.result_rows(rendering.result_pages(_results(spark, d))))
    schedule = H.rejected_rows(H.schedule_rows(rendering.schedule_pages(B.events(spark, d)), rendering.BASE_URL))
    return result.unionByName(schedule)


def q_schedule_scan(spark, d):
    return H.schedule_events(rendering.schedule_pages(B.events(spark, d)), rendering.BASE_URL)


def q_page_links(spark, d):
    pages = B.fact_table(spark, d, "pages")
    return pages.select("page_id", "url", first_link(F.col("html"), F.col("url")).alias("link"))


#: Relative references of every kind, resolved against each page's own URL.
LINK_FORMS = ["../x/y.html", "./a/./b/../c", "../../../../top", "?page=9#f", "//cdn.example.org/z/../q", "/r/./s/../t/", "#end", "d//e/.."]


def q_resolved_links(spark, d):
    pages = B.fact_table(spark, d, "pages").select("page_id", "url", F.explode(F.array(*map(F.lit, LINK_FORMS))).alias("href"))
    return pages.select("page_id", "href", absolute_url("href", "url").alias("link"))


def q_start_numbers(spark, d):
    """E1 for groups of any size: every result numbered inside its district, best score first."""
    res = _results(spark, d).select("row_seq", "district", "player", "score")
    return segmented_number(res, ["district"], [F.col("score").desc_nulls_last(), F.col("row_seq").asc()])


def q_starts_joined(spark, d):
    """D8 for groups of any size: all events of a district's results in that order, joined in chunks."""
    res = _results(spark, d).select("row_seq", "district", "event_name", "score")
    numbered = segmented_number(res, ["district"], [F.col("score").desc_nulls_last(), F.col("row_seq").asc()])
    return chunked_concat(numbered, ["district"], "event_name", "rn", "all_events")


def q_nth_largest(spark, d):
    top = top_n_per_group(boards.scored(_results(spark, d)), ["player", "district"],
                          [F.col("score").desc(), F.col("row_seq").asc()], 3)
    return top.groupBy("player", "district").agg(
        *[nth_largest("score", "rn", k).alias(f"largest_{k}") for k in (1, 2, 3)])


def q_ordered_concat(spark, d):
    top = top_n_per_group(boards.scored(_results(spark, d)), ["player", "district"],
                          [F.col("score").desc(), F.col("row_seq").asc()], 3)
    return top.groupBy("player", "district").agg(ordered_concat("event_name", "rn").alias("top_events"))


def q_first_per_event(spark, d):
    return first_per_key(_results(spark, d), "event_name", "row_seq").select(
        "event_name", "row_seq", "player", "score")


def q_coerce_scores(spark, d):
    return B.coerced_props(spark, d)


def q_run_metrics(spark, d):
    """The run counters.  The pages are parsed once: the schedule rows are written, and the tables seen are observed in
    that pass; results and players come from one aggregate."""
    ev = B.events(spark, d)
    seen = Observation()
    H.schedule_rows(rendering.schedule_pages(ev), rendering.BASE_URL, seen=seen).write.mode("errorifexists") \
        .parquet(scratch_path(spark, "schedule-rows"))
    players = _results(spark, d).groupBy("player", "district").agg(F.count(F.lit(1)).alias("n"))
    both = players.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("results"), F.count(F.lit(1)).alias("players"))
    return both.selectExpr("stack(2, 'results', results, 'players', players) AS (metric, value)").unionByName(run_metrics(
        events=ev, events_in_period=_period_events(spark, d), schedule_tables=int(seen.get.get("rows", 0)),
        district_events=q_events_with_starts(spark, d)))


def q_sorted_mixed(spark, d):
    """numbers, negative numbers, exponents, blanks and words in one text column, compared pair by pair."""
    ev = B.fact_table(spark, d, "events")
    k = F.regexp_extract("props", r'"k":\s*(\d+)', 1)
    kind = F.col("event_type")
    mixed = (F.when(kind == "view", k).when(kind == "click", F.concat(F.lit("-"), k))
             .when(kind == "error", F.concat(F.lit(" "), k, F.lit("e1 ")))
             .when(kind == "purchase", F.concat(kind, F.lit(" "), k)))
    return R.sort_rows(ev.select("event_id", mixed.alias("mixed")), "mixed", "asc", missing_last=False,
                       input_order=[F.col("event_id").asc()])


def q_csv_row_places(spark, d):
    """A4: the places of CSV records over many files, and the records with too few fields."""
    raw = B.supplement_raw(spark, d)
    path = scratch_path(spark, "lines-csv")
    # records are written as lines, latest first, 500 event ids a file; every seventh lacks its last field
    line = F.concat_ws(",", F.col("row_seq").cast("string"), F.coalesce("m_skeet", F.lit("")), F.when(F.col("row_seq") % 7 != 0, F.col("score")))
    part = F.lpad((F.lit(10 ** 12) - F.floor(F.col("row_seq") / 500)).cast("string"), 13, "0").alias("part")
    lines = raw.select(part, F.col("row_seq").alias("at"), line.alias("value"))
    heads = lines.select("part").distinct().withColumns({"at": F.lit(None).cast("long"), "value": F.lit("zawodnik,krag,razem")})
    (lines.unionByName(heads).repartition("part").sortWithinPartitions("part", F.col("at").desc_nulls_first()).drop("at")
     .write.mode("errorifexists").partitionBy("part").text(path))
    out = read_csv_text(spark, path + "/*", {"zawodnik": "player", "krag": "m_skeet", "razem": "score"}, line_no="row_seq", malformed="malformed")
    return out.withColumn("malformed", F.when(F.col("malformed").isNotNull(), F.lit("short")))


def q_scalable_place(spark, d):
    res = _results(spark, d).select("row_seq", "player", "score")
    return leaderboard(res, [F.col("score").desc_nulls_last(), F.col("row_seq").asc()])


def q_display_board(spark, d):
    b = _board(spark, d)
    return b.select(
        "player", "district",
        null_to_text("place").alias("place_text"),
        null_to_text("champ_place").alias("champ_place_text"),
        format_number("mean_top3", 1).alias("mean_top3_text"),
        format_number("champ_mean_top5", 2).alias("champ_mean_text"),
        F.size(split_names("all_starts")).cast("bigint").alias("listed_starts"))


def q_sorted_starts(spark, d):
    st = _starts(spark, d)
    return R.sort_rows(st, "player", "asc", missing_last=False,
                       input_order=[F.col("player").asc(), F.col("score").desc(), F.col("district").asc(),
                                    F.col("event_name").asc()])


def q_csv_supplement(spark, d):
    """A4: the supplement written as a CSV file with its own header, read back by
    header name, then typed and filtered like any manual results file."""
    raw = B.supplement_raw(spark, d)
    inv = {v: k for k, v in CSV_HEADER.items()}
    path = scratch_path(spark, "manual-csv")
    raw.select(*[F.col(v).alias(k) for k, v in CSV_HEADER.items()]).write.mode("overwrite") \
        .option("header", True).csv(path)
    back = read_csv_text(spark, path, {inv[v]: v for v in CSV_HEADER.values()}, line_no="row_seq")
    rows = supplement_rows(back, _results(spark, d), B.SUPPLEMENT_EVENT, B.WINDOWS["championship"],
                           B.SUPPLEMENT_DISTRICT, B.SUPPLEMENT_DISTRICT_LABEL)
    return rows.drop("row_seq")


def q_table_sink_round_trip(spark, d):
    """A6/A7: the three boards written as a table set and all three read back."""
    res = _results(spark, d)
    path = scratch_path(spark, "boards")
    publish_tables(spark, path, {"average": boards.average_board(res), "award": boards.award_board(res),
                                 "team": boards.team_board(res)})
    out = None
    for name, df in read_tables(spark, path, ["average", "award", "team"]).items():
        df = df.withColumn("board", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


QUERIES: dict[str, Query] = {
    "award_board": q_award_board,
    "average_board": q_average_board,
    "team_board": q_team_board,
    "team_members": q_team_members,
    "event_best": q_event_best,
    "best_start_per_event": q_best_start_per_event,
    "pct_of_best": q_pct_of_best,
    "qualification_board": q_qualification_board,
    "district_qualification_board": q_district_qualification_board,
    "championship_board": q_championship_board,
    "window_membership": q_window_membership,
    "events_in_period": q_events_in_period,
    "period_positions": q_period_positions,
    "crawl_order": q_crawl_order,
    "sorted_events": q_sorted_events,
    "parsed_dates": q_parsed_dates,
    "supplement_known_players": q_supplement_known_players,
    "supplement_union": q_supplement_union,
    "events_with_starts": q_events_with_starts,
    "discipline_long": q_discipline_long,
    "discipline_profile": q_discipline_profile,
    "event_refs": q_event_refs,
    "weakest_discipline": q_weakest_discipline,
    "weakness_nested": q_weakness_nested,
    "weakness_ranks": q_weakness_ranks,
    "weakness_nested_flat": q_weakness_nested_flat,
    "weakness_nested_refs": q_weakness_nested_refs,
    "report_totals": q_report_totals,
    "top_six": q_top_six,
    "qualification_flags": q_qualification_flags,
    "sorted_board": q_sorted_board,
    "search_board": q_search_board,
    "search_starts": q_search_starts,
    "search_events": q_search_events,
    "json_records": q_json_records,
    "clean_text_docs": q_clean_text_docs,
    "search_docs": q_search_docs,
    "table_round_trip": q_table_round_trip,
    "ingest_issues": q_ingest_issues,
    "row_rejects": q_row_rejects,
    "schedule_scan": q_schedule_scan,
    "resolved_links": q_resolved_links,
    "start_numbers": q_start_numbers,
    "starts_joined": q_starts_joined,
    "page_links": q_page_links,
    "nth_largest": q_nth_largest,
    "ordered_concat": q_ordered_concat,
    "first_per_event": q_first_per_event,
    "coerce_scores": q_coerce_scores,
    "run_metrics": q_run_metrics,
    "sorted_mixed": q_sorted_mixed,
    "csv_row_places": q_csv_row_places,
    "scalable_place": q_scalable_place,
    "display_board": q_display_board,
    "sorted_starts": q_sorted_starts,
    "csv_supplement": q_csv_supplement,
    "table_sink_round_trip": q_table_sink_round_trip,
}

ORACLE: dict[str, str] = {k: v for k, v in oracle.queries().items() if k in QUERIES}
