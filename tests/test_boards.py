
from conftest import results_frame
from podium.plans import boards
from podium.plans import qualification as Q
from podium.plans.profile import discipline_profile, weakness_nested, weakness_summary

W = {"final": ("2026-08-01", "2026-09-09"), "championship": ("2026-05-16", "2026-08-16")}


def test_event_best_and_pct(spark):
    df = results_frame(spark, [
        {"player": "A", "district": "X", "event_name": "E1", "score": 430.0},
        {"player": "A", "district": "X", "event_name": "E1", "score": 440.0},
        {"player": "A", "district": "X", "event_name": "E1", "score": 440.0},
        {"player": "B", "district": "Y", "event_name": "E1", "score": 460.0},
        {"player": "C", "district": "X", "event_name": "E0", "score": 0.0}])
    st = {(r["player"], r["event_name"]): r for r in Q.starts_table(df, "x").collect()}
    a = st[("A", "E1")]
    assert (a["score"], a["event_best"], a["pct_of_best"]) == (440.0, 460.0, 95.7)
    c = st[("C", "E0")]
    assert c["event_best"] is None and c["pct_of_best"] is None
    assert ("B", "E1") not in st


def _window_rows(scores, player="P", date="20.08.2026"):
    return [{"player": player, "district": "X", "event_name": f"E{i}", "score": float(s), "date_text": date}
            for i, s in enumerate(scores)]


def test_top_five_and_means(spark):
    df = results_frame(spark, _window_rows([450, 440, 440, 430, 420, 410]) + _window_rows([400, 390], "Q"))
    b = {r["player"]: r for r in Q.qualification_board(df, W).collect()}
    p = b["P"]
    assert [p[f"best_{k}"] for k in range(1, 6)] == [450, 440, 440, 430, 420]
    assert (p["sum_top3"], p["mean_top3"], p["mean_top5_first"], p["counted"], p["starts"]) == \
        (1330, 443.33, 436.0, 5, 6)
    assert len(p["events_top3"].split(" | ")) == 3
    q = b["Q"]
    assert (q["sum_top3"], q["mean_top3"], q["best_3"], q["best_5"]) == (790, 395.0, None, None)


def test_places_ties_and_full_outer(spark):
    rows = _window_rows([400, 300], "B") + _window_rows([400, 300], "A") + \
        _window_rows([500], "Z", "01.06.2026")
    b = {r["player"]: r for r in Q.qualification_board(results_frame(spark, rows), W).collect()}
    assert (b["A"]["place"], b["B"]["place"]) == (1, 2)
    assert b["Z"]["place"] is None and b["Z"]["champ_place"] == 1
    assert b["Z"]["sum_top3"] is None and b["Z"]["counted"] is None


def test_team_board(spark):
    rows = [{"player": f"p{m}", "district": "T7", "score": float(m)} for m in (90, 80, 70, 60, 50, 40, 30)] + \
           [{"player": f"q{m}", "district": "T2", "score": float(m)} for m in (10, 20)]
    out = {r["district"]: r for r in boards.team_board(results_frame(spark, rows)).collect()}
    t7 = out["T7"]
    assert (t7["team_mean"], t7["team_sum"], t7["members"]) == (65.0, 390.0, 6)
    assert [t7[f"player_{k}"] for k in range(1, 7)] == ["p90", "p80", "p70", "p60", "p50", "p40"]
    t2 = out["T2"]
    assert (t2["player_1"], t2["player_2"], t2["player_3"], t2["player_6"]) == ("q20", "q10", None, None)
    assert (t7["place"], t2["place"]) == (1, 2)


def test_team_mean_of_rounded_means(spark):
    rows = [{"player": "a", "district": "T", "score": s} for s in (33.0, 33.0, 34.0)] + \
           [{"player": "b", "district": "T", "score": 10.0}]
    out = boards.team_board(results_frame(spark, rows)).first()
    assert out["team_mean"] == 21.66 and out["team_sum"] == 43.33


def test_award_board(spark):
    rows = [{"player": "A", "district": "X", "table_no": 1, "score": s} for s in (500.0, 480.0, 470.0, 100.0)] + \
           [{"player": "A", "district": "X", "table_no": 2, "score": 300.0}]
    out = {r["category"]: r for r in boards.award_board(results_frame(spark, rows)).collect()}
    k = out["K"]
    assert (k["sum_top3"], k["counted"], k["second_score"], k["third_score"]) == (1450.0, 3, 480.0, 470.0)
    assert k["award"] == "złoty Wawrzyn Strzelecki z diamentem" and k["place"] == 1
    assert out["M"]["third_score"] is None and out["M"]["award"] == ""


def test_average_board_empty_keeps_schema(spark):
    df = results_frame(spark, [{"player": "A", "score": 1.0}]).limit(0)
    out = boards.average_board(df)
    assert out.count() == 0
    assert out.columns == ["place", "player", "district", "mean_score", "total_score", "starts", "best_score",
                           "worst_score"]


def test_weakness_profile(spark):
    vals = [95, 90, 85, 70, 0, None]
    rows = [{"player": "P", "district": "X", "event_name": f"E{i}", "score": 500.0 - i, "m_skeet": v}
            for i, v in enumerate(vals)]
    starts = Q.starts_table(results_frame(spark, rows))
    prof = {r["code"]: r for r in discipline_profile(starts).collect()}
    s = prof["m_skeet"]
    assert (s["starts"], s["mean"], s["best"], s["last"], s["mean_pct"], s["gap_to_max"], s["reserve_to_best"]) == \
        (4, 85.0, 95.0, 70.0, 85.0, 15.0, 10.0)
    assert abs(s["trend"] - ((90 + 85 + 70) / 3 - 95)) < 1e-12
    summ = weakness_summary(starts).first()
    assert summ["weakest_code"] == "m_skeet" and summ["starts"] == 6 and summ["report_rank"] == 1
    nested = weakness_nested(starts).first()
    assert nested["weakest"]["code"] == "m_skeet" and len(nested["event_refs"]) == 6


def test_weakness_absent_and_declared_order(spark):
    rows = [{"player": "N", "score": 10.0},
            {"player": "T", "event_name": "E1", "score": 10.0, "m_lane": 50.0, "m_skeet": 50.0}]
    summ = {r["player"]: r for r in weakness_summary(Q.starts_table(results_frame(spark, rows))).collect()}
    assert "N" not in summ
    assert summ["T"]["weakest_code"] == "m_skeet" and summ["T"]["weakest_trend"] is None
