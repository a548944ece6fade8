"""Every operator on a zero-row typed input returns zero rows with its full schema."""

import pytest

from conftest import results_frame
from podium.plans import boards, profile, report
from podium.plans import qualification as Q
from podium.sources import html_tables as H

W = {"final": ("2026-08-01", "2026-09-09"), "championship": ("2026-05-16", "2026-08-16")}

CASES = {
    "average_board": (lambda r: boards.average_board(r), 8),
    "award_board": (lambda r: boards.award_board(r), 11),
    "team_board": (lambda r: boards.team_board(r), 11),
    "starts": (lambda r: Q.starts_table(r), 15),
    "qualification_board": (lambda r: Q.qualification_board(r, W), 25),
    "championship_board": (lambda r: Q.window_board(r, W["championship"]), 13),
    "weakness_summary": (lambda r: profile.weakness_summary(Q.starts_table(r)), 14),
    "weakness_nested": (lambda r: profile.weakness_nested(Q.starts_table(r)), 9),
    "sorted_board": (lambda r: report.sort_rows(Q.qualification_board(r, W), "mean_top3", "desc"), 26),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_empty_input(spark, name):
    fn, ncols = CASES[name]
    empty = results_frame(spark, [{"player": "A", "score": 1.0}]).limit(0)
    out = fn(empty)
    assert out.count() == 0
    assert len(out.columns) == ncols, out.columns


def test_empty_pages(spark):
    pages = spark.createDataFrame([], "url string, html string")
    assert H.extract_results(pages).count() == 0
    assert H.schedule_events(pages, "https://h.example/").count() == 0
