import os

from podium.operators.windows import events_in_period, window_hull
from podium.plans import bindings as B
from podium.plans import rendering
from podium.plans.runs import qualification_run, season_run
from podium.sources.html_tables import crawl_order, extract_results, with_lineage
from podium.sources.tables import read_tables

SF = "/root/testdata/sf0.001"


def test_season_run(spark, tmpdir_path):
    res = B.results(spark, SF)
    paths = season_run(spark, rendering.result_pages(res), B.events(spark, SF), os.path.join(tmpdir_path, "s"))
    assert set(paths) == {"results", "average", "award", "team", "team_members"}
    assert spark.read.parquet(paths["results"]).count() == res.count()
    assert spark.read.parquet(paths["award"]).count() > 0


def test_qualification_run(spark, tmpdir_path):
    res = B.results(spark, SF)
    out = os.path.join(tmpdir_path, "q")
    period = events_in_period(B.events(spark, SF), *window_hull(B.WINDOWS))
    paths = qualification_run(spark, rendering.result_pages(res), B.events(spark, SF), B.WINDOWS, out,
                              district=None, supplement=B.supplement_raw(spark, SF),
                              supplement_event=B.SUPPLEMENT_EVENT, district_label="NATION_3")
    standings = spark.read.parquet(paths["standings"])
    assert standings.count() > 0 and "champ_place" in standings.columns
    metrics = {r["metric"]: r["value"] for r in spark.read.parquet(paths["run_metrics"]).collect()}
    assert metrics["events_in_period"] <= metrics["events"]
    assert spark.read.text(paths["standings_json"]).count() == standings.count() == metrics["players"]
    assert spark.read.parquet(paths["starts"]).count() == metrics["district_starts"]
    assert spark.read.parquet(paths["events"]).count() == metrics["district_events"]
    assert read_tables(spark, out, ["standings"])["standings"].count() == standings.count()
    extracted = with_lineage(extract_results(rendering.result_pages(res)), crawl_order(period)).count()
    assert metrics["events_in_period"] == period.count() and metrics["results"] >= extracted


def test_qualification_run_without_table_export(spark, tmpdir_path):
    res = B.results(spark, SF)
    out = os.path.join(tmpdir_path, "q2")
    paths = qualification_run(spark, rendering.result_pages(res), B.events(spark, SF), B.WINDOWS, out,
                              district="nation_3", export_tables=False)
    assert "standings" not in paths and not os.path.exists(os.path.join(os.path.dirname(paths["weakness"]), "standings"))
    assert os.path.exists(paths["standings_json"]) and "run_metrics" in paths
