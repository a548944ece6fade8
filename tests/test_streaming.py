import os

from pyspark.sql import functions as F

from podium.plans import bindings as B
from podium.plans import boards
from podium.plans.rendering import result_pages
from podium.sources.html_tables import crawl_order, extract_results, with_lineage
from podium.sources.tables import read_tables
from podium.streaming import refresh_boards

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_refresh_replaces_redelivered_pages_and_follows_a_grown_event_list(spark, tmpdir_path):
    res = B.results(spark, SF)
    pages = result_pages(res).cache()
    inbox, out = os.path.join(tmpdir_path, "inbox"), os.path.join(tmpdir_path, "out")
    first, second = pages.randomSplit([0.5, 0.5], seed=7)
    events = B.events(spark, SF)
    known = events.where("crc32(results_url) % 2 = 0")
    # the first delivery has wrong scores on some pages and holds one page twice
    wrong = first.withColumn("html", F.when(F.crc32("url") % 3 == 0, F.regexp_replace("html", r">(\d+)(</td>)", ">1$2")).otherwise(F.col("html")))
    wrong.write.parquet(inbox)
    refresh_boards(spark, inbox, known, out).awaitTermination()
    before = read_tables(spark, out, ["results"])["results"].count()
    assert before == first.join(known, F.col("url") == F.col("results_url")).count()
    # corrected pages come again, the rest arrives, the event list has grown
    second.unionByName(first.where("crc32(url) % 3 = 0")).write.mode("append").parquet(inbox)
    refresh_boards(spark, inbox, events, out).awaitTermination()
    want = with_lineage(extract_results(pages), crawl_order(events))
    tables = read_tables(spark, out, ["results", "average", "award", "team"])
    got = tables["results"]
    assert _rows(got) == _rows(want)
    assert got.select("row_seq").distinct().count() == got.count()
    for name, board in (("average", boards.average_board), ("award", boards.award_board), ("team", boards.team_board)):
        assert _rows(tables[name]) == _rows(board(want))
