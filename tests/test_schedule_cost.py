"""What the schedule scan of the run counters moves and repeats (F3)."""

from pyspark.sql import functions as F

from podium.functions.text import absolute_url, page_base
from podium.plans import registry, rendering
from podium.sources import html_tables as H
from podium.sources.page_scan import Table, _marked_texts, row_texts

EVENTS = [("1997", 3, str(k), f"Event {k}", "NATION_1", "Range 1", f"{k % 27 + 1:02d}.05.1997", f"u/{k}") for k in range(1, 130)]
COLUMNS = "season string, schedule_table_no int, schedule_lp string, event_name string, organizer string, venue string, date_text string, results_url string"


def test_columns_are_dealt_and_not_their_html(spark):
    pages = rendering.schedule_pages(spark.createDataFrame(EVENTS, COLUMNS))
    above, below = pages._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")
    assert "<td>" in above and "<td>" not in below
    rows = H.schedule_rows(pages, rendering.BASE_URL).where("reason IS NULL").collect()
    assert {r.results_url for r in rows} == {f"https://results.example/u/{k}" for k in range(1, 130)}
    assert len(rows) == len(EVENTS) + sum(k % 5 == 0 for k in range(1, 130))


def test_only_the_asked_cell_leaves_with_the_texts():
    html = "<tr><td>A</td><td>B</td><td>C</td></tr><tr><td>1</td><th>x</th><td><a href='/u'>2</a></td><td>3</td></tr><tr><td>4</td></tr>"
    assert Table(html, cell="B").data_cells == [{"texts": ["1", "2", "3"], "cell": "<a href='/u'>2</a></td>"}, {"texts": ["4"], "cell": None}]


def test_plain_cells_read_like_marked_ones():
    for row in ("<td>a  b</td><td>&amp;lt;</td></tr>", "<td>x</td><td class='c'>y<br>z</td>", "<td>a > b</td>\n<TD>c</TD>", "x<b>y</b><td>z</td>",
                "<td>a <a href='<td>'>q</a></td>", "<td>5 < 6</td><td>7</td>", "", "<td></td><td/>", "<td>a</td></th><th>b</td>"):
        for sep in ("", " "):
            assert row_texts(row, sep) == _marked_texts(row, sep), row


def test_usual_links_like_all_others(spark):
    """A tab before a link is dropped and sends it the general way."""
    bases = ["https://h.example/a/b?c#d", "HTTP://H.example", "schedule/1", "", None]
    links = ["/u/1", "/u//2/", "/a.b/c.html", "/a/../b", "/./a", "/a/.b", "//x/y", "/", "/ü", "/a b", "/a?b#c", "https://x.example/../a b", "HTTP://x", "mailto:a",
             "http:a", "a:b//c", "https://x\n", "/u\n"]
    rows = spark.createDataFrame([(x, b) for x in links for b in bases], "href string, base string")
    out = rows.select("href", "base", absolute_url("href", "base").alias("got"), absolute_url(F.concat(F.lit("\t"), "href"), "base").alias("want"))
    assert not [r for r in out.collect() if r.got != r.want]
    base = spark.createDataFrame([("<p><BaSe  href='/q/'>",), ("<basement href='/q'>",)], "h string").select(page_base("h", F.lit("https://h/a")).alias("b"))
    assert [r.b for r in base.collect()] == ["https://h/q/", "https://h/a"]


def test_dates_of_events_are_parsed_once(spark, tmp_path):
    spark.createDataFrame([(0, "N0", 0), (3, "nation_3", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(13, "Customer#000000013", 3)], "c_custkey long, c_name string, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(k, 13, "O", 1000.0 * k, f"1998-0{k}-05", "1-URGENT") for k in range(1, 8)], "o_orderkey long, o_custkey long, o_orderstatus string, "
                          "o_totalprice double, o_orderdate string, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 1, 5.0)], "l_orderkey long, l_linenumber int, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 1, "purchase", 7.0, '{"k": 3}')], "event_id long, user_id long, event_type string, value double, props string") \
        .write.parquet(f"{tmp_path}/events.parquet")
    got = {r.metric: r.value for r in registry.q_run_metrics(spark, str(tmp_path)).collect()}
    assert got == {"results": 7, "players": 1, "schedule_tables": 4, "events": 7, "events_in_period": 7, "district_events": 8}
    read = " ".join(registry.q_events_with_starts(spark, str(tmp_path)).inputFiles())
    assert "period-events" in read and "bound-events" not in read
