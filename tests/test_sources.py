import os


from conftest import results_frame
from podium.plans.supplement import CSV_HEADER, known_players, supplement_events, supplement_rows, with_supplement
from podium.sources import html_tables as H
from podium.sources.tables import read_csv_text, read_tables, run_metrics, write_tables

EVENT = {"season": "2026", "event_name": "Manual", "date_text": "2026-06-13", "venue": "",
         "results_url": "manual:x", "schedule_lp": "manual-1", "organizer": "O"}
CHAMP = ("2026-05-16", "2026-08-16")


def _csv(tmpdir_path, text):
    path = os.path.join(tmpdir_path, "manual.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_supplement_csv(spark, tmpdir_path):
    path = _csv(tmpdir_path, "zawodnik,klasa,krag,mop,os,rogacz,dzik,razem\n"
                             "A  B,P,90,80,70,60,50,350\nUnknown,P,1,1,1,1,1,5\nA B,M,1,2,3,4,5,x1\n")
    raw = read_csv_text(spark, path, CSV_HEADER)
    res = results_frame(spark, [{"player": "A B", "district": " Home ", "score": 1.0}])
    rows = supplement_rows(raw, res, EVENT, CHAMP, "home", "Home").collect()
    assert len(rows) == 2 and {r["player"] for r in rows} == {"A B"}
    good = [r for r in rows if r["score"] is not None][0]
    assert (good["m_skeet"], good["m_trap"], good["score"], good["table_no"], good["district"]) == \
        (90.0, 80.0, 350.0, 2, "Home")
    union = with_supplement(res, supplement_rows(raw, res, EVENT, CHAMP, "home", "Home"))
    assert union.count() == 3 and "lp" not in raw.columns


def test_supplement_gates(spark, tmpdir_path):
    res = results_frame(spark, [{"player": "A B", "district": "Home", "score": 1.0}])
    missing = read_csv_text(spark, os.path.join(tmpdir_path, "nope.csv"), CSV_HEADER)
    assert missing.count() == 0
    path = _csv(tmpdir_path, "zawodnik,razem\nA B,300\n")
    raw = read_csv_text(spark, path, CSV_HEADER)
    late = dict(EVENT, date_text="2026-09-30")
    assert supplement_rows(raw, res, late, CHAMP, "home", "Home").count() == 0
    assert supplement_rows(raw, res.limit(0), EVENT, CHAMP, "home", "Home").count() == 0
    one = supplement_rows(raw, res, EVENT, CHAMP, "home", "Home").first()
    assert one["m_skeet"] is None and one["score"] == 300.0
    ev = supplement_events(spark, [EVENT, EVENT]).collect()
    assert len(ev) == 1 and ev[0]["dates_iso"] == "2026-06-13"
    assert known_players(res, "HOME ").count() == 1


PAGE = """<html><body>
<table><tr><th>Menu</th></tr><tr><td>x</td></tr></table>
<TABLE class="r"><THEAD><TR><TH>Lp</TH><TH>Nazwisko i imię</TH><TH>Okręg</TH><TH>Krąg</TH><TH>Razem</TH></TR></THEAD>
<TBODY>
<TR><TD>1</TD><TD><a href="/w/1.html">Kowal&nbsp;Jan</a></TD><TD>Dom &amp; Las</TD><TD>95</TD><TD>435</TD></TR>
<tr><td>LP</td><td>Nazwisko i Imię</td><td>Okręg</td><td>Krąg</td><td>Razem</td></tr>
<tr><td>2</td><td> </td><td>X</td><td>1</td><td>300</td></tr>
<tr><td>3</td><td>Nowak Ewa</td><td>X</td><td></td><td>bad</td></tr>
<tr class="z"><td>4</td><td>Lis Ola</td><td>X</td><td>80</td><td>1,200</td></tr>
</TBODY></TABLE></body></html>"""


def test_result_table_extraction(spark):
    pages = spark.createDataFrame([("p1", PAGE), ("p2", "<html>no tables</html>")], "url string, html string")
    rows = {r["player"]: r for r in H.extract_results(pages).collect()}
    assert set(rows) == {"Kowal Jan", "Lis Ola"}
    k = rows["Kowal Jan"]
    assert (k["table_no"], k["district"], k["m_skeet"], k["score"], k["klass"], k["lp"]) == \
        (2, "Dom & Las", 95.0, 435.0, "", 1.0)
    assert rows["Lis Ola"]["score"] == 1200.0
    issues = H.ingest_issues(pages).collect()
    assert [(r["url"], r["table_no"], r["detail"]) for r in issues] == [("p1", 1, "player,district,score"), ("p2", 0, "")]


SCHEDULE = """<table><tr><th>Lp</th><th>Nazwa zawodów</th><th>ZO PZŁ</th><th>Strzelnica</th>
<th>Data zawodów</th><th>Wyniki</th></tr>
<tr><td>1</td><td>Puchar</td><td>ZO</td><td>S1</td><td>16-17.05.2026</td><td><a href="/w/1.html">w</a></td></tr>
<tr><td>2</td><td>Krótki</td></tr>
<tr><td>3</td><td>Bez</td><td>ZO</td><td>S2</td><td>2026-06-13</td><td>brak</td></tr>
<tr><td>4</td><td>Puchar bis</td><td>ZO</td><td>S1</td><td>1.06.2026</td><td><a href="/w/1.html">w</a></td></tr>
<tr><td>5</td><td>Tekst</td><td>ZO</td><td>S3</td><td>1.07.2025</td><td>see https://x.example/r</td></tr>
</table>"""


def test_schedule_extraction(spark):
    pages = spark.createDataFrame([("s", SCHEDULE)], "url string, html string")
    ev = {r["schedule_lp"]: r for r in H.schedule_events(pages, "https://h.example/").collect()}
    assert set(ev) == {"1", "5"}
    assert ev["1"]["results_url"] == "https://h.example/w/1.html" and ev["1"]["season"] == "2026"
    assert ev["5"]["results_url"] == "https://x.example/r" and ev["1"]["schedule_table_no"] == 1


def test_table_sets_and_metrics(spark, tmpdir_path):
    a = spark.createDataFrame([(1,)], "x int")
    write_tables(tmpdir_path + "/out", {"a": a, "b": a.union(a)})
    back = read_tables(spark, tmpdir_path + "/out", ["a", "b"])
    m = {r["metric"]: r["value"] for r in run_metrics(a=back["a"], b=back["b"]).collect()}
    assert m == {"a": 1, "b": 2}


SPAN_PAGE = """<table>
<tr><th rowspan="2">Lp</th><th rowspan=2>Nazwisko i imię</th><th rowspan="2">Okręg</th>
    <th colspan="3">Śrut</th><th colspan='2'>Kula</th><th rowspan="2">Razem</th></tr>
<tr><th>Krąg</th><th>Oś</th><th>MOP</th><th>Dzik</th><th>Rogacz</th></tr>
<tr><td>1</td><td>Kowal Jan</td><td>X</td><td>90</td><td>80</td><td>70</td><td>60</td><td>50</td><td>350</td></tr>
<tr><td>2</td><td>Lis Ola</td><td>X</td><td colspan="3">brak</td><td>40</td><td>30</td><td>70</td></tr>
<tr><td rowspan="2">3</td><td>Nowak Ewa</td><td>Y</td><td>1</td><td>1</td><td>1</td><td>1</td><td>1</td><td>5</td></tr>
<tr><td>Zięba Jan</td><td rowspan="2">Z</td><td>2</td><td>2</td><td>2</td><td>2</td><td>2</td><td>10</td></tr>
<tr><td>4</td><td>Wrona Iza</td><td>3</td><td>3</td><td>3</td><td>3</td><td>3</td><td>15</td></tr>
</table>"""


def test_header_spans_expanded(spark):
    pages = spark.createDataFrame([("p", SPAN_PAGE)], "url string, html string")
    t = H.result_tables(pages).first()
    assert t["labels"] == ["Lp", "Nazwisko i imię", "Okręg", "Krąg", "Oś", "MOP", "Dzik", "Rogacz", "Razem"]
    rows = {r["player"]: r for r in H.extract_results(pages).collect()}
    k = rows["Kowal Jan"]
    assert (k["m_skeet"], k["m_lane"], k["m_trap"], k["m_boar"], k["m_buck"], k["score"]) == \
        (90.0, 80.0, 70.0, 60.0, 50.0, 350.0)
    o = rows["Lis Ola"]
    assert (o["m_skeet"], o["m_boar"], o["m_buck"], o["score"]) == (None, 40.0, 30.0, 70.0)
    # body row spans fill down: the shared Lp and the shared district
    z, w = rows["Zięba Jan"], rows["Wrona Iza"]
    assert (z["lp"], z["district"], z["score"]) == (3.0, "Z", 10.0)
    assert (w["lp"], w["district"], w["m_skeet"], w["score"]) == (4.0, "Z", 3.0, 15.0)
    assert H.ingest_issues(pages).count() == 0
