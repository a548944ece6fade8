"""The two end-to-end runs, as Spark jobs.

``season_run``: schedule events + result pages -> results (written once and
read back, since three boards reuse it) -> average, award and team boards and
the team members -> five-table sink.

``qualification_run``: events narrowed to the window hull *before* their
pages are joined -> results -> manual supplement -> starts and the merged
qualification board -> events having starts -> weakness report -> table sink,
JSON records, run counters.

Both publish all their tables as one new version of the set at ``out_dir`` (``sources.tables.read_tables`` follows the
newest): a run that fails half-way leaves the version before it in force.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from podium.operators.windows import events_in_period, window_hull
from podium.plans import boards, profile, report
from podium.plans import qualification as Q
from podium.plans.supplement import supplement_events, supplement_rows, with_supplement
from podium.session import scratch_path
from podium.sources.html_tables import crawl_order, extract_results, with_lineage
from podium.sources.tables import NewVersion, publish_tables, run_metrics, write_tables


def ingest(spark: SparkSession, pages: DataFrame, events: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Result rows of the pages of ``events``, stamped with lineage and crawl order,
    materialised once in the shared folder (the boards all read it); ``seen`` observes their number (``rows``) in that pass."""
    ev = crawl_order(events)
    # pages are parsed where they lie; only their small rows meet the events, in one join on the URL
    rows = with_lineage(extract_results(pages), ev)
    path = scratch_path(spark, "results")
    if seen is not None:
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def season_run(spark: SparkSession, pages: DataFrame, events: DataFrame, out_dir: str) -> dict[str, str]:
    """All-season boards; returns the written table paths."""
    results = ingest(spark, pages, events)
    return publish_tables(spark, out_dir, {
        "results": results,
        "average": boards.average_board(results),
        "award": boards.award_board(results),
        "team": boards.team_board(results),
        "team_members": boards.team_players(results),
    })


def qualification_run(spark: SparkSession, pages: DataFrame, events: DataFrame, windows: Mapping[str, tuple],
                      out_dir: str, district: str | None = None, supplement: DataFrame | None = None,
                      supplement_event: Mapping | None = None, district_label: str | None = None,
                      first: str = "final", second: str = "championship",
                      export_tables: bool = True) -> dict[str, str]:
    """Window qualification for one district; returns the written table paths.

    The report (JSON records of standings, starts and events, the weakness report
    and the run counters) is always written; ``export_tables`` gates the plain
    three-table export.  The counters of written tables are observed while those are
    written; the pages are read once."""
    lo, hi = window_hull({first: windows[first], second: windows[second]})
    period = events_in_period(events, lo, hi)              # push the hull down before reading pages
    seen = Observation()
    results = ingest(spark, pages, period.drop("dates_iso"), seen)
    counts: dict[str, DataFrame | int] = {"events": events, "events_in_period": period,
                                          "results": int(seen.get.get("rows", 0))}
    all_events = period
    if supplement is not None and supplement_event is not None:
        rows = supplement_rows(supplement, results, supplement_event, windows[second], district,
                               district_label or (district or ""))
        extra = scratch_path(spark, "supplement")
        rows.write.mode("errorifexists").parquet(extra)
        rows = spark.read.schema(rows.schema).parquet(extra)
        counts["results"] += rows.count()
        results = with_supplement(results, rows)
        all_events = period.unionByName(supplement_events(spark, [supplement_event]))
    standings = Q.qualification_board(results, windows, district, first, second)
    starts = Q.starts_table(results, district)
    district_events = Q.events_with_starts(all_events, starts)
    weakness = profile.weakness_nested(starts)
    plain = {"standings": standings, "starts": starts, "events": district_events}
    with NewVersion(spark, out_dir) as new:
        if export_tables:
            for name, df in plain.items():
                new.write(name, df)
            written = {n: spark.read.parquet(new.paths[n]) for n in plain}
        else:
            paths = write_tables(scratch_path(spark, "qualification"), plain)
            written = {n: spark.read.parquet(paths[n]) for n in plain}
        new.write("weakness", weakness)
        for name, df in written.items():
            new.write(f"{name}_json", report.json_records(df), form="text")
        counts |= {metric: new.rows[f"{name}_json"] for metric, name in
                   (("district_starts", "starts"), ("players", "standings"), ("district_events", "events"))}
        new.write("run_metrics", run_metrics(**counts))
    return new.paths
