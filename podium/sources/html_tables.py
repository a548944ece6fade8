"""Tables out of raw HTML pages, as DataFrame jobs over ``pages(url, html)``.

A page is read once, inside the task that holds it (``page_scan``): its tables, their rows and cells, row and column
spans laid out.  Nested tables are tables of their own: each piece of text goes to its innermost table, and the outer
table goes on behind the nested one.  Comments and script text are not part of a page.  Only the parts of a table that a
job asks for leave the task, one row per table; the header of a table travels in the same row as its body, so locating
columns by header name needs no join and no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium import constants as K
from podium.functions.text import clean_text, coerce_number, decode_markup, first_link, page_base, season_of
from podium.operators.groupwise import first_per_key, leaderboard
from podium.operators.partitioning import evaluate_once
from podium.session import scratch_path, ship
from podium.sources.page_scan import Table, owned

CELL_OPEN = r"(?i)<t[hd]\b[^>]*>"
#: Type of the order key of ingested rows.
ROW_SEQ = "decimal(38,0)"
#: Text read from pages before the tables found in it leave a task.
BATCH_CHARS = 4 << 20


def _after_first(parts: Column) -> Column:
    return F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


_CELL_MARK = "\u0001"


def row_texts(row_html: Column, sep: str = "") -> Column:
    """Visible text of every cell of a row, cleaned in one pass over the row:
    cell starts become a marker, other tags become ``sep``, the references that
    the page kept are decoded, whitespace collapsed (also around markers), then split."""
    marked = F.regexp_replace(row_html, CELL_OPEN, _CELL_MARK)
    text = decode_markup(F.regexp_replace(marked, r"(?s)<[^>]*>", sep))
    text = F.regexp_replace(clean_text(text), " ?" + _CELL_MARK + " ?", _CELL_MARK)
    return _after_first(F.split(text, _CELL_MARK))


_TEXTS, _ARROW_TEXTS = T.ArrayType(T.StringType()), pa.list_(pa.string())
_CELLS = pa.list_(pa.struct([("texts", _ARROW_TEXTS), ("cell", pa.string())]))
#: What a scan can give of a table (attributes of ``Table``): Spark type, Arrow type.
PARTS: dict[str, tuple[T.DataType, pa.DataType]] = {
    "html": (T.StringType(), pa.string()), "rows": (_TEXTS, _ARROW_TEXTS), "n_header": (T.IntegerType(), pa.int32()),
    "labels": (_TEXTS, _ARROW_TEXTS), "canonical": (_TEXTS, _ARROW_TEXTS), "first_row": (_TEXTS, _ARROW_TEXTS),
    "body": (T.ArrayType(_TEXTS), pa.list_(_ARROW_TEXTS)),
    "data_cells": (T.ArrayType(T.StructType([T.StructField("texts", _TEXTS), T.StructField("cell", T.StringType())])), _CELLS),
}
_OF_TABLE = {"table_html": "html", "rows_html": "rows"}


def scan_tables(pages: DataFrame, parts: Sequence[str], url: str = "url", html: str = "html", shown_only: bool = False,
                keep_pages: bool = False, only: Callable[[Table], bool] | None = None,
                aliases: Mapping[str, str] | None = None, cell: str | None = None) -> DataFrame:
    """(url, table_no, *parts): every table of every page with the parts of ``PARTS`` that are named, 1-based in page order.

    ``shown_only`` numbers only tables that hold text (nested tables' included) and are not hidden by their own or an
    outer table's style.  ``keep_pages`` gives a page without such tables one row, its ``table_no`` null.  ``only``: the
    tables for which ``body`` and ``data_cells`` are asked for; for the others they are null.  ``cell``: the label of the
    column whose html ``data_cells`` gives beside the texts; the tables asked for must have it in their first row."""
    ship(pages.sparkSession)
    kind, parts = pages.schema[url].dataType, [_OF_TABLE.get(p, p) for p in parts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at: list[int] = []
            numbers: list[int | None] = []
            values: list[list] = [[] for _ in parts]
            read = 0

            def flush() -> pa.RecordBatch:
                arrays = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(numbers, pa.int32()),
                          *(pa.array(v, PARTS[p][1]) for p, v in zip(parts, values))]
                return pa.RecordBatch.from_arrays(arrays, names=["url", "table_no", *parts])

            for i, page in enumerate(batch.column(1)):
                page = page.as_py()
                found = [t for t, shown in owned(page) if shown or not shown_only]
                for number, text in enumerate(found, 1):
                    table = Table(text, aliases, cell)
                    asked = only is None or only(table)
                    at.append(i)
                    numbers.append(number)
                    for p, v in zip(parts, values):
                        v.append(getattr(table, p) if asked or p not in ("body", "data_cells") else None)
                if not found and keep_pages:
                    at.append(i)
                    numbers.append(None)
                    for v in values:
                        v.append(None)
                read += len(page or "")
                if read >= BATCH_CHARS:
                    yield flush()
                    read = 0
                    at, numbers, values = [], [], [[] for _ in parts]
            yield flush()

    schema = T.StructType([T.StructField("url", kind), T.StructField("table_no", T.IntegerType()), *(T.StructField(p, PARTS[p][0]) for p in parts)])
    return (pages.select(F.col(url).alias("url"), F.col(html).alias("html")).mapInArrow(run, schema)
            .withColumnsRenamed({of: name for name, of in _OF_TABLE.items()}))


def page_tables(pages: DataFrame, url: str = "url", html: str = "html", shown_only: bool = False,
                keep_pages: bool = False) -> DataFrame:
    """(url, table_no, table_html, rows_html, n_header): every table of every page,
    1-based in page order; ``rows_html`` holds the rows that have cells and
    ``n_header`` counts the leading header rows: those of <thead> that hold text,
    or else the leading rows made of <th> cells only.  Options: see ``scan_tables``."""
    return scan_tables(pages, ["table_html", "rows_html", "n_header"], url, html, shown_only, keep_pages)


def result_tables(pages: DataFrame, aliases: Mapping[str, str] | None = None,
                  required: Sequence[str] = K.REQUIRED_RESULT_COLUMNS, keep_pages: bool = False,
                  parts: Sequence[str] = ("table_html", "rows_html", "n_header")) -> DataFrame:
    """Tables of result pages with their canonical header labels:
    (url, table_no, *parts, labels, canonical, missing, accepted).  A ``body`` among the parts is that of accepted tables."""
    aliases = dict(aliases or K.HEADER_ALIASES)
    needed = set(required)
    t = scan_tables(pages, [*parts, "labels", "canonical"], shown_only=True, keep_pages=keep_pages,
                    only=lambda table: needed <= set(table.canonical), aliases=aliases)
    t = t.withColumn("missing", F.array_except(F.array(*[F.lit(r) for r in required]), F.col("canonical")))
    return t.withColumn("accepted", F.size("missing") == 0)


def ingest_issues(pages: DataFrame, aliases: Mapping[str, str] | None = None,
                  events: DataFrame | None = None) -> DataFrame:
    """What gave no results: (url, table_no, issue, detail) - tables without the
    required headers, pages without any table that is shown (``no_tables``) and,
    with ``events``, events whose page is missing (``no_page``); table 0 stands for
    the page."""
    spark = pages.sparkSession
    path = scratch_path(spark, "issues")  # the pages are read once; what is left of a table is a short row
    (result_tables(pages, aliases, keep_pages=True, parts=())
     .select("url", "table_no", F.when(~F.col("accepted"), F.array_join("missing", ",")).alias("detail")).write.parquet(path))
    t = spark.read.parquet(path)
    missing = t.where("table_no IS NOT NULL AND detail IS NOT NULL").select("url", "table_no", F.lit("missing_headers").alias("issue"), "detail")
    urls = t.groupBy("url").agg(F.count("table_no").alias("tables"))
    whole = lambda urls, issue: urls.select("url", F.lit(0).alias("table_no"), F.lit(issue).alias("issue"), F.lit("").alias("detail"))
    out = missing.unionByName(whole(urls.where("tables = 0"), "no_tables"))
    if events is not None:
        asked = events.select(F.col("results_url").alias("url")).distinct()
        out = out.unionByName(whole(asked.join(urls, "url", "left_anti"), "no_page"))
    return out


def result_rows(pages: DataFrame, aliases: Mapping[str, str] | None = None,
                thousands: str | None = ",") -> DataFrame:
    """Every body row of every conforming table, accepted or not: (url, table_no, row_no, player,
    lp, m_*, sub_shot, sub_rifle, score, klass, district, reason, detail).

    ``reason`` is null for accepted rows, else the first of ``short_row`` (no cell for the player), ``blank_player``,
    ``repeated_header``, ``no_score`` (no cell or an empty one) and ``bad_score`` that holds; ``detail`` is the text of the
    cell that decided.  Numbers use the tolerant rule (``thousands`` removed first); a missing class or district column
    gives ''."""
    names = ["player", "klass", "district", *K.NUMERIC_RESULT_COLUMNS]
    t = result_tables(pages, aliases, parts=("body",)).filter("accepted")
    # column positions are looked up once per table
    t = t.select("url", "table_no", "body", *[F.array_position(F.col("canonical"), F.lit(n)).cast("int").alias(f"__i_{n}") for n in names])
    r = t.select("url", "table_no", *[f"__i_{n}" for n in names], F.posexplode("body").alias("pos", "__t"))
    r = r.withColumn("row_no", (F.col("pos") + 1).cast("int"))

    def cell(name: str) -> Column:
        i = F.col(f"__i_{name}")
        return F.when(i > 0, F.try_element_at(F.col("__t"), i))

    out = r.select(
        "url", "table_no", "row_no",
        cell("player").alias("player"),
        *[coerce_number(cell(c), thousands).alias(c) for c in K.NUMERIC_RESULT_COLUMNS],
        F.coalesce(cell("klass"), F.lit("")).alias("klass"),
        F.coalesce(cell("district"), F.lit("")).alias("district"),
        F.coalesce(cell("score"), F.lit("")).alias("__score"))
    out = evaluate_once(out, ["player", "score", "__score"])
    player, score = F.col("player"), F.col("__score")
    reason = (F.when(player.isNull(), "short_row").when(player == "", "blank_player")
              .when(F.lower(player).isin(*K.REPEATED_HEADER_PLAYER), "repeated_header")
              .when(F.col("score").isNull() & (score == ""), "no_score").when(F.col("score").isNull(), "bad_score"))
    out = out.withColumn("reason", reason)
    detail = (F.when(F.col("reason") == "bad_score", score).when(F.col("reason") == "repeated_header", player)
              .when(F.col("reason").isNotNull(), F.lit("")))
    return out.withColumn("detail", detail).drop("__score")


def extract_results(pages: DataFrame, aliases: Mapping[str, str] | None = None,
                    thousands: str | None = ",") -> DataFrame:
    """Result rows of every conforming table: (url, table_no, row_no, player,
    lp, m_*, sub_shot, sub_rifle, score, klass, district).

    Rows without a player, repeated header rows and rows without a numeric score
    are left out (``rejected_rows`` has them with the reason)."""
    return result_rows(pages, aliases, thousands).filter(F.col("reason").isNull()).drop("reason", "detail")


def rejected_rows(rows: DataFrame) -> DataFrame:
    """(url, table_no, row_no, reason, detail) of the rows of ``result_rows`` or ``schedule_rows`` that are not accepted."""
    table = "table_no" if "table_no" in rows.columns else "schedule_table_no"
    return rows.filter(F.col("reason").isNotNull()).select("url", F.col(table).alias("table_no"), "row_no", "reason", "detail")


def crawl_order(events: DataFrame) -> DataFrame:
    """Events with their crawl order as ``event_seq``: season descending, date text,
    name, then URL (the schedule order, made total)."""
    if "event_seq" in events.columns:
        return events
    order = [F.col("season").desc_nulls_last(), F.col("date_text").asc_nulls_last(),
             F.col("event_name").asc_nulls_last(), F.col("results_url").asc_nulls_last()]
    return leaderboard(events, order, place="event_seq")


def with_lineage(rows: DataFrame, events: DataFrame) -> DataFrame:
    """Stamp each result row with its event (season, name, date text, venue,
    URL): the per-event loop of a crawler becomes one equi join on the URL."""
    ev = events.select(F.col("results_url").alias("url"), "season", "event_name", "date_text", "venue",
                       *(["event_seq"] if "event_seq" in events.columns else []))
    out = rows.join(ev, "url", "inner").withColumnRenamed("url", "results_url")
    if "event_seq" in out.columns:
        # row order of the crawl: event order, then table order, then row order; both numbers
        # are 32-bit, so the wide key never mixes them
        wide = lambda c, shift: F.col(c).cast(ROW_SEQ) * F.lit(str(1 << shift)).cast(ROW_SEQ)
        out = out.withColumn("row_seq", (wide("event_seq", 64) + wide("table_no", 32)
                                         + F.col("row_no")).cast(ROW_SEQ)).drop("event_seq")
    return out


def schedule_rows(pages: DataFrame, base_url: str, headers: Mapping[str, str] | None = None,
                  seen: Observation | None = None) -> DataFrame:
    """Every body row of every table whose first row holds all required headers, accepted or not,
    columns located by header name: (url, schedule_table_no, row_no, season,
    schedule_lp, event_name, organizer, venue, date_text, results_url, reason, detail).

    Body cells are the <td> cells only.  ``reason`` is null for accepted rows, else ``short_row`` (too short to reach
    the results column), ``no_link`` or ``no_results`` (a link starting with 'brak'); ``detail`` is the text of the results
    cell.  The results link is made absolute against the page's <base>, itself against ``base_url``.  ``seen`` observes the
    number of all tables (``rows``) in the pass that reads the rows; write the rows as they are, without a shuffle, for a
    count that no repeated task adds to."""
    headers = headers or K.SCHEDULE_HEADERS
    # the page's base travels with its URL
    pages = pages.select(F.struct("url", page_base("html", F.lit(base_url)).alias("base")).alias("page"), "html")
    required = set(headers)
    inv = {v: k for k, v in headers.items()}
    t = scan_tables(pages, ["first_row", "data_cells"], url="page", only=lambda table: required <= set(table.first_row or ()),
                    cell=inv["results_url"]) \
        .withColumnsRenamed({"url": "page", "first_row": "labels"})
    if seen is not None:
        t = t.observe(seen, F.count(F.lit(1)).alias("rows"))
    # only tables whose first row holds all headers have data cells
    r = t.select("page", F.col("table_no").alias("schedule_table_no"), "labels", F.posexplode("data_cells").alias("pos", "row"))
    r = r.select("page", "schedule_table_no", "labels", (F.col("pos") + 1).cast("int").alias("row_no"), "row.texts", "row.cell")

    def idx(label: str) -> Column:
        return F.array_position(F.col("labels"), F.lit(label)).cast("int")

    reached = F.col("cell").isNotNull()
    link = F.when(reached, first_link(F.col("cell"), F.col("page.base"), decode_markup))
    text = lambda col: F.try_element_at("texts", idx(inv[col]))
    out = r.select(
        F.col("page.url").alias("url"), "schedule_table_no", "row_no",
        text("date_text").alias("date_text"),
        text("schedule_lp").alias("schedule_lp"),
        text("event_name").alias("event_name"),
        text("organizer").alias("organizer"),
        text("venue").alias("venue"),
        link.alias("results_url"),
        F.coalesce(F.when(reached, text("results_url")), F.lit("")).alias("detail"))
    out = evaluate_once(out)
    found = F.col("results_url")
    reason = (F.when(found.isNull(), "short_row").when(found == "", "no_link")
              .when(F.lower(found).startswith(K.NO_RESULTS_PREFIX), "no_results"))
    return (out.withColumn("season", season_of("date_text")).withColumn("reason", reason)
            .withColumn("detail", F.when(F.col("reason").isNotNull(), F.col("detail"))))


def extract_schedule(pages: DataFrame, base_url: str, headers: Mapping[str, str] | None = None) -> DataFrame:
    """The accepted rows of ``schedule_rows``: (url, schedule_table_no, row_no, season,
    schedule_lp, event_name, organizer, venue, date_text, results_url)."""
    return schedule_rows(pages, base_url, headers).filter(F.col("reason").isNull()).drop("reason", "detail")


def schedule_events(pages: DataFrame, base_url: str) -> DataFrame:
    """Events of the schedule: one per results URL, the first listing kept
    (page URL order, then table order, then row order)."""
    rows = extract_schedule(pages, base_url)
    rows = rows.withColumn("__seq", F.struct(F.col("url"), F.col("schedule_table_no"), F.col("row_no")))
    return first_per_key(rows, "results_url", "__seq").drop("__seq").select(
        "season", "schedule_table_no", "schedule_lp", "event_name", "organizer", "venue", "date_text",
        "results_url")
