"""Binding of the engine schema to the supplied TPC-H-style tables.

The supplied data has no competitions, so this module defines how they play
one (the same definition is written in SQL in ``podium.plans.oracle``):

* player / district     customer name / nation name (orders -> customer -> nation)
* one results row       one order; ``row_seq`` = order key; ``results_url`` = 'u/<key>'
* event_name            order priority + ' ' + yyyy-MM of the order date
* score                 floor(total price / 1000)
* table_no              1 + (custkey + orderkey) % 2   (table 1 = category 'K')
* klass, venue, lp      order status, 'Range <region>', orderkey % 100 + 1
* m_skeet .. m_buck     2 x max quantity of line 1 .. 5 of the order (NULL if absent)
* date_text             free text built from the order date in one of four styles
                        (single day, ISO, same-month range, cross-month range)
* events                one schedule row per order
* supplement            'purchase' rows of ``events`` as raw text (a manual CSV)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.functions.text import coerce_number, season_of
from podium.session import written_once

# Windows of the qualification board over the bound data (inclusive, overlapping).
WINDOWS = {"final": ("1996-01-01", "1998-12-31"), "championship": ("1998-06-01", "1999-06-30")}
SUPPLEMENT_DISTRICT = "nation_3"
SUPPLEMENT_DISTRICT_LABEL = "NATION_3"
SUPPLEMENT_EVENT = {
    "season": "1998",
    "schedule_table_no": None,
    "schedule_lp": "manual-1998-09-12",
    "event_name": "District championship 1998",
    "organizer": "NATION_3",
    "venue": "",
    "date_text": "1998-09-12",
    "results_url": "manual:district-championship-1998",
}
SUPPLEMENT_PLAYER_STRIDE = 13


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fact_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """A fact-table scan; its splits follow ``spark.sql.files.maxPartitionBytes``."""
    df = table(spark, sf_dir, name)
    return df.select(*cols) if cols else df


def _date_text(d: Column, key: Column) -> Column:
    style = key % 4
    nxt = F.date_add(d, 1)
    later = F.add_months(d, 1)
    single = F.date_format(d, "dd.MM.yyyy")
    return (F.when(style == 0, single)
            .when(style == 1, F.date_format(d, "yyyy-MM-dd"))
            .when(style == 2, F.when(F.dayofmonth(d) <= 27,
                                     F.concat(F.date_format(d, "dd"), F.lit("-"), F.date_format(nxt, "dd.MM.yyyy")))
                  .otherwise(single))
            .otherwise(F.concat(F.date_format(d, "dd.MM"), F.lit("-"), F.date_format(later, "dd.MM.yyyy"))))


def _measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity") \
        .filter(F.col("l_linenumber").between(1, 5))
    names = ["m_skeet", "m_lane", "m_trap", "m_boar", "m_buck"]
    return li.groupBy("l_orderkey").agg(*[
        (F.max(F.when(F.col("l_linenumber") == i + 1, F.col("l_quantity"))) * 2).alias(n)
        for i, n in enumerate(names)])


def _orders_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = fact_table(spark, sf_dir, "orders",
                   "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    # nation is a fixed 25-row dimension: the planner broadcasts it from its file size
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    # customer x nation grows with the data: the planner joins it by its size in bytes
    cn = c.join(n, c.c_nationkey == n.n_nationkey, "inner")
    d = F.to_date("o_orderdate")
    return (o.join(cn, o.o_custkey == cn.c_custkey, "inner")
            .withColumn("d", d)
            .withColumn("date_text", _date_text(F.col("d"), F.col("o_orderkey")))
            .withColumn("event_name", F.concat(F.col("o_orderpriority"), F.lit(" "), F.date_format("d", "yyyy-MM")))
            .withColumn("venue", F.concat(F.lit("Range "), F.col("n_regionkey").cast("string")))
            .withColumn("results_url", F.concat(F.lit("u/"), F.col("o_orderkey").cast("string"))))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """results(row_seq, table_no, player, klass, district, lp, m_*, sub_shot,
    sub_rifle, score, season, event_name, date_text, venue, results_url),
    materialised once per application (see ``results_plan`` for the plan)."""
    return written_once(spark, ("bound-results", sf_dir.rstrip("/")), lambda: results_plan(spark, sf_dir), inputs=sf_dir)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events(season, schedule_table_no, schedule_lp, event_name, organizer,
    venue, date_text, results_url), materialised once per application."""
    return written_once(spark, ("bound-events", sf_dir.rstrip("/")), lambda: events_plan(spark, sf_dir), inputs=sf_dir)


def results_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The binding of ``results`` as a plan over the source tables."""
    o = _orders_full(spark, sf_dir)
    m = _measures(spark, sf_dir)
    j = o.join(m, o.o_orderkey == m.l_orderkey, "left")
    return j.select(
        F.col("o_orderkey").alias("row_seq"),
        (F.lit(1) + (F.col("o_custkey") + F.col("o_orderkey")) % 2).cast("int").alias("table_no"),
        F.col("c_name").alias("player"),
        F.col("o_orderstatus").alias("klass"),
        F.col("n_name").alias("district"),
        (F.col("o_orderkey") % 100 + 1).cast("double").alias("lp"),
        "m_skeet", "m_lane", "m_trap", "m_boar", "m_buck",
        (F.col("m_skeet") + F.col("m_lane") + F.col("m_trap")).alias("sub_shot"),
        (F.col("m_boar") + F.col("m_buck")).alias("sub_rifle"),
        F.floor(F.col("o_totalprice") / 1000).cast("double").alias("score"),
        season_of("date_text").alias("season"),
        "event_name", "date_text", "venue", "results_url",
    )


def events_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The binding of ``events`` (one schedule row per order) as a plan."""
    o = _orders_full(spark, sf_dir)
    return o.select(
        season_of("date_text").alias("season"),
        (F.year("d") - 1994).cast("int").alias("schedule_table_no"),
        F.col("o_orderkey").cast("string").alias("schedule_lp"),
        "event_name",
        F.col("n_name").alias("organizer"),
        "venue", "date_text", "results_url",
    )


def supplement_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual results as a CSV would give them: every column text.
    Player names carry NBSPs and double spaces, some scores are not numbers."""
    ev = fact_table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    pid = F.lpad((F.col("user_id") * SUPPLEMENT_PLAYER_STRIDE).cast("string"), 9, "0")
    name = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("\u00a0Customer#"), pid, F.lit(" \t "))) \
        .otherwise(F.concat(F.lit("Customer#"), pid))
    score = F.floor("value").cast("string")
    k = F.regexp_extract("props", r'"k":\s*(\d+)', 1)
    return ev.select(
        F.col("event_id").alias("row_seq"),
        name.alias("player"),
        F.lit("P").alias("klass"),
        k.alias("m_skeet"),
        F.lit("").alias("m_trap"),
        F.lit(None).cast("string").alias("m_lane"),
        F.lit(None).cast("string").alias("m_buck"),
        F.lit(None).cast("string").alias("m_boar"),
        F.when(F.col("event_id") % 10 == 0, F.concat(score, F.lit("d"))).otherwise(score).alias("score"),
    )


def coerced_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3 over text from the events table: props number, value text, and a mangled variant."""
    ev = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", r'"k":\s*(\d+)', 1)
    return ev.select(
        "event_id",
        coerce_number(k).alias("k_num"),
        coerce_number(F.col("value").cast("string")).alias("value_num"),
        coerce_number(F.concat(F.col("event_type"), F.lit(" "), k)).alias("junk_num"),
    )


def supplement_frames(spark: SparkSession, sf_dir: str):
    """(results, supplement rows, supplement events) of the bound data."""
    from podium.plans.supplement import supplement_events, supplement_rows
    res = results(spark, sf_dir)
    rows = supplement_rows(supplement_raw(spark, sf_dir), res, SUPPLEMENT_EVENT, WINDOWS["championship"],
                           SUPPLEMENT_DISTRICT, SUPPLEMENT_DISTRICT_LABEL)
    return res, rows, supplement_events(spark, [SUPPLEMENT_EVENT])
