"""Manual results supplement: known-player semi join, tolerant typing, lineage
stamp, union with the ingested results, and its event record.

The supplement is kept only for players already present in the district
(left semi join on the cleaned name) and only when its event date falls in the
window; an empty ``results`` therefore yields no supplement rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.functions.dates import any_date_between, dates_to_iso, parse_event_dates
from podium.functions.text import clean_text, coerce_number
from podium.operators.groupwise import first_per_key
from podium.operators.setops import union_by_name
from podium.plans.qualification import district_filter
from podium.sources.html_tables import ROW_SEQ

# FIXED VALUES: header of the manual results CSV -> engine column.
CSV_HEADER = {
    "zawodnik": "player",
    "klasa": "klass",
    "krag": "m_skeet",
    "mop": "m_trap",
    "os": "m_lane",
    "rogacz": "m_buck",
    "dzik": "m_boar",
    "razem": "score",
}
NUMERIC = ("m_skeet", "m_trap", "m_lane", "m_buck", "m_boar", "score")
# Supplement rows follow every ingested row in row order: order keys are below these offsets.
SEQ_OFFSET = 1 << 62
WIDE_SEQ_OFFSET = 10 ** 37

EVENT_SCHEMA = T.StructType([
    T.StructField("season", T.StringType()),
    T.StructField("schedule_table_no", T.IntegerType()),
    T.StructField("schedule_lp", T.StringType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("organizer", T.StringType()),
    T.StructField("venue", T.StringType()),
    T.StructField("date_text", T.StringType()),
    T.StructField("results_url", T.StringType()),
])


def known_players(results: DataFrame, district: str | None) -> DataFrame:
    """Distinct cleaned names of the players of ``district`` (None: all)."""
    return district_filter(results, district).select(clean_text("player").alias("player")) \
        .filter(F.col("player").isNotNull()).distinct()


def supplement_rows(raw: DataFrame, results: DataFrame, event: Mapping, window: tuple,
                    district: str | None, district_label: str, table_no: int = 2) -> DataFrame:
    """Typed supplement rows stamped with the event's lineage.

    ``raw`` holds text columns (as read by ``read_csv_text``) and optionally a
    ``row_seq``; numeric columns that exist are coerced (bad text -> NULL, the
    row is dropped later by the score filter of each board)."""
    df = raw.withColumn("player", clean_text("player"))
    if "row_seq" not in df.columns:
        df = df.withColumn("row_seq", F.monotonically_increasing_id())
    df = df.join(known_players(results, district), "player", "left_semi")
    for c in NUMERIC:
        if c in df.columns:
            df = df.withColumn(c, coerce_number(c))
    in_window = any_date_between(parse_event_dates(F.lit(event["date_text"])), window[0], window[1])
    df = df.filter(in_window)
    # ingested rows carry the wide key of ``with_lineage``, bound tables a bigint
    wide = isinstance(results.schema["row_seq"].dataType, T.DecimalType) if "row_seq" in results.columns else False
    after = (F.col("row_seq").cast(ROW_SEQ) + F.lit(str(WIDE_SEQ_OFFSET)).cast(ROW_SEQ) if wide
             else F.col("row_seq") + F.lit(SEQ_OFFSET)).cast(ROW_SEQ if wide else "bigint").alias("row_seq")
    return df.select(
        after,
        "player",
        *[c for c in df.columns if c not in ("player", "row_seq")],
        F.lit(district_label).alias("district"),
        F.lit(table_no).cast("int").alias("table_no"),
        F.lit(event.get("season", "")).alias("season"),
        F.lit(event["event_name"]).alias("event_name"),
        F.lit(event["date_text"]).alias("date_text"),
        F.lit(event.get("venue", "")).alias("venue"),
        F.lit(event["results_url"]).alias("results_url"),
    )


def supplement_events(spark: SparkSession, events: list[Mapping]) -> DataFrame:
    """The supplement's event records (A5 literal source), first per URL, with
    their parsed dates."""
    rows = [tuple(e.get(f.name) for f in EVENT_SCHEMA.fields) for e in events]
    df = spark.createDataFrame(rows, EVENT_SCHEMA).withColumn("row_seq", F.monotonically_increasing_id())
    df = first_per_key(df, "results_url", "row_seq").drop("row_seq")
    return df.withColumn("dates_iso", dates_to_iso(parse_event_dates("date_text")))


def with_supplement(results: DataFrame, rows: DataFrame) -> DataFrame:
    """results UNION ALL supplement, by name (missing columns NULL)."""
    return union_by_name(results, rows)
