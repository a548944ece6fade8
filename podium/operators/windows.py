"""Date-window membership of free-text event dates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.functions.dates import any_date_between, dates_to_iso, parse_event_dates
from podium.operators.groupwise import leaderboard
from podium.operators.partitioning import evaluate_once

WINDOWS_SCHEMA = T.StructType([
    T.StructField("window_id", T.StringType(), False),
    T.StructField("lo", T.DateType(), False),
    T.StructField("hi", T.DateType(), False),
])

def _d(x) -> dt.date:
    return x if isinstance(x, dt.date) else dt.date.fromisoformat(str(x))


def windows_frame(spark: SparkSession, windows: Mapping[str, tuple] | Sequence[tuple]) -> DataFrame:
    """``{id: (lo, hi)}`` or ``[(id, lo, hi)]`` -> windows(window_id, lo, hi)."""
    items = windows.items() if isinstance(windows, Mapping) else [(w[0], (w[1], w[2])) for w in windows]
    rows = [(str(k), _d(lo), _d(hi)) for k, (lo, hi) in items]
    return spark.createDataFrame(rows, WINDOWS_SCHEMA)


def window_hull(windows: Mapping[str, tuple]) -> tuple[dt.date, dt.date]:
    """Smallest single window covering all windows: [min(lo), max(hi)]."""
    los = [_d(lo) for lo, _ in windows.values()]
    his = [_d(hi) for _, hi in windows.values()]
    return min(los), max(his)


def window_flags(df: DataFrame, windows: Mapping[str, tuple], dates: str = "dates",
                 prefix: str = "in_") -> DataFrame:
    """One boolean column per window (``in_<id>``): any parsed date inside it.

    The windows are literals folded into the projection, so membership costs no
    join and no shuffle; one start may belong to several (overlapping) windows."""
    out = df
    for wid, (lo, hi) in windows.items():
        out = out.withColumn(prefix + wid, any_date_between(dates, _d(lo), _d(hi)))
    return out


def _month(d: Column) -> Column:
    return F.year(d) * 12 + F.month(d)


def window_membership(df: DataFrame, windows: DataFrame, date_text: str = "date_text") -> DataFrame:
    """Rows x windows they fall in (a row may match several overlapping windows).

    Dates meet windows by an equi join on the month, the range is checked after;
    a row matches a window through its smallest date inside it only, so each row
    and window pair comes out once and equal rows stay as many as they are."""
    with_dates = evaluate_once(df.withColumn("__dates", parse_event_dates(date_text)), ["__dates"])
    exploded = with_dates.withColumn("__d", F.explode("__dates")).withColumn("__m", _month(F.col("__d")))
    by_month = windows.where("lo <= hi").withColumn("__m", F.explode(F.sequence(_month(F.col("lo")), _month(F.col("hi")))))
    inside = lambda x: (x >= F.col("lo")) & (x <= F.col("hi"))
    joined = exploded.join(by_month, "__m").where(inside(F.col("__d")))
    first = joined.where(~F.exists("__dates", lambda x: (x < F.col("__d")) & inside(x)))
    return first.drop("__d", "__m", "__dates", "lo", "hi")


def events_in_period(events: DataFrame, lo, hi, date_text: str = "date_text") -> DataFrame:
    """Events having a parsed date in [lo, hi], with the ISO date list added."""
    parsed = evaluate_once(events.withColumn("__dates", parse_event_dates(date_text)), ["__dates"])
    return (parsed.withColumn("dates_iso", dates_to_iso("__dates"))
            .filter(any_date_between("__dates", _d(lo), _d(hi))).drop("__dates"))


def period_positions(events: DataFrame, position: str = "position") -> DataFrame:
    """Events of a period in report order - date text, then name; then URL, to
    make it total - numbered from 1."""
    order = [F.col(c).asc_nulls_last() for c in ("date_text", "event_name", "results_url")]
    return leaderboard(events, order, place=position)
