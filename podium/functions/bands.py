"""Threshold banding (award ladders)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from podium import constants as K


def threshold_band(points, category, ladders=None) -> Column:
    """Label of the highest ladder step whose lower bound ``points`` reaches.

    ``ladders`` maps an upper-cased, trimmed category to ``((lower, label), ...)``
    highest first; key ``"*"`` is the ladder of every other category.  NULL
    points or points below every step give ''."""
    ladders = ladders or K.AWARD_LADDERS
    pts = F.col(points) if isinstance(points, str) else points
    cat = F.upper(F.trim(F.col(category) if isinstance(category, str) else category))

    def chain(steps):
        expr = None
        for lower, label in steps:
            cond = pts >= F.lit(float(lower))
            expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
        return expr.otherwise(F.lit(""))

    out = chain(ladders["*"])
    for key, steps in ladders.items():
        if key == "*":
            continue
        out = F.when(cat == F.lit(key), chain(steps)).otherwise(out)
    return F.when(pts.isNull(), F.lit("")).otherwise(out)
