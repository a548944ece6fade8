"""Evaluation barrier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Evaluate ``columns`` (None: all) once.

    Regex-built and higher-order-function columns are expensive; without a
    barrier the optimizer substitutes them into each later filter and
    projection that uses them (a filter pushed below the projection repeats
    the work).  A one-element ``inline`` (a Generate node) fixes them as
    attributes.  The other columns pass beside it, so filters on them still
    reach the scan."""
    costly = list(df.columns if columns is None else columns)
    struct = F.struct(*[F.col(f"`{c}`") for c in costly])
    if columns is None:
        return df.select(F.inline(F.array(struct)))
    rest = [c for c in df.columns if c not in costly]
    out = df.select(*[F.col(f"`{c}`") for c in rest], F.inline(F.array(struct)))
    return out.select(*[F.col(f"`{c}`") for c in df.columns])
