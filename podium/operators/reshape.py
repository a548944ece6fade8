"""Pivot / unpivot / nesting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_ordinals(ordinal: str, value: str, n: int, prefix: str) -> list[Column]:
    """Aggregates ``prefix1 .. prefix<n>``: the value at ordinal k (NULL if absent).

    Always ``n`` columns, so the schema does not depend on the data; use inside a
    ``groupBy(...).agg(...)`` together with other aggregates of the same group."""
    return [F.max(F.when(F.col(ordinal) == k, F.col(value))).alias(f"{prefix}{k}") for k in range(1, n + 1)]


def unpivot_measures(df: DataFrame, ids: Sequence[str], measures: Sequence[str],
                     code: str = "code", value: str = "value") -> DataFrame:
    """Wide -> long over the measure columns that exist in ``df``."""
    present = [m for m in measures if m in df.columns]
    if not present:
        return df.select(*ids, F.lit(None).cast("string").alias(code),
                         F.lit(None).cast("double").alias(value)).limit(0)
    return df.select(*ids, *[F.col(m).cast("double").alias(m) for m in present]) \
        .unpivot(list(ids), present, code, value)


def nest_rows(df: DataFrame, keys: Sequence[str], fields: Sequence[str], name: str,
              sort_key: Sequence[str] = ()) -> DataFrame:
    """``keys`` -> ARRAY<STRUCT<fields>> sorted by ``sort_key`` (fields prefix)."""
    order = list(sort_key)
    rest = [f for f in fields if f not in order]
    items = F.collect_list(F.struct(*order, *rest))
    return df.groupBy(*keys).agg(F.array_sort(items).alias(name))
