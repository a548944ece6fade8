"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; columns missing on one side become NULL and
    types widen (INT + DOUBLE -> DOUBLE)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
