"""Aggregates with a choice of method."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_counts(
    df: DataFrame, keys: list[str], columns: dict[str, str], approximate: bool = False, error: float = 0.02
) -> DataFrame:
    """Distinct values per key, ``column -> output name``.

    Exact counts group by the values first, so a hot key is spread over them. The
    approximate ones keep a sketch of a few kilobytes per key and shuffle only that.
    """
    if approximate:
        counts = [F.approx_count_distinct(c, error).alias(n) for c, n in columns.items()]
    else:
        counts = [F.countDistinct(c).alias(n) for c, n in columns.items()]
    return df.groupBy(*keys).agg(*counts)
