"""Joins beyond the plain equi join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators.skew import join_one_per_key


def one_value(df: DataFrame) -> Column:
    """The single value of a one-row, one-column frame as an expression (scalar subquery)."""
    return df.scalar()


def as_of_dimension(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    at: Column,
    valid_from: str = "effective_from",
    valid_to: str = "effective_to",
    how: str = "left",
) -> DataFrame:
    """Joins the dimension version valid at ``at``, with half-open validity ``[from, to)``.

    The natural key is an equi key; the validity test only filters the few versions of it.
    """
    versions = dim.alias("_dim")
    held = (F.col(f"_dim.{valid_from}") <= at) & (
        F.col(f"_dim.{valid_to}").isNull() | (F.col(f"_dim.{valid_to}") > at)
    )
    return fact.join(versions, (fact[fact_key] == F.col(f"_dim.{dim_key}")) & held, how)


def range_join(
    points: DataFrame, intervals: DataFrame, point: str, low: str, high: str, width: int
) -> DataFrame:
    """Pairs of a point and an interval with ``low <= point <= high``, by an equi join.

    Numbers are cut into buckets, twice as wide on each level from ``width`` on. An interval is entered
    on the level whose buckets are at least as long as itself, so in two of them at most however long
    it is; a point looks into one bucket of each level that holds an interval (at most 64).
    A NULL bound or point, or an interval that ends before it starts, has no pair.
    """
    length = (F.col(high) - F.col(low) + 1).cast("double")
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(length, F.lit(1.0)) / width))).cast("int")

    def bucket(value: str, on: Column) -> Column:
        return F.floor(F.col(value) / (F.lit(width) * F.pow(F.lit(2.0), on))).cast("long")

    entered = intervals.filter(F.col(low) <= F.col(high)).withColumn("_level", level)
    levels = [row[0] for row in entered.select("_level").distinct().collect()]
    spread = entered.withColumn("_bucket", F.explode(F.sequence(bucket(low, F.col("_level")), bucket(high, F.col("_level")))))
    looked = points.withColumn("_level", F.explode(F.array(*map(F.lit, sorted(levels))).cast("array<int>")))
    placed = looked.withColumn("_bucket", bucket(point, F.col("_level")))
    inside = F.col(point).between(F.col(low), F.col(high))
    return placed.join(spread, ["_level", "_bucket"]).filter(inside).drop("_level", "_bucket")


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """SQL ``NOT IN (subquery)``: a NULL on the right empties the result.

    Built from an anti join against the distinct values, which shuffles both sides
    and splits hot keys; Spark's own null-aware form has to broadcast the right side.
    """
    values = other.select(F.col(other_column).alias(column))
    counts = values.agg(F.count(F.lit(1)).alias("rows"), F.count(column).alias("known"))
    kept = join_one_per_key(df, values.distinct(), [column], "left_anti")
    rows, known = one_value(counts.select("rows")), one_value(counts.select("known"))
    return kept.filter((rows == 0) | (F.col(column).isNotNull() & (rows == known)))


def semi(df: DataFrame, keys: list[str], other: DataFrame, anti: bool = False) -> DataFrame:
    """Rows whose key occurs in ``other`` (``EXISTS``, ``IN``), or does not.

    A semi join cannot split a key that is hot on the right, so the right side is
    first reduced to one row per key.
    """
    return join_one_per_key(df, other.select(*keys).distinct(), keys, "left_anti" if anti else "left_semi")


def count_pairs(df: DataFrame, keys: list[str]) -> DataFrame:
    """Unordered pairs of rows sharing ``keys``, as ``rows`` and ``pairs`` per key.

    A self join with ``a.id < b.id`` emits n*(n-1)/2 rows for a key with n rows;
    the number follows from n alone.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    pairs = F.expr("rows * (rows - 1) div 2")
    return counted.withColumn("pairs", pairs).filter("pairs > 0")


def partners_of(df: DataFrame, keys: list[str], row_id: str, subject) -> DataFrame:
    """Rows sharing ``keys`` with the one row ``subject``: the pairs of a self join, on request."""
    same = [F.col(k) == one_value(df.filter(F.col(row_id) == subject).select(k)) for k in keys]
    return df.filter(reduce(lambda a, b: a & b, same) & (F.col(row_id) != subject))
