"""Statement statistics from slow logs, and growth forecasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.text import statement_digest


def digests(entries: DataFrame) -> DataFrame:
    return entries.withColumn("digest", statement_digest(F.col("sql_text")))


def digest_profile(digested: DataFrame, top: int = 20, min_calls: int = 1, by: str = "total_ms") -> DataFrame:
    """Calls, times, rows examined per row sent and share of total time per statement shape.

    ``by`` picks the ranking: total_ms, avg_ms, calls or rows_examined.
    """
    profile = digested.groupBy("digest").agg(
        F.count(F.lit(1)).alias("calls"),
        F.round(F.avg("query_time") * 1000, 2).alias("avg_ms"),
        F.round(F.max("query_time") * 1000, 2).alias("max_ms"),
        F.round(F.sum("query_time") * 1000, 2).alias("total_ms"),
        F.sum("rows_examined").alias("rows_examined"),
        F.round(F.try_divide(F.sum("rows_examined"), F.sum("rows_sent")), 2).alias("examined_per_sent"),
    )
    whole = digested.agg(F.sum("query_time") * 1000).scalar()
    shared = profile.withColumn("share_pct", F.round(F.try_divide(F.col("total_ms"), whole) * 100, 1))
    return shared.filter(F.col("calls") >= min_calls).orderBy(F.desc(by), "digest").limit(top)


def repeated_lookups(digested: DataFrame, session: str, at: str, width: str, at_least: int) -> DataFrame:
    """Statement shapes a session ran ``at_least`` times within a window: lookups in a loop."""
    return (
        digested.groupBy(session, F.window(at, width).alias("_w"), "digest")
        .agg(F.count(F.lit(1)).alias("calls"))
        .filter(F.col("calls") >= at_least)
        .select(session, F.col("_w.start").alias("window_start"), "digest", "calls")
    )


def sizes_by_schema(tables: DataFrame) -> DataFrame:
    """Gigabytes per schema from (schema_name, data_bytes, index_bytes) rows."""
    gib = 1024**3
    data, index = F.sum("data_bytes"), F.sum("index_bytes")
    return tables.groupBy("schema_name").agg(
        F.round(data / gib, 2).alias("data_gb"),
        F.round(index / gib, 2).alias("index_gb"),
        F.round((data + index) / gib, 2).alias("total_gb"),
        F.count(F.lit(1)).alias("table_count"),
    )


def growth(snapshots: DataFrame, subject: list[str], period: Column, size: Column, limit: Column) -> DataFrame:
    """Least-squares growth per period, current size and periods until ``limit``.

    One aggregate: a subject's history is never gathered. NULL periods if it does not grow.
    """
    fitted = snapshots.groupBy(*subject).agg(
        F.regr_slope(size, period).alias("growth_per_period"),
        F.max_by(size, period).alias("current_size"),
        F.max(limit).alias("_limit"),
    )
    left = F.when(
        F.col("growth_per_period") > 0, (F.col("_limit") - F.col("current_size")) / F.col("growth_per_period")
    )
    return fitted.withColumn("periods_to_limit", left).drop("_limit")


def cumulative_by_month(monthly: DataFrame, month: str, count: str, name: str) -> DataFrame:
    """Running total over months; one row per month, so one task can hold them all."""
    so_far = Window.orderBy(month).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly.withColumn(name, F.sum(count).over(so_far))
