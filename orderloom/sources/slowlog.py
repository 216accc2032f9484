"""Text slow logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY_MARK = "# Time:"


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """One row per log entry; Spark splits large files at the entry mark."""
    return parse_entries(spark.read.option("lineSep", ENTRY_MARK).text(path))


def parse_entries(entries: DataFrame, value: str = "value") -> DataFrame:
    """Typed columns from entry texts that begin after the entry mark."""
    text = F.col(value)

    def number(label: str, kind: str):
        return F.regexp_extract(text, rf"{label}:\s*([0-9.]+)", 1).try_cast(kind)

    body = F.regexp_replace(text, r"(?m)^\s*#.*$|^\s*SET timestamp=\d+;\s*$|^\s*use \S+;\s*$", "")
    without_time = F.regexp_replace(body, r"^\s*\d{4}-\d\d-\d\dT\S*", "")
    time = F.regexp_extract(text, r"^\s*(\d{4}-\d\d-\d\dT[0-9:.]+)", 1)
    return entries.select(
        time.try_cast("timestamp_ntz").alias("time"),
        F.trim(F.regexp_extract(text, r"User@Host:\s*([^\n]*)", 1)).alias("user_host"),
        number("Query_time", "double").alias("query_time"),
        number("Lock_time", "double").alias("lock_time"),
        number("Rows_sent", "long").alias("rows_sent"),
        number("Rows_examined", "long").alias("rows_examined"),
        F.trim(F.regexp_replace(without_time, r"\s+", " ")).alias("sql_text"),
    ).filter(F.col("query_time").isNotNull())


def over_threshold(entries: DataFrame, seconds: float = 1.0, rows: int = 0) -> DataFrame:
    return entries.filter((F.col("query_time") >= seconds) & (F.col("rows_examined") >= rows))
