"""Table scans, seeds, copies and partitioned writes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from orderloom.functions.dates import between_half_open
from orderloom.operators.merge import latest_per_key, upsert
from orderloom.session import cut


def scan(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Parquet scan; with a declared schema nothing is inferred and drift shows at once."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def seed(spark: SparkSession, rows: list[tuple], schema: str | StructType) -> DataFrame:
    """A small reference table from literals."""
    return spark.createDataFrame(rows, schema)


def read_csv(spark: SparkSession, path: str, schema: str | StructType, header: bool = True) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=header, mode="FAILFAST")


def extract_window(df: DataFrame, column: str, start: dt.datetime, stop: dt.datetime) -> DataFrame:
    """Rows changed in ``[start, stop)``; the bounds reach the file scan."""
    return df.filter(between_half_open(F.col(column), start, stop))


def create_table_as(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_by(df: DataFrame, path: str, column: str, value: Column | None = None) -> None:
    """Directory per ``column`` value; only the directories present in ``df`` are replaced.

    Rows are gathered by value first, or every task would leave a file in every
    directory; the rebalance hint splits values too large for one task.
    """
    rows = df if value is None else df.withColumn(column, value)
    (
        rows.hint("rebalance", column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def merge_partitions(
    rows: DataFrame, path: str, keys: list[str], partition: str, latest_by: list[str] | None = None
) -> None:
    """Upserts ``rows`` into a partitioned table, rewriting only the partitions they touch.

    A key must always fall into the same partition (a date or month that never
    changes). The merged rows are written aside first, since a directory cannot be
    replaced while it is read. ``rows`` must already be cut from what they came from.
    """
    spark = rows.sparkSession
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        write_by(latest_per_key(rows, keys, latest_by) if latest_by else rows, path, partition)
        return
    touched = rows.select(F.col(partition).alias("_touched")).distinct()
    # No more than there are directories; a shuffle by partition would bring each of them to one task whole.
    held = stored.join(F.broadcast(touched), F.col(partition).eqNullSafe(F.col("_touched")), "left_semi")
    write_by(cut(upsert(held, rows, keys, latest_by=latest_by), "merged"), path, partition)


def file_row_count(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet table; Spark answers a bare count from the file footers."""
    return spark.read.option("aggregatePushdown", "true").parquet(path).count()


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))


def estimated_rows(spark: SparkSession, table: str) -> int | None:
    """Row count from catalog statistics, None before ``analyze``."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Statistics'").collect()
    for row in described:
        for part in row["data_type"].split(","):
            if part.strip().endswith("rows"):
                return int(part.split()[0])
    return None


def analyze(spark: SparkSession, table: str) -> None:
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
