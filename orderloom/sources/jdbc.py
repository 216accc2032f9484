"""Database reads and writes over JDBC. The driver jar is the cluster's business."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def options(url: str, table: str, user: str, password: str, driver: str = "com.mysql.cj.jdbc.Driver") -> dict[str, str]:
    return {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}


def partition_options(column: str, lower: int, upper: int, readers: int) -> dict[str, str]:
    """Splits the read over ``readers`` tasks. The bounds place the cuts, they drop no rows."""
    if readers < 1 or lower >= upper:
        raise ValueError("needs at least one reader and lower < upper")
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(readers),
    }


def read(spark: SparkSession, connection: dict[str, str], fetch_size: int = 10_000) -> DataFrame:
    return spark.read.format("jdbc").options(**connection).option("fetchsize", fetch_size).load()


def read_partitioned(spark: SparkSession, connection: dict[str, str], split: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**connection, **split).load()


def write(df: DataFrame, connection: dict[str, str], mode: str = "append", batch_size: int = 10_000) -> None:
    """``overwrite`` empties the table and keeps its definition."""
    writer = df.write.format("jdbc").options(**connection).option("batchsize", batch_size)
    if mode == "overwrite":
        writer = writer.option("truncate", "true")
    writer.mode(mode).save()


def stream_writer(connection: dict[str, str], mode: str = "append"):
    """A ``foreachBatch`` function; Spark has no streaming JDBC sink."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write(batch, connection, mode)

    return write_batch
