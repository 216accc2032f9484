"""Event topics. The Kafka package is optional; decoding takes any frame with a ``value``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def topic_name(prefix: str, database: str, table: str) -> str:
    return f"{prefix}.{database}.{table}"


def topic_pattern(prefix: str, database: str, tables: list[str]) -> str:
    """Subscription pattern for one topic per table."""
    return rf"{prefix}\.{database}\.({'|'.join(tables)})"


def subscribe(
    spark: SparkSession, servers: str, pattern: str, starting: str = "earliest", per_trigger: int | None = None
) -> DataFrame:
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", pattern)
        .option("startingOffsets", starting)
    )
    return (reader.option("maxOffsetsPerTrigger", per_trigger) if per_trigger else reader).load()


def decode_json(df: DataFrame, schema: StructType | str, value: str = "value") -> DataFrame:
    """Typed columns from JSON messages; unparsable ones have NULL in all of them."""
    parsed = F.from_json(F.col(value).cast("string"), schema)
    return df.select(parsed.alias("_row")).select("_row.*")


def to_messages(df: DataFrame, key: Column, topic: Column | None = None) -> DataFrame:
    """(key, value[, topic]) messages; equal keys go to one topic partition and stay in order."""
    value = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    columns = [key.cast("string").alias("key"), value.alias("value")]
    return df.select(*columns, *([topic.alias("topic")] if topic is not None else []))


def publish(messages: DataFrame, servers: str, topic: str | None = None) -> None:
    writer = messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
    (writer.option("topic", topic) if topic else writer).save()


def publish_files(messages: DataFrame, path: str) -> None:
    """File stand-in for ``publish``: a directory per topic."""
    writer = messages.write.mode("append")
    if "topic" in messages.columns:
        writer = writer.partitionBy("topic")
    writer.json(path)
