"""Aggregates kept up to date from an event stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.sources.batches import BatchTable


def totals_table(spark: SparkSession, path: str, keys: list[str], measures: dict[str, Column]) -> BatchTable:
    """Sums per key over all events of a stream. ``measures`` must be sums or counts."""

    def fold(base: DataFrame | None, batches: DataFrame | None) -> DataFrame:
        if base is None or batches is None:
            parts = batches if base is None else base
        else:
            parts = base.unionByName(batches)
        sums = [F.sum(n).cast(parts.schema[n].dataType).alias(n) for n in measures]
        return parts.groupBy(*keys).agg(*sums)

    def sums_of(batch: DataFrame) -> DataFrame:
        return batch.groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])

    return BatchTable(spark, path, sums_of, fold)


def window_counts(events: DataFrame, key: str, at: str, width: str, late: str | None = None) -> DataFrame:
    """Requests per key and fixed window; on a stream ``late`` sets the watermark.

    A watermark needs a zoned timestamp, so ``at`` is cast.
    """
    timed = events.withColumn("_at", F.col(at).cast("timestamp"))
    if late:
        timed = timed.withWatermark("_at", late)
    counted = timed.groupBy(F.window("_at", width).alias("_w"), key).agg(
        F.count(F.lit(1)).alias("requests")
    )
    return counted.select(
        key, F.col("_w.start").cast("timestamp_ntz").alias("window_start"), "requests"
    )


def run_to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Runs an append-mode stream over all input there is, into Parquet files."""
    (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
