"""``foreachBatch`` functions that keep tables from a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderloom.session import cut
from orderloom.sources.tables import merge_partitions
from orderloom.streaming import changes


def upsert_writer(path: str, keys: list[str], partition: str, latest_by: list[str]):
    """Upserts each batch into a partitioned table; a batch run again changes nothing.

    Spark commits the stream position after the function returns.
    """

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        rows = cut(batch, "upsert-batch")
        if not rows.isEmpty():
            merge_partitions(rows, path, keys, partition, latest_by)

    return upsert_batch


def table_of(value: str = "value") -> Column:
    """Table that an envelope names, NULL if it cannot be told."""
    text = F.col(value).cast("string")
    return F.coalesce(*(F.get_json_object(text, f"$.{path}source.table") for path in ("payload.", "")))


def route_writer(
    tables: dict[str, tuple[StructType, list[str], Callable[[DataFrame, int], None]]], dead: str, value: str = "value"
):
    """Messages of several tables in one stream: ``tables`` has the schema, the key columns and the writer of each; a message
    is decoded by its table's schema, once, and goes to its writer.

    What cannot be read, what lacks a key and what names no table of ``tables`` goes to a folder per batch under ``dead``, so
    every message but a tombstone (null) ends in one place.
    """

    def route_batch(batch: DataFrame, batch_id: int) -> None:
        messages = cut(batch.select(value).filter(F.col(value).isNotNull()).withColumn("_table", table_of(value)), "routed-batch")
        listed = F.coalesce(F.col("_table").isin(list(tables)), F.lit(False))
        rest = messages.filter(~listed).select(F.col(value).cast("string").alias("raw"))
        for table, (schema, keys, write) in tables.items():
            parsed = changes.parse_envelopes(messages.filter(F.col("_table") == table), schema, value, keys)
            rest = rest.unionByName(changes.dead_letters(parsed))
            write(changes.change_rows(parsed), batch_id)
        rest.write.mode("overwrite").text(f"{dead}/batch={batch_id}")

    return route_batch


def run(stream: DataFrame, write_batch: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Takes in all there is and stops; the position is committed after each batch."""
    (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
