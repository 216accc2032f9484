"""Streams whose rows come late: what is behind the event-time watermark goes to a table of its own.

The watermark of a batch is the latest event time of all batches before it, less the delay. A stateful Spark operator
drops what is behind its watermark; here such rows are set aside, so that nothing is lost and closed
results can be repaired from them. The only state is that latest time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import cut
from orderloom.sources.batches import BatchTable


def marks_table(spark: SparkSession, path: str, at: str) -> BatchTable:
    """One row: the latest event time (``seen``, microseconds) so far; a row per batch until it is compacted."""

    def latest(rows: DataFrame) -> DataFrame:
        return rows.agg(F.max("seen").alias("seen"))

    def fold(base: DataFrame | None, batches: DataFrame | None) -> DataFrame:
        known = [df for df in (base, batches) if df is not None]
        return latest(reduce(DataFrame.unionByName, known)) if known else spark.range(1).select(F.lit(None).cast("long").alias("seen"))

    return BatchTable(spark, path, lambda batch: latest(batch.select(F.unix_micros(F.col(at).cast("timestamp")).alias("seen"))), fold)


def split_writer(marks: BatchTable, in_time: str, late: str, at: str, delay_seconds: int):
    """A ``foreachBatch`` function that writes each row to ``in_time`` or ``late``, a folder per batch.

    A row is late if its time is before the watermark. Rows without a time cannot be placed and are late
    too. A batch run again sees the marks of the batches before it, so it is split alike and replaces its folders.
    """

    def split_batch(batch: DataFrame, batch_id: int) -> None:
        rows = cut(batch, "late-batch")
        seen = marks.read(before=batch_id).first().seen  # one row
        micros = F.unix_micros(F.col(at).cast("timestamp"))
        mark = None if seen is None else seen - delay_seconds * 1_000_000
        behind = F.col(at).isNull() | F.coalesce(micros < F.lit(mark).cast("long"), F.lit(False))
        rows.filter(~behind).write.mode("overwrite").parquet(f"{in_time}/batch={batch_id}")
        rows.filter(behind).write.mode("overwrite").parquet(f"{late}/batch={batch_id}")
        marks.write_batch(rows, batch_id)

    return split_batch


def repaired(closed: DataFrame, rows: DataFrame, late: DataFrame, group: str, measures: dict[str, Column]) -> DataFrame:
    """``closed``, the measures of ``rows`` per ``group``, brought up to date with ``late`` rows; adds how many came late.

    Only groups that a late row touches are computed anew, from both tables; the others stay as they are.
    """
    touched = late.select(group).distinct()
    kept = closed.join(touched, group, "left_anti").withColumn("repaired", F.lit(0).cast("long"))
    again = rows.join(touched, group, "left_semi").withColumn("_late", F.lit(0)).unionByName(late.withColumn("_late", F.lit(1)))
    redone = again.groupBy(group).agg(*[c.alias(n) for n, c in measures.items()], F.sum("_late").alias("repaired"))
    return kept.unionByName(redone)
