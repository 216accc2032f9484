"""Outbox: pending events are published in order of age and marked. At least once; consumers drop repeats."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from orderloom.operators.merge import update_where
from orderloom.session import cut
from orderloom.sources.snapshots import SnapshotTable, WatermarkStore

OUTCOME = "id long, created_at timestamp_ntz, outcome string, at timestamp_ntz"


def next_batch(outbox: DataFrame, size: int = 100) -> DataFrame:
    """The oldest pending rows. A batch is this small by definition."""
    return outbox.filter("status = 'pending'").orderBy("created_at", "id").limit(size)


def route(events: DataFrame, prefix: str = "") -> DataFrame:
    """Messages whose topic is the event type and whose key is the entity."""
    return events.select(
        F.concat(F.lit(prefix), F.col("event_type")).alias("topic"),
        F.col("aggregate_id").cast("string").alias("key"),
        F.col("payload").alias("value"),
    )


def settle(outbox: DataFrame, outcome: DataFrame, at: Column) -> DataFrame:
    """Marks rows ``published`` or ``failed`` by ``outcome(id, ok)``; failures count a retry."""
    joined = outbox.join(outcome.select("id", "ok"), "id", "left")
    done = update_where(joined, F.col("ok"), {"status": F.lit("published"), "published_at": at})
    failed = update_where(
        done, ~F.col("ok"), {"status": F.lit("failed"), "retry_count": F.col("retry_count") + 1}
    )
    return failed.select(*outbox.columns)


def requeue(outbox: DataFrame, max_retries: int = 3) -> DataFrame:
    """Failed rows with retries left become pending again."""
    again = (F.col("status") == "failed") & (F.col("retry_count") < max_retries)
    return update_where(outbox, again, {"status": F.lit("pending")})


class OutboxLog:
    """An outbox that is never rewritten to settle a batch: what became of rows is appended next to them.

    The table is a base version, rows inserted since and outcomes since, each write in a folder of its own with a growing
    ``turn``. Readers fold the last outcome of a row into it. A cursor tells the time before which nothing is pending, so a
    batch is looked for among the rows behind it. Rows may arrive ``grace_seconds`` later than their
    ``created_at`` says; those without one are always looked at. ``compact`` makes the fold the new base. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, grace_seconds: int = 3600):
        self.spark, self.path, self.grace = spark, path.rstrip("/"), grace_seconds
        self.base = SnapshotTable(spark, f"{self.path}/base")
        self.marks = WatermarkStore(spark, f"{self.path}/cursor")

    def _write(self, rows: DataFrame, kind: str) -> None:
        rows.write.parquet(f"{self.path}/{kind}/turn={time.time_ns()}")

    def _since_base(self, kind: str, schema: str | StructType) -> DataFrame:
        kinds = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        try:
            rows = self.spark.read.schema(StructType([*kinds.fields, T.StructField("turn", T.LongType())])).parquet(f"{self.path}/{kind}")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            rows = self.spark.createDataFrame([], kinds).withColumn("turn", F.lit(0).cast("long"))
        return rows.filter(F.col("turn") > int(self.base.tag() or 0))

    def insert(self, rows: DataFrame) -> None:
        """New rows; the first call makes the table."""
        if self.base.exists():
            self._write(rows, "inserted")
        else:
            self.base.replace(rows, tag="0")

    def _rows(self) -> DataFrame:
        base = self.base.read()
        return base.unionByName(self._since_base("inserted", base.schema).drop("turn"))

    def _outcomes(self) -> DataFrame:
        return self._since_base("outcomes", OUTCOME)

    def _folded(self, rows: DataFrame, outcomes: DataFrame) -> DataFrame:
        last = outcomes.groupBy("id").agg(
            F.max_by(F.struct("outcome", "at"), "turn").alias("_last"), F.sum((F.col("outcome") == "failed").cast("int")).alias("_failed")
        )
        known = F.col("_last").isNotNull()
        values = {
            "status": F.when(known, F.col("_last.outcome")).otherwise(F.col("status")),
            "published_at": F.when(F.col("_last.outcome") == "published", F.col("_last.at")).otherwise(F.col("published_at")),
            "retry_count": F.col("retry_count") + F.coalesce("_failed", F.lit(0)),
        }
        joined = rows.join(last, "id", "left").withColumns({n: v.cast(rows.schema[n].dataType) for n, v in values.items()})
        return joined.select(*rows.columns)

    def read(self) -> DataFrame:
        return self._folded(self._rows(), self._outcomes())

    def pending(self, size: int = 100) -> DataFrame:
        """The oldest pending rows."""
        rows, outcomes, cursor = self._rows(), self._outcomes(), self.marks.get("cursor")
        if cursor is not None:
            behind = (F.col("created_at") >= F.lit(cursor)) | F.col("created_at").isNull()
            rows, outcomes = rows.filter(behind), outcomes.filter(behind)
        return next_batch(self._folded(rows, outcomes), size)

    def _append(self, rows: DataFrame, outcome: Column, at: Column) -> None:
        found = rows.select("id", "created_at", outcome.alias("outcome"), at.cast("timestamp_ntz").alias("at"))
        self._write(found.coalesce(1), "outcomes")

    def drain(self, publish: Callable[[DataFrame], None], at: Column, size: int = 100, prefix: str = "") -> int:
        """Publishes one batch and appends what became of it; gives its size. A failing ``publish`` marks the batch failed.

        Writes as many rows as the batch has, whatever the table holds. Ended in between, the batch is published again.
        """
        batch = cut(self.pending(size), "outbox-batch")
        count, newest = batch.agg(F.count(F.lit(1)), F.max("created_at")).first()
        if count == 0:
            return 0
        try:
            publish(route(batch, prefix))
            ok = True
        except Exception:  # whatever the sink raises, the rows are to be tried again
            ok = False
        self._append(batch, F.lit("published" if ok else "failed"), at)
        # All that was pending and older is in this batch or was in one before.
        if newest is not None:
            self.marks.put("cursor", newest - dt.timedelta(seconds=self.grace))
        return count

    def requeue(self, at: Column, max_retries: int = 3) -> int:
        """Failed rows with retries left become pending again; the cursor goes back to the oldest of them."""
        again = cut(self.read().filter((F.col("status") == "failed") & (F.col("retry_count") < max_retries)), "outbox-again")
        count, oldest = again.agg(F.count(F.lit(1)), F.min("created_at")).first()
        if count:
            self._append(again, F.lit("pending"), at)
            cursor = self.marks.get("cursor")
            if oldest is not None and cursor is not None:
                self.marks.put("cursor", min(oldest, cursor))
        return count

    def compact(self, purge_before: Column | None = None) -> None:
        """Folds all outcomes into a new base, without the rows published before ``purge_before``."""
        turn, rows = time.time_ns(), self.read()
        self.base.replace(rows if purge_before is None else purge(rows, purge_before), tag=str(turn))


def purge(outbox: DataFrame, before: Column) -> DataFrame:
    """Drops rows published before the given time."""
    old = (F.col("status") == "published") & (F.col("published_at") < before)
    return outbox.filter(~F.coalesce(old, F.lit(False)))
