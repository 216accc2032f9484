"""Tables fed by a stream, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from orderloom.sources.snapshots import SnapshotTable


class BatchTable:
    """A base version plus the reduced result of every batch since.

    A batch costs what it brings, not what the table holds: it is reduced and
    written to a folder of its own, which a repeated batch replaces, so each batch
    counts once. Readers fold base and batches; ``compact`` makes the fold of all but the newest batch the new
    base and is due whenever reading has become slow.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        reduce_batch: Callable[[DataFrame], DataFrame],
        fold: Callable[[DataFrame | None, DataFrame | None], DataFrame],
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.base = SnapshotTable(spark, f"{self.path}/base")
        self._reduce = reduce_batch
        self._fold = fold

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """For ``foreachBatch``."""
        self._reduce(batch).write.mode("overwrite").parquet(f"{self.path}/batches/batch={batch_id}")

    def _batches(self, before: int | None = None) -> DataFrame | None:
        try:
            rows = self.spark.read.parquet(f"{self.path}/batches")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                return None
            raise
        folded = self.base.tag()
        rows = rows if folded is None else rows.filter(F.col("batch") > int(folded))
        return rows if before is None else rows.filter(F.col("batch") < before)

    def read(self, before: int | None = None) -> DataFrame:
        """The table; with ``before``, as it was when that batch began, also if it runs again."""
        batches = self._batches(before)
        base = self.base.read() if self.base.exists() else None
        return self._fold(base, None if batches is None else batches.drop("batch"))

    def compact(self) -> None:
        """Folds all batches but the newest into the base: that one may not be committed yet, and if
        it runs again it must find the table as it was before."""
        batches = self._batches()
        newest = None if batches is None else batches.agg(F.max("batch").alias("b")).first().b
        older = None if newest is None else self._batches(before=newest)
        if older is not None and not older.isEmpty():
            self.base.replace(self.read(before=newest), tag=str(newest - 1))

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        """Takes in all the stream has; the position is committed after each batch."""
        (
            stream.writeStream.foreachBatch(self.write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
