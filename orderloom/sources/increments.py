"""Tables that grow by increments, merged when they are read.

A run writes its own rows beside the table and one row that names them, so it costs what it brings,
not what the table holds. Readers take the newest row of each key from the runs, and the base's rows for all other keys:
the keys of the runs meet the base in an anti join, which Spark broadcasts while they are few. Once the runs hold
more than a share of the base, the next run first folds them into a new base, so that a row is
rewritten (1 + share) / share times on average, however long the table lives. One writer per table.

Files are sorted by a hash of the key and carry Parquet's Bloom filters on it; the base is split along it as well.
``find`` therefore opens the few row groups that may hold a key.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderloom.operators.merge import align, latest_per_key
from orderloom.sources.snapshots import read_rows

LOG_SCHEMA = "run long, attempt string, base boolean, tag string, columns string, row_count long"
KEY_HASH = "_key_hash"


def _same(left: str, right: str, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


class IncrementTable:
    """A Parquet table with one row per key, fed run by run. A NULL key is a key like any other.

    Without ``keys`` it can only be replaced. ``share`` is the part of the base that the runs may hold before they are folded, ``most_runs`` their largest number.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], share: float = 0.25, most_runs: int = 50):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = keys
        self.share = share
        self.most_runs = most_runs

    def log(self) -> list:
        """The newest base and the runs since, at most ``most_runs`` of them, in order."""
        rows = read_rows(self.spark, f"{self.path}/log", LOG_SCHEMA)
        if rows is None:
            return []
        base = rows.filter("base").agg(F.max("run")).first()[0]
        return rows.filter(F.col("run") >= base).orderBy("run").collect()

    def exists(self) -> bool:
        return bool(self.log())

    def _schema(self, log: list) -> StructType:
        return StructType.fromJson(json.loads(log[-1].columns))

    def _files(self, entries: list, schema: StructType) -> DataFrame:
        """The rows of some runs, each with its run; columns that a run did not have yet are NULL."""
        folders = [f"{self.path}/rows/_run={e.run}/_attempt={e.attempt}" for e in entries]
        known = StructType(list(schema.fields)).add(KEY_HASH, "long").add("_run", "long").add("_attempt", "string")
        return self.spark.read.option("basePath", f"{self.path}/rows").schema(known).parquet(*folders)

    def _write(self, df: DataFrame, base: bool, tag: str | None, run: int, unique: bool = True) -> None:
        attempt = uuid.uuid4().hex
        folder = f"{self.path}/rows/_run={run}/_attempt={attempt}"
        if self.keys:
            hashed = df.withColumn(KEY_HASH, F.xxhash64(*self.keys))
            arranged = hashed.repartitionByRange(KEY_HASH) if base else hashed.hint("rebalance")
            arranged = arranged.sortWithinPartitions(KEY_HASH)
        else:
            arranged = df.withColumn(KEY_HASH, F.lit(None).cast("long"))
        arranged.write.option(f"parquet.bloom.filter.enabled#{KEY_HASH}", "true").parquet(folder)
        written = self.spark.read.schema(StructType(list(df.schema.fields)).add(KEY_HASH, "long")).parquet(folder)
        if unique and not written.groupBy(*self.keys).count().filter("count > 1").isEmpty():
            raise ValueError(f"the increment holds a key ({', '.join(self.keys)}) more than once; nothing was added")
        entry = (run, attempt, base, tag, df.schema.json(), written.count())
        self.spark.createDataFrame([entry], LOG_SCHEMA).coalesce(1).write.mode("append").json(f"{self.path}/log")

    def replace(self, df: DataFrame, tag: str | None = None) -> None:
        """``df`` becomes the whole table; it may well be computed from it. Its keys are not checked."""
        log = self.log()
        self._write(df, True, tag, log[-1].run + 1 if log else 1, unique=False)

    def append(
        self,
        df: DataFrame,
        tag: str | None = None,
        latest_by: list[str] | None = None,
        on_schema_change: str = "append_new_columns",
    ) -> bool:
        """Adds the rows of ``df`` and overwrites those with a known key; the first run makes the table.

        A run whose ``tag`` was added before does nothing and gives False, so a repeated job counts once. ``latest_by``
        first reduces ``df`` to the last row per key; without it keys must be unique in ``df``, or nothing is
        added and the call fails. New columns are added or refused; columns that ``df`` lacks become NULL in its rows.
        """
        log = self.log()
        if log and tag is not None:
            rows = read_rows(self.spark, f"{self.path}/log", LOG_SCHEMA)
            if not rows.filter(F.col("tag") == tag).isEmpty():
                return False
        if latest_by:
            df = latest_per_key(df, self.keys, latest_by)
        if log:
            empty = self.spark.createDataFrame([], self._schema(log))
            full, wide = align(df, empty, on_schema_change)
            df = full.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wide.schema])
        if self.due(log):
            self.compact()
            log = self.log()
        self._write(df, not log, tag, log[-1].run + 1 if log else 1)
        return True

    def due(self, log: list | None = None) -> bool:
        """Whether the runs are to be folded into the base."""
        log = self.log() if log is None else log
        runs = sum(e.row_count for e in log[1:])
        return bool(log) and (runs > self.share * log[0].row_count or len(log) > self.most_runs)

    def compact(self) -> None:
        """Folds the runs into a new base; one that fails halfway leaves the old one in force."""
        self.replace(self.read())

    def _merged(self, log: list, only: Column | None = None) -> DataFrame:
        schema = self._schema(log)
        sides = [self._files(part, schema) if part else None for part in (log[:1], log[1:])]
        base, runs = (s if s is None or only is None else s.filter(only) for s in sides)
        if runs is None:
            return base.select(*schema.names)
        newest = latest_per_key(runs, self.keys, ["_run"]) if len(log) > 2 else runs
        others = base.alias("b").join(newest.select(*self.keys).alias("n"), _same("b", "n", self.keys), "left_anti")
        return others.select(*schema.names).unionByName(newest.select(*schema.names))

    def read(self) -> DataFrame:
        """The table as of its last run."""
        log = self.log()
        if not log:
            raise FileNotFoundError(f"no table in {self.path}")
        return self._merged(log)

    def find(self, values: list[tuple]) -> DataFrame:
        """The rows with one of a short list of keys, from the row groups that may hold them."""
        log = self.log()
        schema = self._schema(log)
        wanted = self.spark.createDataFrame(values, StructType([schema[k] for k in self.keys]))
        hashes = [row[0] for row in wanted.select(F.xxhash64(*self.keys)).distinct().collect()]  # as many as were asked for
        near = self._merged(log, F.col(KEY_HASH).isin(hashes) | F.col(KEY_HASH).isNull())
        return near.alias("r").join(F.broadcast(wanted.distinct()).alias("w"), _same("r", "w", self.keys), "left_semi")
