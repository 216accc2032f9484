"""Tables that are replaced as a whole, and the small state rows of incremental loads.

Parquet cannot be overwritten while it is read. A new version goes to its own
folder and counts from the moment one row naming it is appended to the version
list; a job that fails before leaves the old version in force. One writer per table.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

VERSION_SCHEMA = "version long, folder string, tag string, written_at timestamp"
MARK_SCHEMA = "name string, last_processed timestamp_ntz, written_at timestamp"


def read_rows(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The rows of JSON files; None if there is no such folder."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


class SnapshotTable:
    """A Parquet table with whole-table versions under one path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _latest(self):
        versions = read_rows(self.spark, f"{self.path}/versions", VERSION_SCHEMA)
        return None if versions is None else versions.orderBy(F.desc("version")).first()

    def exists(self) -> bool:
        return self._latest() is not None

    def tag(self) -> str | None:
        """What the current version was written for (a batch id, say)."""
        latest = self._latest()
        return latest and latest.tag

    def read(self, version: int | None = None) -> DataFrame:
        if version is None:
            row = self._latest()
        else:
            versions = read_rows(self.spark, f"{self.path}/versions", VERSION_SCHEMA)
            row = versions.filter(F.col("version") == version).first()
        if row is None:
            raise FileNotFoundError(f"no such version in {self.path}")
        return self.spark.read.parquet(f"{self.path}/{row.folder}")

    def replace(self, df: DataFrame, tag: str | None = None) -> int:
        """Writes the next version; ``df`` may well be computed from the current one."""
        latest = self._latest()
        version = latest.version + 1 if latest else 1
        folder = f"v{version}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        row = self.spark.createDataFrame([(version, folder, tag, _now())], VERSION_SCHEMA)
        row.coalesce(1).write.mode("append").json(f"{self.path}/versions")
        return version


class WatermarkStore:
    """High-water marks by load name; the newest row per name counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def get(self, name: str) -> dt.datetime | None:
        marks = read_rows(self.spark, self.path, MARK_SCHEMA)
        if marks is None:
            return None
        row = marks.filter(F.col("name") == name).orderBy(F.desc("written_at")).first()
        return row and row.last_processed

    def put(self, name: str, last_processed: dt.datetime) -> None:
        row = self.spark.createDataFrame([(name, last_processed, _now())], MARK_SCHEMA)
        row.coalesce(1).write.mode("append").json(self.path)
