"""Intermediate tables of one operator, dropped as a whole once its result is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderloom.session import new_folder, write_once


class Scratch:
    """Tables in one folder of the shared folder. Nothing that is still to be computed may depend on them
    when they are dropped."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.folder, self._n = spark, new_folder(spark, label), 0
        self._paths: dict[str, str] = {}

    def cut(self, df: DataFrame, label: str) -> DataFrame:
        """``df`` written once and read back; its lineage ends there."""
        self._n += 1
        path = self._paths[label] = f"{self.folder}/{self._n}-{label}"
        write_once(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, label: str | None = None) -> None:
        """The last table of that label, or all."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._paths.pop(label) if label else self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
