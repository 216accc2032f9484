"""Session settings, and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One key may hold a third of a table: let joins split it even if that costs a shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


#: Folders of local sessions that name none, by application.
_own_folders: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job here relies on to an existing session, once: later
    changes by the caller stay."""
    if spark.conf.get("orderloom.tuned", None):
        return spark
    spark.conf.set("orderloom.tuned", "true")
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("orderloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Recording the Python line of every column call makes building a plan twice as slow.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, as named by the cluster.

    Only a local session, where driver and executors are one process, may fall
    back to a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="orderloom-")
    return _own_folders[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def write_once(df: DataFrame, path: str) -> None:
    """Write ``df``; what the write has shuffled is dropped at once, not when the driver next collects its garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(key, before)


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of replaying the
    steps before, and what was decided once (such as row positions) stays decided.
    """
    path = new_folder(df.sparkSession, label)
    write_once(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
