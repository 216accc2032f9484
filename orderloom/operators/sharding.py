"""Shard placement, balance and resharding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The ring table has one row per leading three hex digits of the hash.
PREFIX_DIGITS = 3


def hash_shard(key: Column, shards: int) -> Column:
    return F.pmod(key, F.lit(shards))


def range_shard(key: Column, bounds: list) -> Column:
    """0 below the first bound, then one more for every bound reached."""
    shard = F.lit(0)
    for number, bound in enumerate(bounds, start=1):
        shard = F.when(key >= bound, number).otherwise(shard)
    return shard


def directory_shard(df: DataFrame, directory: DataFrame, key: str, default: str | None = None) -> DataFrame:
    """Shard from a lookup table ``(key, shard)``; unlisted keys get ``default``."""
    found = df.join(directory.select(key, "shard"), key, "left")
    return found if default is None else found.withColumn("shard", F.coalesce("shard", F.lit(default)))


def ring_points(spark: SparkSession, nodes: list[str], replicas: int) -> DataFrame:
    """Positions of the virtual nodes: MD5 of ``node:i`` as hex text, which sorts as the number does."""
    names = spark.createDataFrame([(n,) for n in nodes], "node string")
    virtual = names.select("node", F.explode(F.sequence(F.lit(0), F.lit(replicas - 1))).alias("i"))
    return virtual.select(F.md5(F.concat_ws(":", "node", F.col("i").cast("string"))).alias("position"), "node")


def _ring_table(ring: DataFrame) -> DataFrame:
    """Per hash prefix: the positions inside it, and the node that follows all of them.

    Always 4096 rows. Sorted twice around the ring, so that the last positions
    find their successor at the start.
    """
    spark = ring.sparkSession
    prefixes = spark.range(16**PREFIX_DIGITS).select(
        F.lpad(F.lower(F.hex("id")), PREFIX_DIGITS, "0").alias("prefix")
    )
    inside = ring.groupBy(F.substring("position", 1, PREFIX_DIGITS).alias("prefix")).agg(
        F.sort_array(F.collect_list(F.struct("position", "node"))).alias("points")
    )  # bounded by nodes x replicas
    table = prefixes.join(inside, "prefix", "left")
    following = Window.orderBy("prefix").rowsBetween(1, Window.unboundedFollowing)
    first_node = F.try_element_at("points", F.lit(1))["node"]
    start = F.first(first_node, ignorenulls=True).over(
        Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return table.select(
        "prefix",
        "points",
        F.coalesce(F.first(first_node, ignorenulls=True).over(following), start).alias("successor"),
    )


def ring_shard(df: DataFrame, key: Column, ring: DataFrame, name: str = "shard") -> DataFrame:
    """First ring node clockwise from MD5 of ``key``, the one strictly behind it.

    Each row looks at the few positions that share its hash prefix, found with one
    hash lookup in a 4096-row table, instead of at the whole ring.
    """
    hashed = df.withColumn("_hash", F.md5(key)).withColumn("prefix", F.substring("_hash", 1, PREFIX_DIGITS))
    placed = hashed.join(F.broadcast(_ring_table(ring)), "prefix")
    behind = F.filter("points", lambda p: p["position"] > F.col("_hash"))
    node = F.coalesce(F.try_element_at(behind, F.lit(1))["node"], F.col("successor"))
    return placed.select(*df.columns, node.alias(name))


def distribution(df: DataFrame, shard: str) -> DataFrame:
    """Rows and share per shard, and the load relative to an even spread."""
    counted = df.groupBy(shard).agg(F.count(F.lit(1)).alias("rows"))
    everything = Window.partitionBy()  # one row per shard
    total, shards = F.sum("rows").over(everything), F.count(F.lit(1)).over(everything)
    return counted.select(
        shard,
        "rows",
        F.round(F.col("rows") / total * 100, 2).alias("share_pct"),
        F.round(F.col("rows") * shards / total, 4).alias("skew"),
    )


def moved_fraction(df: DataFrame, before: Column, after: Column) -> DataFrame:
    """One row: keys, keys whose shard changes, and their fraction."""
    moved = F.count_if(~before.eqNullSafe(after))
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("keys"), moved.alias("moved"), F.round(F.try_divide(moved, total), 4).alias("fraction")
    )


def write_sharded(df: DataFrame, shard: Column, path: str, name: str = "shard") -> None:
    """Directory per shard; a filter on the shard column then reads that directory only.

    The rebalance hint gathers a shard's rows, and splits a large shard over tasks.
    """
    df.withColumn(name, shard).hint("rebalance", name).write.mode("overwrite").partitionBy(name).parquet(path)


def split_shard(spark: SparkSession, path: str, old, shard: Column, into: str, name: str = "shard") -> None:
    """Writes the rows of one shard to ``into``, under the shards ``shard`` names.

    Only that shard's directory is read. Point readers at the new directories and
    then drop the old one; until that, it is intact.
    """
    rows = spark.read.parquet(path).filter(F.col(name) == old).drop(name)
    write_sharded(rows, shard, into, name)


def per_shard_and_total(df: DataFrame, shard: str, measures: dict[str, Column]) -> DataFrame:
    """Partial result per shard and the merged total, which adds up the partial results only."""
    partial = df.groupBy(F.col(shard).cast("string").alias("source")).agg(*[c.alias(n) for n, c in measures.items()])
    total = partial.agg(*[F.sum(n).alias(n) for n in measures]).withColumn("source", F.lit("total"))
    return partial.unionByName(total)


def federated(regions: dict[str, DataFrame], name: str = "region") -> DataFrame:
    """One view over same-shaped regional tables, each row tagged with its region."""
    return reduce(DataFrame.unionByName, [df.withColumn(name, F.lit(r)) for r, df in regions.items()])
