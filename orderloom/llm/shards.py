"""Contiguous shards of near equal bytes, from global prefix sums. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.session import cut


def text_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of a text; none if null."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")


def byte_shards(rows: DataFrame, shards: int, size: Column, order: list[str]) -> DataFrame:
    """``rows`` with size, shard (0 to shards - 1) and slot (gapless from 0 within the shard).

    In the order of ``order`` (nulls first, ties by place in the input) the row whose middle byte lies at m of t bytes goes
    to shard m * shards / t, so every shard is a contiguous stretch and misses its equal share by at most half
    a row at each end. A single row of more than a share leaves shards empty.

    The rows are dealt to ranges of the order and written once; then one total per range
    gives each range its start, and a running sum within the range the rest. Equal keys
    are split by their place, so a repeated key is no hot range. Rows of size
    0 are fine as long as not all are; no rows give no rows. Columns named size, shard or slot are replaced.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The row's own columns travel in one struct, so their names are free.
    kept = F.struct(*(c for c in rows.columns if c not in ("size", "shard", "slot"))).alias("row")
    names = [f"key{i}" for i in range(len(order))]
    keys = [*(F.col(n).asc_nulls_first() for n in names), F.col("place")]
    placed = rows.select(
        kept, size.cast("long").alias("size"), *(F.col(c).alias(n) for c, n in zip(order, names)), F.monotonically_increasing_id().alias("place")
    )
    dealt = cut(placed.repartitionByRange(parts, *keys).withColumn("range", F.spark_partition_id()), "ranges")

    totals = dealt.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = totals.select(
        "range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(everything).alias("bytes_all"),
    )
    ordered = Window.partitionBy("range").orderBy(*keys)
    upto = F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sums = dealt.select("row", "size", "range", upto.alias("upto"), F.row_number().over(ordered).alias("nth"))
    middle = "2 * (bytes_before + upto) - size"
    numbered = cut(
        sums.join(starts, "range").select(
            "row", "size",
            F.expr(f"cast(least({shards} - 1, ({middle}) * {shards} div (2 * greatest(bytes_all, 1))) AS int)").alias("shard"),
            (F.col("rows_before") + F.col("nth") - 1).alias("nth"),
        ),
        "numbered",
    )
    firsts = numbered.groupBy("shard").agg(F.min("nth").alias("first"))  # a row per shard
    joined = numbered.join(F.broadcast(firsts), "shard")
    return joined.select("row.*", "size", "shard", (F.col("nth") - F.col("first")).alias("slot"))
