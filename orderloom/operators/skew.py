"""Keys that hold too many rows for one task.

A key is hot when it has more than ``HOT_ROWS`` rows. They are looked for first,
with a sketch of frequent key hashes that every task fills and a few tasks merge: the keys themselves are not
shuffled. Only keys that the sketch holds for hot are counted exactly. There are at most (all rows /
HOT_ROWS) of them however large the table is, so the list is small enough to
fetch and to broadcast. Mostly there are none, and then the plain plan is used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from orderloom.session import cut

HOT_ROWS = 5_000_000
#: Items a sketch keeps count of, and tasks that merge those of all tasks before the last one does.
TRACKED = 65_536
MERGERS = 64
#: Stands for hot keys that have not been looked for yet.
LOOK = "look"


def _may_be_hot(df: DataFrame, keys: list[str], hot_rows: int) -> list[int] | None:
    """Hashes of the keys that may have more than ``hot_rows`` rows; None where the sketch could miss one.

    The sketch's estimates are never below the true number, and it leaves out no item with more than 2 * 3.5 / size of all
    rows, where its size is at least TRACKED / 0.75.
    """
    hashed = df.select(F.xxhash64(*keys).alias("h"), F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("merger"))
    # Sketches cannot be combined where there are none: one row more, which may at most add a candidate.
    one = df.sparkSession.range(1).select(F.col("id").alias("h"), F.lit(0).alias("merger"))
    parts = hashed.unionByName(one).groupBy("merger").agg(F.expr(f"approx_top_k_accumulate(h, {TRACKED})").alias("s"), F.count("h").alias("n"))
    whole = parts.agg(F.sum("n").alias("n"), F.expr(f"approx_top_k_combine(s, {TRACKED})").alias("s"))
    items = F.filter(F.expr(f"approx_top_k_estimate(s, {TRACKED})"), lambda i: i["count"] > hot_rows)
    row = whole.select("n", items["item"].alias("hashes")).first()
    rows = row.n or 0
    if rows <= hot_rows:
        return []
    return list(row.hashes) if rows * 6 <= TRACKED * hot_rows else None


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The hot keys, with the number of shares of ``hot_rows`` each makes (``_shares``); None if there are none.

    Beyond the rows for which the sketch is sure (some 5 * 10^10 at the default) all keys are counted exactly.
    """
    hashes = _may_be_hot(df, keys, hot_rows)
    if hashes == []:
        return None
    near = df if hashes is None else df.filter(F.xxhash64(*keys).isin(hashes))
    counted = near.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > hot_rows)
    shares = F.ceil(F.col("_rows") / hot_rows).cast("int")
    found = counted.select(*keys, shares.alias("_shares")).collect()
    if not found:
        return None
    schema = StructType([*[df.schema[k] for k in keys], StructField("_shares", IntegerType())])
    return df.sparkSession.createDataFrame(found, schema)


def mark_hot(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``_shares`` of the row's key, NULL for the others. NULL keys match as well."""
    listed = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], "_shares")
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    return df.join(F.broadcast(listed), same, "left").drop(*[f"_hot_{k}" for k in keys])


def join_one_per_key(
    rows: DataFrame,
    one_per_key: DataFrame,
    keys: list[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None | str = LOOK,
) -> DataFrame:
    """Joins rows to a frame with one row per key, such as an aggregate of them; NULL keys meet each other.

    Spark splits a skewed shuffle only where both join inputs come straight from
    one, which an aggregate does not. So the rows of hot keys are written out and dealt to
    as many shares as they need by their place in the files, which equal rows do not share and a
    retried task repeats; their single partner is copied to each share.
    """
    if isinstance(hot, str):
        hot = hot_keys(rows, keys, hot_rows)
    named = {k: f"_right_{k}" for k in keys}
    same = [F.col(f"_rows.{k}").eqNullSafe(F.col(f"_one.{n}")) for k, n in named.items()]
    if hot is None:
        left, right = rows, one_per_key.withColumnsRenamed(named)
    else:
        marked = mark_hot(rows, hot, keys)
        split = cut(marked.filter("_shares IS NOT NULL"), "hot")
        share = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_shares")).cast("int")
        cold = marked.filter("_shares IS NULL").withColumn("_share", F.lit(0))
        left = cold.unionByName(split.withColumn("_share", share)).drop("_shares")
        copies = F.sequence(F.lit(0), F.coalesce("_shares", F.lit(1)) - 1)
        right = mark_hot(one_per_key, hot, keys).withColumn("_share_of", F.explode(copies)).drop("_shares").withColumnsRenamed(named)
        same.append(F.col("_rows._share") == F.col("_one._share_of"))
    joined = left.alias("_rows").join(right.alias("_one"), reduce(lambda a, b: a & b, same), how)
    return joined.drop(*named.values(), "_share", "_share_of")
