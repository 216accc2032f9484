"""Window calculations that do not need a whole key in one task.

A plain window moves every row of a key to one task, and an un-keyed one moves the
whole table there. Here the rows of a hot key (see ``skew``) are range-partitioned along the order
and written once; each partition is a block of about equal size, rows that tie on the order stay together.
Blocks are summed up, a small aggregate with map-side combining; what the earlier blocks of a key add up to
then enters each block as one extra leading row, and the window itself runs per
(key, block). Where no key is hot, the plain window is used. NULLs, in keys or in the order, are
values like others, first in ascending order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.operators.skew import HOT_ROWS, LOOK, hot_keys, join_one_per_key, mark_hot
from orderloom.session import cut

LEAD, ROW = 0, 1
#: The block of keys that are not split.
WHOLE = -1


def _blocked(
    df: DataFrame, keys: list[str], order: list[str], hot_rows: int, hot: DataFrame | None | str
) -> DataFrame | None:
    """Adds ``_block`` and ``_kind``; None if no key is split. Without keys all rows are."""
    if not keys:
        ranged = cut(df.repartitionByRange(*order).withColumn("_block", F.spark_partition_id()), "blocks")
        return ranged.withColumn("_kind", F.lit(ROW))
    if isinstance(hot, str):
        hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return None
    shares = hot.agg(F.sum("_shares")).first()[0]
    marked = mark_hot(df, hot, keys)
    split = marked.filter("_shares IS NOT NULL").drop("_shares").repartitionByRange(shares, *keys, *order)
    blocks = cut(split.withColumn("_block", F.spark_partition_id()), "blocks")
    whole = marked.filter("_shares IS NULL").drop("_shares").withColumn("_block", F.lit(WHOLE))
    return whole.unionByName(blocks).withColumn("_kind", F.lit(ROW))


def _split_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("_block") > WHOLE)


def _earlier(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)


def _with_lead(rows: DataFrame, carry: DataFrame) -> DataFrame:
    return rows.unionByName(carry.withColumn("_kind", F.lit(LEAD)), allowMissingColumns=True)


def _without_lead(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_kind") == ROW).drop("_kind")


def _within_block(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys, "_block").orderBy("_kind", *order)


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    sums: dict[str, Column],
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None | str = LOOK,
) -> DataFrame:
    """Adds running sums ``name -> value`` along ``order`` within ``keys``, up to the current row."""
    valued = df.select("*", *[v.alias(f"_v_{n}") for n, v in sums.items()])

    def summed(rows: DataFrame, window, *extra: str) -> DataFrame:
        frame = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return rows.select(*df.columns, *extra, *[F.sum(f"_v_{n}").over(frame).alias(n) for n in sums])

    rows = _blocked(valued, keys, order, hot_rows, hot)
    if rows is None:
        return summed(valued, Window.partitionBy(*keys).orderBy(*order))
    totals = _split_rows(rows).groupBy(*keys, "_block").agg(*[F.sum(f"_v_{n}").alias(f"_v_{n}") for n in sums])
    carry = totals.select(*keys, "_block", *[F.sum(f"_v_{n}").over(_earlier(keys)).alias(f"_v_{n}") for n in sums])
    return _without_lead(summed(_with_lead(rows, carry), _within_block(keys, order), "_kind"))


def running_with_peers(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    sums: dict[str, Column],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Like ``running`` with SQL's default frame: rows tied on ``order`` share their sum.

    Ties are added up first, so the window only sees one row per value.
    """
    per_value = df.groupBy(*keys, *order).agg(*[F.sum(v).alias(f"_t_{n}") for n, v in sums.items()])
    summed = running(per_value, keys, order, {n: F.col(f"_t_{n}") for n in sums}, hot_rows)
    return join_one_per_key(df, summed.select(*keys, *order, *sums), [*keys, *order], hot_rows=hot_rows)


def numbered(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    row_number: str | None = None,
    rank: str | None = None,
    dense_rank: str | None = None,
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None | str = LOOK,
) -> DataFrame:
    """Adds ROW_NUMBER, RANK and DENSE_RANK along ascending ``order`` within ``keys``."""

    def ranked(rows: DataFrame, window, rows_before: Column, values_before: Column, *extra: str) -> DataFrame:
        wanted = {
            row_number: rows_before + F.row_number().over(window),
            rank: rows_before + F.rank().over(window),
            dense_rank: values_before + F.dense_rank().over(window),
        }
        return rows.select(*df.columns, *extra, *[c.cast("long").alias(n) for n, c in wanted.items() if n])

    rows = _blocked(df, keys, order, hot_rows, hot)
    if rows is None:
        return ranked(df, Window.partitionBy(*keys).orderBy(*order), F.lit(0), F.lit(0))
    values = _split_rows(rows).groupBy(*keys, "_block", *order).agg(F.count(F.lit(1)).alias("_n"))
    totals = values.groupBy(*keys, "_block").agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_d"))
    before = _earlier(keys)
    # The leading row takes a number of its own in the block, hence the -1.
    carry = totals.select(
        *keys,
        "_block",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - 1).alias("_n"),
        (F.coalesce(F.sum("_d").over(before), F.lit(0)) - 1).alias("_d"),
    )
    window = _within_block(keys, order)
    opening = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows_before = F.coalesce(F.first("_n").over(opening), F.lit(0))
    values_before = F.coalesce(F.first("_d").over(opening), F.lit(0))
    return _without_lead(ranked(_with_lead(rows, carry), window, rows_before, values_before, "_kind"))


def previous(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: dict[str, str],
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None | str = LOOK,
) -> DataFrame:
    """Adds the values of the row before (LAG 1): ``column -> output name``.

    ``order`` must be unique within a key.
    """
    packed = df.withColumn("_now", F.struct(*[F.col(c) for c in columns]))

    def lagged(rows: DataFrame, window, *extra: str) -> DataFrame:
        return rows.select(*df.columns, *extra, F.lag("_now").over(window).alias("_row_before"))

    rows = _blocked(packed, keys, order, hot_rows, hot)
    if rows is None:
        found = lagged(packed, Window.partitionBy(*keys).orderBy(*order))
    else:
        totals = _split_rows(rows).groupBy(*keys, "_block").agg(F.max_by("_now", F.struct(*order)).alias("_now"))
        last = F.lag("_now").over(Window.partitionBy(*keys).orderBy("_block")).alias("_now")
        carry = totals.select(*keys, "_block", last)
        found = _without_lead(lagged(_with_lead(rows, carry), _within_block(keys, order), "_kind"))
    return found.select(*df.columns, *[F.col(f"_row_before.{c}").alias(out) for c, out in columns.items()])


def sliding(
    df: DataFrame,
    keys: list[str],
    at: str,
    seconds: int,
    aggregates: dict[str, Column],
    block_seconds: int | None = None,
) -> DataFrame:
    """Adds aggregates over the rows of the last ``seconds`` up to each row, ties included.

    Rows are cut into blocks of time; the tail of a block is copied into the next
    one, so that a block sees all it looks back on. ``aggregates`` are plain
    aggregate columns such as ``F.sum("x")``.
    """
    span = max(seconds, block_seconds or 2 * seconds)
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    block = F.floor(micros / (span * 1_000_000))
    closes = (block + 1) * (span * 1_000_000)
    own = df.withColumn("_at", micros).withColumn("_own", block)
    reach = F.when(closes - F.col("_at") <= seconds * 1_000_000, F.array("_own", F.col("_own") + 1))
    rows = own.withColumn("_block", F.explode(reach.otherwise(F.array("_own"))))
    window = (
        Window.partitionBy(*keys, "_block")
        .orderBy("_at")
        .rangeBetween(-seconds * 1_000_000, Window.currentRow)
    )
    seen = rows.select(*df.columns, "_own", "_block", *[a.over(window).alias(n) for n, a in aggregates.items()])
    return seen.filter(F.col("_own").eqNullSafe(F.col("_block"))).drop("_own", "_block")


def _sums_in_blocks(df: DataFrame, keys: list[str], at: str, seconds: int, sums: dict[str, Column]) -> DataFrame:
    """``sliding_sums`` of series that fit a task, in time that grows with the rows and not with the rows in a range.

    Time is cut into blocks as long as a range. The range up to a moment is the start of its own block up to there and the
    end of the block before, so two running sums per block, one from each side, give every range; nothing is subtracted.
    """
    width = seconds * 1_000_000 + 1
    timed = df.withColumn("_t", F.unix_micros(F.col(at).cast("timestamp")))
    values = [f"_v{i}" for i in range(len(sums))]
    moments = timed.groupBy(*keys, "_t").agg(*[F.sum(v).alias(n) for n, v in zip(values, sums.values())])
    block = F.expr(f"(_t - pmod(_t, {width}L)) div {width}L")
    # Each moment enters its block, and asks the block before for what lies in its range.
    enters = F.struct(block.alias("_block"), F.col("_t").alias("_place"), F.lit(False).alias("_asks"))
    asks = F.struct((block - 1).alias("_block"), (F.col("_t") - (width - 1)).alias("_place"), F.lit(True).alias("_asks"))
    timeless = F.col("_t").isNull()
    places = moments.withColumn("_at", F.explode(F.when(timeless, F.array(enters)).otherwise(F.array(enters, asks))))
    placed = places.select(*keys, "_t", "_at.*", *[F.when(~F.col("_at._asks"), F.col(n)).alias(n) for n in values])
    blocks = Window.partitionBy(*keys, "_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward, back = blocks.orderBy("_place", "_asks"), blocks.orderBy(F.desc("_place"), "_asks")
    parts = placed.select(
        *keys, "_t", *[F.when(F.col("_asks"), F.sum(n).over(back)).otherwise(F.sum(n).over(onward)).alias(n) for n in values]
    )
    kinds = df.select(*[F.sum(v).alias(n) for n, v in zip(values, sums.values())]).schema
    whole = [F.sum(n).cast(kinds[n].dataType).alias(name) for n, name in zip(values, sums)]
    totals = parts.groupBy(*keys, "_t").agg(*whole)
    return join_one_per_key(timed, totals, [*keys, "_t"], hot=None).select(*df.columns, *sums)


def sliding_sums(
    df: DataFrame,
    keys: list[str],
    at: str,
    seconds: int,
    sums: dict[str, Column],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Adds sums ``name -> value`` over the last ``seconds`` up to each row, ties included; NULL where all values are.

    Most series take sums in blocks of time. In one with more than ``hot_rows`` rows a block alone may be more than a task
    holds, so there each value enters at its time and leaves just after its range, changes of one moment are
    added up first, and the sum is a running one, which splits the series into blocks. Whole numbers and
    decimals come out the same either way; doubles up to rounding. Rows without a time see each other only.
    """
    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return _sums_in_blocks(df, keys, at, seconds, sums)
    marked = mark_hot(df, hot, keys)
    cold = _sums_in_blocks(marked.filter("_shares IS NULL").drop("_shares"), keys, at, seconds, sums)
    busy = marked.filter("_shares IS NOT NULL").drop("_shares").withColumn("_t", F.unix_micros(F.col(at).cast("timestamp")))
    amounts = {f"_v{i}": v for i, v in enumerate(sums.values())}
    parts = {f"_c{i}": v.isNotNull().cast("long") for i, v in enumerate(sums.values())}
    entering = busy.select(*keys, "_t", *[c.alias(n) for n, c in {**amounts, **parts}.items()])
    leaving = entering.select(*keys, (F.col("_t") + seconds * 1_000_000 + 1).alias("_t"), *[(-F.col(n)).alias(n) for n in [*amounts, *parts]])
    moments = entering.unionByName(leaving.filter("_t IS NOT NULL")).groupBy(*keys, "_t").agg(*[F.sum(n).alias(n) for n in [*amounts, *parts]])
    swept = running(moments.filter("_t IS NOT NULL"), keys, ["_t"], {f"{n}_sum": F.coalesce(n, F.lit(0)) for n in [*amounts, *parts]}, hot_rows)
    timeless = moments.filter("_t IS NULL").select("*", *[F.col(n).alias(f"{n}_sum") for n in [*amounts, *parts]])
    values = [F.when(F.col(f"_c{i}_sum") > 0, F.col(f"_v{i}_sum")).alias(n) for i, n in enumerate(sums)]
    totals = swept.unionByName(timeless).select(*keys, "_t", *values)
    split = join_one_per_key(busy, totals, [*keys, "_t"], hot_rows=hot_rows).select(*df.columns, *sums)
    same = [F.col(n).cast(split.schema[n].dataType).alias(n) if n in sums else F.col(n) for n in cold.columns]
    return cold.select(*same).unionByName(split)


def with_total(
    df: DataFrame,
    keys: list[str],
    totals: dict[str, Column],
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None | str = LOOK,
) -> DataFrame:
    """Adds per-key aggregates to every row: aggregate first, then one join back.

    The aggregate combines on the map side and the join splits hot keys, neither
    of which a window over the key does.
    """
    per_key = df.groupBy(*keys).agg(*[c.alias(n) for n, c in totals.items()])
    return join_one_per_key(df, per_key, keys, hot_rows=hot_rows, hot=hot)
