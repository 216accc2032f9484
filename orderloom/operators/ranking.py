"""Global positions and NTILE without gathering the table in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from orderloom.operators.skew import HOT_ROWS, join_one_per_key
from orderloom.operators.windows import numbered, running
from orderloom.session import cut

# monotonically_increasing_id keeps the partition above bit 33 and the row below.
ROW_BITS = 33
# Quantiles asked of a sketch, whose error is a quarter of their distance.
GRID = 512
# So many rows are sorted in one task; more are range-partitioned.
FEW = 200_000


def _sorted_cut(df: DataFrame, order: list[Column | str]) -> tuple[DataFrame, list[tuple[int, int]]]:
    """The rows range-partitioned and sorted, each with its ``_pos``; and rows per partition.

    Written out because the range bounds come from a sample: computed again after
    a lost executor they might differ. The counts are one row per partition.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = cut(ranged.withColumn("_pos", F.monotonically_increasing_id()), "sorted")
    sizes = stored.groupBy(F.shiftright("_pos", ROW_BITS).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    return stored, sorted((row.part, row.n) for row in sizes.collect())


def _placed(df: DataFrame, order: list[Column | str], name: str) -> tuple[DataFrame, int]:
    """The rows with their position, and how many there are."""
    stored, sizes = _sorted_cut(df, order)
    starts, seen = [], 0
    for part, rows in sizes:
        starts.append((part, seen))
        seen += rows
    offsets = df.sparkSession.createDataFrame(starts, "_part long, _start long")
    position = F.col("_start") + F.col("_pos").bitwiseAND((1 << ROW_BITS) - 1) + 1
    # One row per sorted partition, whatever the table holds.
    placed = stored.withColumn("_part", F.shiftright("_pos", ROW_BITS)).join(F.broadcast(offsets), "_part")
    return placed.select(*df.columns, position.alias(name)), seen


def with_position(df: DataFrame, order: list[Column | str], name: str = "position") -> DataFrame:
    """Adds the 1-based position in the total order (an un-keyed ROW_NUMBER)."""
    return _placed(df, order, name)[0]


def tile_at(position: Column, total: int, tiles: int) -> Column:
    """NTILE of a position: the first ``total % tiles`` tiles hold one row more."""
    small, larger = divmod(total, tiles)
    wide = larger * (small + 1)
    early = F.floor((position - 1) / (small + 1)) + 1
    late = F.floor((position - 1 - wide) / max(small, 1)) + 1 + larger
    return F.when(position <= wide, early).otherwise(late).cast("int")


def _at_or_after(order: list[tuple[str, bool]], values) -> Column:
    """Row comes at ``values`` or after it in the order; ``True`` marks descending. NULLs are first ascending, last descending."""
    (name, descending), rest = order[0], order[1:]
    column, value = F.col(name), F.lit(values[0])
    if values[0] is None:
        beyond = F.lit(False) if descending else column.isNotNull()
    elif descending:
        beyond = column.isNull() | (column < value)
    else:
        beyond = F.coalesce(column > value, F.lit(False))
    same = column.eqNullSafe(value)
    return beyond | (same & _at_or_after(rest, values[1:]) if rest else same)


def _sum(terms: list[Column]) -> Column:
    """Added up in halves: hundreds of terms in a row would nest too deep for the optimizer."""
    if len(terms) == 1:
        return terms[0]
    middle = len(terms) // 2
    return _sum(terms[:middle]) + _sum(terms[middle:])


def _grid(df: DataFrame, name: str) -> Column:
    """A mergeable sketch's quantiles of a column, NULL where there is no such sketch (texts)."""
    kind = df.schema[name].dataType
    if not isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType)):
        return F.lit(None).cast("int")
    # As text: five hundred literals take seconds to build one by one.
    parts = ", ".join(f"{i / GRID}D" for i in range(GRID + 1))
    return F.expr(f"percentile_approx(`{name.replace('`', '``')}`, array({parts}), {4 * GRID})")


def _around(grid: list, values: int, total: int, descending: bool, positions: list[int]) -> list:
    """Cut points on both sides of the positions, each pair about 1 % of the rows apart."""
    cuts = set()
    for position in positions:
        place = values - 1 - position if descending else position - (total - values)
        if 0 <= place < values:
            step = place * GRID // values
            cuts |= {grid[i] for i in (step - 2, step + 3) if 0 <= i <= GRID}
    return sorted(c for c in cuts if c == c)


def _bin(df: DataFrame, name: str, cuts: list) -> Column:
    """-1 for NULL, 2k + 1 for the k-th cut point itself, 2k for what lies below it."""
    value, kind = F.col(name), df.schema[name].dataType
    points = [F.lit(c).cast(kind) for c in cuts]
    steps = [test.cast("int") for p in points for test in (value > p, value >= p)]
    return F.when(value.isNull(), F.lit(-1)).otherwise(_sum([F.lit(0), *steps]))


def _rows_at(df: DataFrame, order: list[tuple[str, bool]], positions: list[int], total: int) -> list[tuple]:
    """The order values of the rows at these places of the sorted rows, of which there are ``total``."""
    columns = [F.col(c).desc() if down else F.col(c).asc() for c, down in order]
    chosen = df.select(*[c for c, _ in order])
    if total <= FEW:
        placed = chosen.withColumn("_pos", F.row_number().over(Window.orderBy(*columns)) - 1)
        return [tuple(row)[:-1] for row in placed.filter(F.col("_pos").isin(positions)).orderBy("_pos").collect()]
    stored, sizes = _sorted_cut(chosen, columns)
    wanted, seen, waiting = [], 0, sorted(positions)
    for part, rows in sizes:
        while waiting and waiting[0] < seen + rows:
            wanted.append((part << ROW_BITS) + waiting.pop(0) - seen)
        seen += rows
    return [tuple(row)[:-1] for row in stored.filter(F.col("_pos").isin(wanted)).orderBy("_pos").collect()]


def _openings(
    df: DataFrame, orders: list[list[tuple[str, bool]]], positions_of: list[Callable[[int], list[int]]]
) -> list[dict[int, tuple]]:
    """For each order the order values of the rows at some positions, which may depend on the number of rows.

    One pass sketches the leading columns, a second one counts exactly between cut points on both sides of
    the positions. Only the rows of the bins that hold a position are then sorted; a bin of equal values goes on
    with the next column in the same way. The sketch only decides how many rows that are, not which are found.
    """
    leads = [order[0][0] for order in orders]
    row = df.agg(F.count(F.lit(1)), *[F.count(n) for n in leads], *[_grid(df, n) for n in leads]).first()
    total, values, grids = row[0], row[1 : 1 + len(leads)], row[1 + len(leads) :]
    asked = [of(total) for of in positions_of]
    if not any(asked):
        return [{} for _ in orders]
    cuts = [
        _around(grid, n, total, order[0][1], positions) if grid else []
        for grid, n, order, positions in zip(grids, values, orders, asked)
    ]
    bins = [_bin(df, name, points) for name, points in zip(leads, cuts)]
    counted = df.select(F.posexplode(F.array(*bins)).alias("which", "bin")).groupBy("which", "bin").count().collect()
    found = []
    for which, (order, positions, points) in enumerate(zip(orders, asked, cuts)):
        sizes = sorted(((r.bin, r["count"]) for r in counted if r.which == which), reverse=order[0][1])
        places, seen = {}, 0
        for bin_, rows in sizes:
            inside = [p for p in positions if seen <= p < seen + rows]
            if inside:
                places[bin_] = (rows, {p: p - seen for p in inside})
            seen += rows
        found.append(_in_bins(df, order, bins[which], points, places))
    return found


def _in_bins(df: DataFrame, order: list[tuple[str, bool]], bin_of: Column, points: list, places: dict) -> dict[int, tuple]:
    found, together, before = {}, {}, 0
    few = sum(rows for rows, _ in places.values()) <= FEW
    for bin_, (rows, inside) in places.items():
        same = bin_ % 2 == 1  # NULL is -1
        value = points[bin_ // 2] if same and bin_ > 0 else None
        if same and len(order) == 1:
            found.update({p: (value,) for p in inside})
        elif same and not few:
            at = list(inside.values())
            rest = _openings(df.filter(bin_of == bin_), [order[1:]], [lambda _, at=at: at])[0]
            found.update({p: (value, *rest[i]) for p, i in inside.items()})
        else:
            together[bin_] = {p: before + i for p, i in inside.items()}
            before += rows
    if together:
        where = {p: i for inside in together.values() for p, i in inside.items()}
        chosen = df.filter(bin_of.isin(list(together)))
        found.update(zip(sorted(where), _rows_at(chosen, order, sorted(where.values()), before)))
    return found


def with_ntiles(df: DataFrame, tiled: dict[str, tuple[list[tuple[str, bool]], int]]) -> DataFrame:
    """Adds several NTILEs, ``name -> (order, tiles)``, each over a total order; ``True`` marks descending.

    NULLs are first ascending, last descending. The rows that open a tile are found by refining quantiles
    (``_openings``) and become constants, so no column is sorted as a whole and the rows are not joined. ``df`` is read
    a few times: give it as a stored table.
    """

    def opening(tiles: int) -> Callable[[int], list[int]]:
        def positions(total: int) -> list[int]:
            small, larger = divmod(total, tiles)
            return [p for tile in range(1, tiles) if (p := tile * small + min(tile, larger)) < total]

        return positions

    orders = [order for order, _ in tiled.values()]
    found = _openings(df, orders, [opening(tiles) for _, tiles in tiled.values()])
    columns = {}
    for name, order, rows in zip(tiled, orders, found):
        passed = [_at_or_after(order, rows[p]).cast("int") for p in sorted(rows)]
        columns[name] = _sum([F.lit(1), *passed])
    return df.withColumns(columns)


def with_ntile(df: DataFrame, order: list[tuple[str, bool]], tiles: int, name: str) -> DataFrame:
    """One NTILE; see ``with_ntiles``."""
    return with_ntiles(df, {name: (order, tiles)})


def with_ranks(
    df: DataFrame,
    value: str,
    tie: str,
    descending: bool = True,
    row_number: str = "row_number",
    rank: str = "rank",
    dense_rank: str = "dense_rank",
    tiles: dict[str, int] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Adds ROW_NUMBER, RANK, DENSE_RANK and NTILEs (``name -> tiles``) over the whole table.

    Only the distinct values are sorted as a whole, each with its number of rows: running sums over them
    are the rank and the dense rank. The row number is the rank and the place among the rows with the same value, in order of
    ``tie``. So the rows are shuffled once, by value, where the value's row comes first and hands on what it knows.
    The rows of a value that more than ``hot_rows`` share are split. NULLs are first ascending, last descending.
    """
    by = F.col(value).desc() if descending else F.col(value).asc()
    counted = df.groupBy(value).agg(F.count(F.lit(1)).alias("_rows"))
    upto = running(counted, [], [by], {"_upto": F.col("_rows"), "_dense": F.lit(1)})
    ranks = upto.select(value, "_rows", (F.col("_upto") - F.col("_rows") + 1).alias("_rank"), "_dense")
    values = cut(ranks, "values")
    total, most = values.agg(F.sum("_rows"), F.max("_rows")).first()
    if (most or 0) > hot_rows:
        hot = values.filter(F.col("_rows") > hot_rows).select(value, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_shares"))
        inside = numbered(df, [value], [tie], "_place", hot_rows=hot_rows, hot=hot)
        ranked = join_one_per_key(inside, values, [value], hot_rows=hot_rows, hot=hot)
    else:
        both = df.withColumn("_is_row", F.lit(True)).unionByName(values.withColumn("_is_row", F.lit(False)), allowMissingColumns=True)
        window = Window.partitionBy(value).orderBy("_is_row", tie)
        known = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        told = {n: F.first(n).over(known) for n in ("_rank", "_dense")}
        ranked = both.withColumns({"_place": F.row_number().over(window) - 1, **told}).filter("_is_row")
    number = F.col("_rank") + F.col("_place") - 1
    tiled = [tile_at(number, total or 0, k).alias(n) for n, k in (tiles or {}).items()]
    return ranked.select(*df.columns, number.alias(row_number), F.col("_rank").alias(rank), F.col("_dense").alias(dense_rank), *tiled)


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int, name: str = "rn") -> DataFrame:
    """The first ``k`` rows of each key.

    Up to Spark's threshold it prunes to ``k`` rows per key on the map side by itself, so a hot
    key sends at most ``k`` rows from each task. Beyond, each input partition is first reduced to
    ``k`` rows per key by a window of its own.
    """
    pruned = df
    if k >= int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        place = F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(*order))
        sliced = df.withColumn("_slice", F.spark_partition_id()).withColumn("_place", place)
        pruned = sliced.filter(F.col("_place") <= k).drop("_slice", "_place")
    ranked = pruned.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(name) <= k)
