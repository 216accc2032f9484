"""Upserts, archive splits and rewrites; each returns the new table, nothing changes in place."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, MapType, StructField, StructType

from orderloom.operators.skew import HOT_ROWS, hot_keys, join_one_per_key, mark_hot
from orderloom.operators.windows import running
from orderloom.session import cut


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key. An aggregate, so a hot key is thinned out before the shuffle."""
    row = F.struct(*df.columns)
    return df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_row")).select("_row.*")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: list[str] | None = None,
    latest_by: list[str] | None = None,
) -> DataFrame:
    """Insert new keys, overwrite the ``update`` columns of known ones.

    ``update`` defaults to all non-key columns; an empty list makes it an
    insert-if-absent. Columns the source lacks keep their old value or are NULL.
    ``latest_by`` first reduces the source to the last row per key, and where the target has those
    columns a stored row that is later stays as it is; without it the source must be unique. Keys must not be NULL.
    """
    if latest_by:
        source = latest_per_key(source, keys, latest_by)
    given = set(source.columns)
    changed = set(given if update is None else update) - set(keys)
    new = source.select(*source.columns, F.lit(True).alias("_new")).alias("s")
    old = target.select(*target.columns, F.lit(True).alias("_old")).alias("t")
    on = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    wins = F.col("s._new")
    if latest_by and set(latest_by) <= set(target.columns):
        stored, arrived = (F.struct(*[F.col(f"{side}.{c}") for c in latest_by]) for side in "ts")
        wins = wins & (F.col("t._old").isNull() | (arrived >= stored))
    columns = []
    for name in target.columns:
        kind = target.schema[name].dataType
        if name in keys:
            value = F.coalesce(F.col(f"t.{name}"), F.col(f"s.{name}"))
        elif name not in given:
            value = F.col(f"t.{name}")
        elif name in changed:
            value = F.when(wins, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}"))
        else:
            value = F.when(F.col("t._old"), F.col(f"t.{name}")).otherwise(F.col(f"s.{name}"))
        columns.append(value.cast(kind).alias(name))
    return old.join(new, on, "full").select(*columns)


def additive_upsert(target: DataFrame, source: DataFrame, keys: list[str], amounts: list[str]) -> DataFrame:
    """Add the source's amounts to the target's; one aggregate over both."""
    both = target.select(*keys, *amounts).unionByName(source.select(*keys, *amounts))
    return both.groupBy(*keys).agg(
        *[F.sum(a).cast(target.schema[a].dataType).alias(a) for a in amounts]
    )


def insert_absent(
    target: DataFrame, source: DataFrame, keys: list[str], latest_by: list[str] | None = None
) -> DataFrame:
    """Append the source rows whose key the target lacks, one per key: the last by ``latest_by``, else the greatest."""
    others = [f.name for f in source.schema if f.name not in keys and not isinstance(f.dataType, MapType)]
    source = latest_per_key(source, keys, latest_by or others or keys)
    return target.unionByName(source.join(target, keys, "left_anti").select(*target.columns))


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """``UPDATE .. SET .. WHERE``: a rewrite in one pass; a NULL condition changes nothing."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns(
        {n: F.when(hit, v).otherwise(F.col(n)).cast(df.schema[n].dataType) for n, v in values.items()}
    )


def soft_delete(df: DataFrame, condition: Column, at: Column, column: str = "deleted_at") -> DataFrame:
    """Marks rows deleted; rows already deleted keep their time, so repeating changes nothing."""
    return update_where(df, condition & F.col(column).isNull(), {column: at})


def restore(df: DataFrame, condition: Column, column: str = "deleted_at") -> DataFrame:
    return update_where(df, condition, {column: F.lit(None)})


def split_where(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(rows to keep, rows to archive); every row is in exactly one, NULL conditions are kept."""
    hit = F.coalesce(condition, F.lit(False))
    return df.filter(~hit), df.filter(hit)


def _decrement_in_turn(
    stock: DataFrame, requests: DataFrame, keys: list[str], available: str, wanted: str, order: list[str]
) -> DataFrame:
    """``accepted`` per request, in one pass over the sorted requests of keys that fit a task.

    ``_odd`` marks requests for which ``guarded_decrement`` says nothing: stock or places in the order that repeat, negative amounts.
    """
    per_key = stock.groupBy(*keys).agg(F.min(F.col(available).cast("long")).alias("_left"), F.count(F.lit(1)).alias("_copies"))
    met = join_one_per_key(requests, per_key.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])), keys, "left", hot=None)
    turn, place = Window.partitionBy(*keys).orderBy(*order), F.struct(*order)
    again = F.coalesce(F.lag(place).over(turn).eqNullSafe(place) & (F.row_number().over(turn) > 1), F.lit(False))
    odd = again | F.coalesce((F.col("_copies") > 1) | (F.col(wanted) < 0), F.lit(False))
    turns = met.select(
        *requests.columns, odd.alias("_odd"), (F.row_number().over(turn) == 1).cast("int").alias("_opens"),
        # Without stock nothing fits, and neither does a request for nothing known.
        F.coalesce("_left", F.lit(-1)).alias("_left"), F.coalesce(F.col(wanted).cast("long"), F.lit(2**63 - 1)).alias("_want"),
    ).sortWithinPartitions(*keys, *order)

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Requests key after key; what is left goes from batch to batch. Local, so that workers need not import this module."""
        left = -1
        for batch in batches:
            accepted = []
            for opens, held, want in zip(*(batch.column(c).to_numpy().tolist() for c in ("_opens", "_left", "_want"))):
                if opens:
                    left = held
                fits = want <= left
                if fits:
                    left -= want
                accepted.append(fits)
            yield batch.drop_columns(["_opens", "_left", "_want"]).append_column("accepted", pa.array(accepted, pa.bool_()))

    flags = [StructField(n, BooleanType()) for n in ("_odd", "accepted")]
    return turns.mapInArrow(taken, StructType([*requests.schema.fields, *flags]))


def guarded_decrement(
    stock: DataFrame,
    requests: DataFrame,
    keys: list[str],
    available: str,
    wanted: str,
    order: list[str],
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Requests taken in ``order``, each from what the earlier ones left: (``accepted`` per request, new stock).

    A request for more than is left is refused and takes nothing; later, smaller ones may still be accepted. The requests of
    a key are taken one by one where they are sorted; those of hot keys (see ``skew``) in rounds over all of them. With at least 2**c left, requests of at most 2**(c-1) are *small*: they are all accepted until they bring the
    stock below 2**c, so one running sum settles them, and tells of each larger one whether it fits. The first one that fits,
    or the small one that crosses 2**c, ends the round: what stands before is settled, what stands behind goes on. Each
    third round at the latest the class c falls, so the rounds are bounded by the logarithm of the largest stock, however many
    requests a key has. ``available`` and ``wanted`` are whole numbers, wanted at least 0; NULL ones, and requests for
    a key without stock, are refused. ``order`` tells the requests of a key apart.
    """
    columns = requests.columns
    named = [F.col(k).alias(f"_s_{k}") for k in keys]
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_s_{k}") for k in keys])
    requests = cut(requests, "asked")
    hot = hot_keys(requests, keys, hot_rows)
    marked = requests.withColumn("_shares", F.lit(None).cast("int")) if hot is None else mark_hot(requests, hot, keys)
    in_turn = cut(_decrement_in_turn(stock, marked.filter("_shares IS NULL").drop("_shares"), keys, available, wanted, order), "in-turn")
    rest, settled = marked.filter("_shares IS NOT NULL").drop("_shares"), [in_turn.drop("_odd")]
    odd = in_turn.filter("_odd").select(*named).distinct()
    if not odd.isEmpty():
        at_odd = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys])
        settled = [in_turn.join(odd, at_odd, "left_anti").drop("_odd")]
        rest = cut(rest.unionByName(in_turn.join(odd, at_odd, "left_semi").select(*columns)), "asked")
    elif hot is None:
        rest = None
    if rest is not None:
        settled += _decrement_in_rounds(stock, rest, keys, available, wanted, order, hot_rows)
    answered = cut(reduce(DataFrame.unionByName, settled), "answered") if rest is not None else settled[0]
    sums = answered.filter("accepted").groupBy(*keys).agg(F.sum(wanted).alias("_gone"))
    joined = stock.join(sums.select(*named, "_gone"), same, "left")
    after = F.coalesce(F.col(available) - F.col("_gone"), F.col(available)).cast(stock.schema[available].dataType)
    return answered, joined.select(*[after.alias(c) if c == available else F.col(c) for c in stock.columns])


def _decrement_in_rounds(
    stock: DataFrame, rest: DataFrame, keys: list[str], available: str, wanted: str, order: list[str], hot_rows: int
) -> list[DataFrame]:
    """The verdicts of ``guarded_decrement``, round by round."""
    columns, settled = rest.columns, []
    asked = rest.groupBy(*keys).agg(F.lit(1).alias("_any")).select(*keys)
    left = asked.join(stock.select(*keys, F.col(available).cast("long").alias("_left")), keys)
    left = cut(left, "stock")
    while True:
        met = join_one_per_key(rest, left, keys, "left", hot_rows)
        fits = F.coalesce(F.col(wanted) <= F.col("_left"), F.lit(False))
        settled.append(met.filter(~fits).select(*columns, F.lit(False).alias("accepted")))
        # The highest power of two in what is left: 2**c; 0 with nothing left, where requests for 0 are all small.
        power = F.expr("IF(_left > 0, shiftleft(1L, length(bin(_left)) - 1), 0L)")
        small = F.col(wanted) <= F.floor(power / 2)
        open_ones = met.filter(fits).withColumns({"_power": power, "_small": small})
        taken = {"_taken": F.when(F.col("_small"), F.col(wanted)).otherwise(0)}
        swept = cut(running(open_ones, keys, order, taken, hot_rows), "admission")
        crosses = F.col("_small") & (F.col("_left") - F.col("_taken") < F.col("_power"))
        enters = ~F.col("_small") & (F.col(wanted) <= F.col("_left") - F.col("_taken"))
        ends = swept.filter(crosses | enters).groupBy(*keys).agg(
            F.min_by(
                F.struct(*[F.col(o) for o in order], (F.col("_taken") + F.when(F.col("_small"), 0).otherwise(F.col(wanted))).alias("_gone")),
                F.struct(*order),
            ).alias("_end")
        )
        judged = join_one_per_key(swept, ends, keys, "left", hot_rows)
        place, end = F.struct(*order), F.struct(*[F.col(f"_end.{o}").alias(o) for o in order])
        before = F.col("_end").isNull() | (place <= end)
        verdict = F.when(before, F.col("_small") | (F.col("_end").isNotNull() & (place == end)))
        judged = cut(judged.select(*columns, verdict.alias("accepted")), "admission")
        settled.append(judged.filter("accepted IS NOT NULL"))
        rest = judged.filter("accepted IS NULL").select(*columns)
        gone = ends.select(*keys, F.col("_end._gone").alias("_gone"))
        if rest.isEmpty():
            return settled
        left = cut(left.join(gone, keys).select(*keys, (F.col("_left") - F.col("_gone")).alias("_left")), "stock")


def transition(
    requests: DataFrame,
    state: DataFrame,
    key: str,
    status: str,
    expected: str,
    to: str,
    order: list[str],
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Status changes taken in ``order``: (verdict per request, new state).

    The first request for a row in ``expected`` is ``OK`` and moves it; a later one meets the row in ``to``, and so
    gets ``INVALID_STATUS:`` with that name, like any request for a row in another status. ``NOT_FOUND`` if there is no row or no key. A row of
    NULL status is in no status. ``order`` tells the requests of a key apart.
    """
    now = state.filter(F.col(key).isNotNull()).select(F.col(key), F.col(status).alias("_now"), F.lit(True).alias("_found"))
    opening = requests.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*order)).alias("_first"))
    met = join_one_per_key(requests, opening.join(now, key), [key], "left", hot_rows)
    moves = F.coalesce(F.col("_now") == expected, F.lit(False))
    is_first = F.struct(*order) == F.struct(*[F.col(f"_first.{o}").alias(o) for o in order])
    verdict = (
        F.when(F.col("_found").isNull(), "NOT_FOUND")
        .when(moves & (is_first | F.lit(expected == to)), "OK")
        .otherwise(F.concat(F.lit("INVALID_STATUS:"), F.when(moves, F.lit(to)).otherwise(F.coalesce("_now", F.lit("NULL")))))
    )
    answered = met.select(*requests.columns, verdict.alias("verdict"))
    asked = requests.select(key).distinct().withColumn("_asked", F.lit(True))
    moved = state.join(asked, key, "left")
    updated = update_where(moved, F.col("_asked") & (F.col(status) == expected), {status: F.lit(to)})
    return answered, updated.select(*state.columns)


def evolve(
    df: DataFrame,
    add: dict[str, tuple[str, Column]] | None = None,
    rename: dict[str, str] | None = None,
    cast: dict[str, str] | None = None,
    drop: list[str] | None = None,
) -> DataFrame:
    """Schema change as a rewrite: renames, type changes, new columns with a default, drops."""
    out = df.withColumnsRenamed(rename or {})
    out = out.withColumns({n: F.col(n).cast(t) for n, t in (cast or {}).items()})
    out = out.withColumns({n: v.cast(t) for n, (t, v) in (add or {}).items()})
    return out.drop(*(drop or []))


def align(incoming: DataFrame, target: DataFrame, policy: str = "append_new_columns") -> tuple[DataFrame, DataFrame]:
    """Brings both frames to one set of columns, or fails if ``policy`` is ``fail``."""
    extra = [f for f in incoming.schema if f.name not in target.columns]
    if extra and policy == "fail":
        raise ValueError(f"columns not in the target: {[f.name for f in extra]}")
    wide = target.withColumns({f.name: F.lit(None).cast(f.dataType) for f in extra})
    missing = [f for f in wide.schema if f.name not in incoming.columns]
    full = incoming.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    return full.select(*wide.columns), wide
