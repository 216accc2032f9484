"""Slowly changing dimensions and snapshot differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.keys import surrogate_key
from orderloom.operators.merge import upsert

VALIDITY = ["effective_from", "effective_to", "is_current"]


def _differs(left: str, right: str, columns: list[str]) -> Column:
    """NULL-safe: true if any of the columns changed."""
    tests = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(lambda a, b: a | b, tests)


def scd2_initial(snapshot: DataFrame, key: str, since: Column, sk: str = "dim_sk") -> DataFrame:
    """First load: every row is the current version."""
    dated = snapshot.withColumns(
        {
            "effective_from": since.cast("date"),
            "effective_to": F.lit(None).cast("date"),
            "is_current": F.lit(True),
        }
    )
    return dated.withColumn(sk, surrogate_key(F.col(key), F.col("effective_from")))


def scd2_merge(
    dim: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: list[str],
    as_of: Column,
    sk: str = "dim_sk",
    close_missing: bool = False,
) -> DataFrame:
    """Type 2: close changed versions at ``as_of`` and open new ones, validity ``[from, to)``.

    Past versions pass through; the current ones meet the snapshot in one full
    outer join, and a changed row becomes two. Running it again with the same
    snapshot changes nothing. ``close_missing`` ends keys absent from the snapshot.
    """
    day = as_of.cast("date")
    names = [c for c in dim.columns if c != sk]
    rows = [c for c in names if c not in VALIDITY]
    old, new = dim.filter("is_current").alias("o"), snapshot.alias("n")
    joined = old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full")
    known, seen = F.col(f"o.{key}").isNotNull(), F.col(f"n.{key}").isNotNull()
    changed = known & seen & _differs("o", "n", tracked)
    begun = F.col("o.effective_from")
    # An older snapshot than the open version would turn its validity round.
    early = F.raise_error(F.concat(F.lit("as_of lies before the open version of "), F.col(f"o.{key}").cast("string")))
    changed = F.when(changed & (begun > day), early.cast("boolean")).otherwise(changed)

    def version(side: str, begin: Column, end: Column, current: bool) -> Column:
        values = {
            "effective_from": begin.cast("date"),
            "effective_to": end.cast("date"),
            "is_current": F.lit(current),
        }
        return F.struct(
            *[values.get(c, F.col(f"{side}.{c}") if c in rows else None).alias(c) for c in names]
        )

    never = F.lit(None).cast("date")
    kept = version("o", F.col("o.effective_from"), never, True)
    closed = version("o", F.col("o.effective_from"), day, False)
    opened = version("n", day, never, True)
    gone = F.array(closed) if close_missing else F.array(kept)
    versions = (
        F.when(changed & (begun == day), F.array(opened))  # a second change on one day: in place
        .when(changed, F.array(closed, opened))
        .when(known & seen, F.array(kept))
        .when(known, gone)
        .otherwise(F.array(opened))
    )
    merged = joined.select(F.explode(versions).alias("v")).select("v.*")
    past = dim.filter("NOT is_current").select(*names)
    return past.unionByName(merged).withColumn(sk, surrogate_key(F.col(key), F.col("effective_from")))


def scd1_merge(dim: DataFrame, snapshot: DataFrame, key: str) -> DataFrame:
    """Type 1: overwrite."""
    return upsert(dim, snapshot, [key])


def scd3_merge(dim: DataFrame, snapshot: DataFrame, key: str, column: str, as_of: Column) -> DataFrame:
    """Type 3: keep the value before the last change in ``previous_x``, dated ``x_changed_on``."""
    old, new = dim.alias("o"), snapshot.select(key, column).alias("n")
    joined = old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "left")
    changed = F.col(f"n.{key}").isNotNull() & _differs("o", "n", [column])
    values = {
        column: F.when(changed, F.col(f"n.{column}")).otherwise(F.col(f"o.{column}")),
        f"previous_{column}": F.when(changed, F.col(f"o.{column}")).otherwise(F.col(f"o.previous_{column}")),
        f"{column}_changed_on": F.when(changed, as_of.cast("date")).otherwise(F.col(f"o.{column}_changed_on")),
    }
    return joined.select(*[values.get(c, F.col(f"o.{c}")).alias(c) for c in dim.columns])


def diff(before: DataFrame, after: DataFrame, key: str, table: str) -> DataFrame:
    """Audit rows that lead from one snapshot to the next, with both images as JSON."""
    columns = [c for c in before.columns if c != key]
    old, new = before.alias("o"), after.select(*before.columns).alias("n")
    joined = old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full")
    action = (
        F.when(F.col(f"o.{key}").isNull(), "INSERT")
        .when(F.col(f"n.{key}").isNull(), "DELETE")
        .when(_differs("o", "n", columns), "UPDATE")
    )

    def image(side: str) -> Column:
        values = F.struct(*[F.col(f"{side}.{c}").alias(c) for c in before.columns])
        return F.when(F.col(f"{side}.{key}").isNotNull(), F.to_json(values, {"ignoreNullFields": "false"}))

    return joined.select(
        F.lit(table).alias("table_name"),
        F.coalesce(F.col(f"o.{key}"), F.col(f"n.{key}")).alias("record_id"),
        action.alias("action"),
        image("o").alias("old_values"),
        image("n").alias("new_values"),
    ).filter("action IS NOT NULL")


def apply_diff(before: DataFrame, audit: DataFrame, key: str) -> DataFrame:
    """Applies audit rows to the older snapshot; gives the newer one."""
    images = audit.select(
        F.col("record_id").alias(key), "action", F.from_json("new_values", before.schema).alias("_row")
    )
    kept = before.join(images, key, "left_anti")
    written = images.filter("action <> 'DELETE'").select("_row.*")
    return kept.unionByName(written)
