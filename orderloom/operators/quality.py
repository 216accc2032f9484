"""Data quality checks. A check gives one row; a report is the union of checks."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.keys import spelled_out


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column with its NULLs; the table is read once for all of them."""
    names = columns or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return wide.unpivot([], names, "column_name", "nulls")


def unaccepted(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows outside the list; NULL passes."""
    return df.filter(~F.col(column).isin(values))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent; parent keys are unique."""
    known = parent.select(F.col(parent_key).alias("_key"))
    return child.filter(F.col(child_key).isNotNull()).join(known, F.col(child_key) == F.col("_key"), "left_anti")


def check(check_id: str, description: str, issues: DataFrame, level: str = "FAIL") -> DataFrame:
    """``PASS`` when ``issues`` is empty, else ``level`` (``FAIL`` or ``WARN``)."""
    return check_count(check_id, description, issues.agg(F.count(F.lit(1)).alias("n")), level)


def check_count(check_id: str, description: str, counted: DataFrame, level: str = "FAIL") -> DataFrame:
    """Like ``check``, from a one-row frame holding the number of issues."""
    issues = F.coalesce(F.col(counted.columns[0]), F.lit(0)).cast("long")
    return counted.select(
        F.lit(check_id).alias("check_id"),
        F.lit(description).alias("description"),
        F.when(issues == 0, "PASS").otherwise(level).alias("result"),
        issues.alias("issue_count"),
    )


class Rule(NamedTuple):
    """A check of single rows: those that meet ``condition`` are issues."""

    check_id: str
    description: str
    condition: Column
    level: str = "FAIL"


class Reference(NamedTuple):
    """A check of a key: rows whose non-null ``child_key`` is no ``parent_key`` of ``parent`` are issues."""

    check_id: str
    description: str
    child_key: str
    parent: DataFrame
    parent_key: str
    level: str = "FAIL"


def table_checks(df: DataFrame, rules: list[Rule], reference: Reference | None = None) -> DataFrame:
    """One row per rule, and one for the reference, from a single pass over the table.

    With a reference the rows are counted per key first, which combines on the map side, so one busy key costs no
    more than others; then one row per key meets the parent's keys, which may repeat.
    """
    checks = [*rules, *([reference] if reference else [])]
    names = [f"_n{i}" for i in range(len(checks))]
    counts = [F.count_if(r.condition).alias(n) for r, n in zip(rules, names)]
    if reference is None:
        wide = df.agg(*counts)
    else:
        key = F.col(reference.child_key).alias("_child")
        per_key = df.groupBy(key).agg(*counts, F.count(F.lit(1)).alias("_rows"))
        known = reference.parent.groupBy(F.col(reference.parent_key).alias("_parent")).agg(F.lit(True).alias("_known"))
        met = per_key.join(known, F.col("_child") == F.col("_parent"), "left")
        lost = F.when(F.col("_child").isNotNull() & F.col("_known").isNull(), F.col("_rows"))
        wide = met.agg(*[F.sum(n).alias(n) for n in names[:-1]], F.sum(lost).alias(names[-1]))
    rows = []
    for entry, name in zip(checks, names):
        issues = F.coalesce(F.col(name), F.lit(0)).cast("long")
        result = F.when(issues == 0, "PASS").otherwise(entry.level)
        rows.append(F.struct(
            F.lit(entry.check_id).alias("check_id"), F.lit(entry.description).alias("description"),
            result.alias("result"), issues.alias("issue_count"),
        ))
    return wide.select(F.inline(F.array(*rows)))


def report(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def summary(results: DataFrame) -> DataFrame:
    """One row over all checks; warnings neither pass nor fail the whole."""
    failed = F.count_if(F.col("result") == "FAIL")
    return results.agg(
        F.count_if(F.col("result") == "PASS").alias("passed"),
        failed.alias("failed"),
        F.count_if(F.col("result") == "WARN").alias("warned"),
        F.when(failed == 0, "ALL CHECKS PASSED").otherwise("SOME CHECKS FAILED").alias("overall"),
    )


def row_checksums(*columns: Column) -> list[Column]:
    """Two 64-bit numbers per row; their sums identify a table whatever its row order."""
    digest = F.md5(spelled_out(*columns))
    return [F.conv(F.substring(digest, start, 16), 16, 10).cast("decimal(38,0)") for start in (1, 17)]


def fingerprint(df: DataFrame, name: str, columns: list[Column], latest: Column | None = None) -> DataFrame:
    """One row: table name, row count, two content checksums, latest time."""
    newest = F.max(latest) if latest is not None else F.lit(None)
    return df.agg(
        F.lit(name).alias("table_name"),
        F.count(F.lit(1)).alias("row_count"),
        *[F.sum(c).alias(n) for c, n in zip(row_checksums(*columns), ("checksum", "checksum_2"))],
        newest.cast("timestamp_ntz").alias("latest"),
    )


def reconcile(before: DataFrame, after: DataFrame) -> DataFrame:
    """Compares fingerprints by table name."""
    b, a = before.alias("b"), after.alias("a")
    same = reduce(
        lambda x, y: x & y,
        [F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}")) for c in ("row_count", "checksum", "checksum_2")],
    )
    return b.join(a, F.col("b.table_name") == F.col("a.table_name"), "full").select(
        F.coalesce("b.table_name", "a.table_name").alias("table_name"),
        F.col("b.row_count").alias("rows_before"),
        F.col("a.row_count").alias("rows_after"),
        same.alias("matches"),
    )


def violates_dependency(df: DataFrame, determinant: list[str], dependent: str) -> DataFrame:
    """Determinant values with more than one dependent value (NULL counts as a value).

    Smallest and largest value tell as much as counting distinct ones, and both
    combine on the map side.
    """
    low, high = F.min(dependent), F.max(dependent)
    some_null, all_null = F.bool_or(F.col(dependent).isNull()), F.bool_and(F.col(dependent).isNull())
    grouped = df.groupBy(*determinant).agg(
        (~low.eqNullSafe(high) | (some_null & ~all_null)).alias("_broken"),
        low.alias("lowest"),
        high.alias("highest"),
    )
    return grouped.filter("_broken").drop("_broken")


def multi_valued(df: DataFrame, column: str, delimiter: str = ",") -> DataFrame:
    """Rows whose cell holds several values."""
    return df.filter(F.col(column).contains(delimiter))


def split_values(df: DataFrame, column: str, delimiter: str = ",") -> DataFrame:
    """One row per value of a multi-valued cell."""
    literal = "\\Q" + delimiter + "\\E"
    return df.withColumn(column, F.explode(F.split(F.col(column), literal))).withColumn(column, F.trim(column))
