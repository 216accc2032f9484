"""Sets of numbers written as ranges, and what one set lacks of another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators.skew import HOT_ROWS, hot_keys
from orderloom.operators.windows import previous, running
from orderloom.session import cut


def parse_ranges(df: DataFrame, column: str) -> DataFrame:
    """(source, low, high) rows from texts such as ``uuid:1-5:7,uuid2:1-3``."""
    parts = df.select(F.explode(F.split(F.regexp_replace(column, r"\s+", ""), ",")).alias("_set"))
    pieces = parts.withColumn("_fields", F.split("_set", ":"))
    ranges = pieces.select(
        F.lower(F.col("_fields")[0]).alias("source"),
        F.explode(F.slice("_fields", 2, F.size("_fields"))).alias("_range"),
    )
    ends = F.split("_range", "-")
    return ranges.select(
        "source",
        ends[0].cast("long").alias("low"),
        F.coalesce(F.try_element_at(ends, F.lit(2)), ends[0]).cast("long").alias("high"),
    )


def _ends(ranges: DataFrame, keys: list[str], held: str, other: str) -> DataFrame:
    steps = F.array(
        F.struct(F.col("low").alias("at"), F.lit(1).alias("step")),
        F.struct((F.col("high") + 1).alias("at"), F.lit(-1).alias("step")),
    )
    return ranges.select(*keys, F.inline(steps)).select(
        *keys, "at", F.col("step").alias(held), F.lit(0).alias(other)
    )


def subtract_ranges(have: DataFrame, lack: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Maximal ranges covered by ``have`` and not by ``lack``, per ``keys``.

    A sweep over range ends: ends are netted per point first, so adjacent ranges
    (or single numbers) melt together before anything is sorted, and no number
    inside a range is ever spelled out. The netted ends are written once, and one count of
    them tells all three sweeps which keys to split.
    """
    points = _ends(have, keys, "_a", "_b").unionByName(_ends(lack, keys, "_b", "_a"))
    netted = points.groupBy(*keys, "at").agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    turns = cut(netted.filter("_a <> 0 OR _b <> 0"), "turns")
    hot = hot_keys(turns, keys, hot_rows)
    covered = running(turns, keys, ["at"], {"_in_a": F.col("_a"), "_in_b": F.col("_b")}, hot_rows, hot)
    marked = covered.select(*keys, "at", ((F.col("_in_a") > 0) & (F.col("_in_b") <= 0)).alias("_missing"))
    # Turns inside a missing stretch (ranges of ``have`` that touch) do not end it.
    stepped = previous(marked, keys, ["at"], {"_missing": "_was"}, hot_rows, hot)
    edges = stepped.filter(F.col("_missing") != F.coalesce("_was", F.lit(False)))
    closed = previous(edges, keys, ["at"], {"at": "low", "_missing": "_open"}, hot_rows, hot)
    return closed.filter("_open").select(*keys, "low", (F.col("at") - 1).alias("high"))


def single_numbers(df: DataFrame, keys: list[str], number: Column) -> DataFrame:
    """Numbers as one-element ranges."""
    return df.select(*keys, number.alias("low"), number.alias("high"))
