"""Pages, cursors and top-k over shards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators.ranking import top_per_key


def row_before(columns: list[Column], values: list[Column]) -> Column:
    """Row-value comparison ``(a, b, ..) < (x, y, ..)``.

    Spelled out, with the first column's bound repeated on its own, so that both
    reach the file scan; a comparison of structs would not.
    """
    first = columns[0] < values[0]
    if len(columns) == 1:
        return first
    return (columns[0] <= values[0]) & (first | row_before(columns[1:], values[1:]))


def offset_page(df: DataFrame, order: list[Column], size: int, page: int) -> DataFrame:
    """Page by number. Costs as much as all pages before it; see ``keyset_page``."""
    return df.orderBy(*order).offset((page - 1) * size).limit(size)


def keyset_page(df: DataFrame, order: list[str], cursor: list[Column] | None, size: int) -> DataFrame:
    """The ``size`` rows after ``cursor``, newest first; every page costs the same."""
    columns = [F.col(c) for c in order]
    rest = df if cursor is None else df.filter(row_before(columns, cursor))
    return rest.orderBy(*[c.desc() for c in columns]).limit(size)


def seek_page(df: DataFrame, key: str, last, size: int) -> DataFrame:
    """The ``size`` rows with the smallest key above ``last``."""
    return df.filter(F.col(key) > last).orderBy(key).limit(size)


def page_envelope(
    df: DataFrame, order: list[str], cursor: list[Column] | None, size: int, about: int | None = None
) -> DataFrame:
    """One row: rows on the page, whether more follow, and the cursor to continue from.

    Reads one row more than the page holds, never the whole table's count. ``about`` is passed on as
    ``approximate_total``: a count from file footers or catalog statistics (``sources.tables``).
    """
    columns = [F.col(c) for c in order]
    fetched = keyset_page(df, order, cursor, size + 1)
    ranked = fetched.agg(
        F.sort_array(F.collect_list(F.struct(*columns)), asc=False).alias("rows")
    )  # bounded: size + 1 entries
    kept = F.slice("rows", 1, size)
    return ranked.select(
        F.size(kept).alias("returned"),
        (F.size("rows") > size).alias("has_more"),
        *([] if about is None else [F.lit(about).cast("long").alias("approximate_total")]),
        *[F.try_element_at(kept, F.lit(-1))[c].alias(f"next_{c}") for c in order],
    )


def gather_top(shards: list[DataFrame], order: list[Column], k: int) -> DataFrame:
    """Top ``k`` over several same-shaped tables; each contributes at most ``k`` rows per task."""
    return reduce(DataFrame.unionByName, shards).orderBy(*order).limit(k)


def top_per_shard(df: DataFrame, shard: str, order: list[Column], k: int) -> DataFrame:
    return top_per_key(df, [shard], order, k)
