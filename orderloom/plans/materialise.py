"""How a model's result is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderloom.sources.increments import IncrementTable

MODES = ("view", "table", "ephemeral", "incremental")


def materialise(
    df: DataFrame,
    name: str,
    mode: str = "view",
    root: str | None = None,
    keys: list[str] | None = None,
    on_schema_change: str = "append_new_columns",
) -> DataFrame:
    """Keeps ``df`` as a view, a replaced table, an upserted table, or not at all.

    ``incremental`` needs unique ``keys``, writes only what ``df`` holds and merges on read; new columns are
    added or refused by ``on_schema_change`` (``append_new_columns`` or ``fail``).
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "ephemeral":
        return df
    if mode == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    table = IncrementTable(df.sparkSession, f"{root}/{name}", keys or [])
    if mode == "table":
        table.replace(df)
    else:
        table.append(df, on_schema_change=on_schema_change)
    return table.read()
