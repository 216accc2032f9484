"""Change data: decoding envelopes, the latest image per key, applying and replaying.

A *change row* is a flat row: the table's columns plus ``op``, ``ts_ms`` and ``pos``.
A *state row* is the table's columns plus ``is_deleted``, ``ts_ms`` and ``pos``: deleted
keys stay as flagged rows, so that an older change arriving late cannot revive them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from orderloom.operators.merge import latest_per_key
from orderloom.sources.batches import BatchTable

META = ["op", "ts_ms", "pos"]
STATE_META = ["is_deleted", "ts_ms", "pos"]

SOURCE = StructType(
    [
        StructField("db", StringType()),
        StructField("table", StringType()),
        StructField("ts_ms", LongType()),
        StructField("gtid", StringType()),
        StructField("pos", LongType()),
    ]
)


def envelope_schema(row: StructType) -> StructType:
    """Accepts the envelope under ``payload`` and the bare one."""
    body = [
        StructField("op", StringType()),
        StructField("before", row),
        StructField("after", row),
        StructField("source", SOURCE),
        StructField("ts_ms", LongType()),
    ]
    return StructType([StructField("payload", StructType(body)), *body, StructField("_corrupt_record", StringType())])


def parse_envelopes(
    messages: DataFrame, row: StructType, value: str = "value", keys: list[str] | None = None
) -> DataFrame:
    """Adds ``op, before, after, source, ts_ms`` and ``corrupt``; null values (tombstones) drop out.

    With ``keys``, a message without one of them is corrupt as well.
    """
    text = F.col(value).cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = messages.filter(F.col(value).isNotNull()).withColumn(
        "_m", F.from_json(text, envelope_schema(row), options)
    )

    def either(name: str) -> Column:
        return F.coalesce(F.col(f"_m.payload.{name}"), F.col(f"_m.{name}")).alias(name)

    opened = parsed.select(
        text.alias("raw"),
        either("op"),
        either("before"),
        either("after"),
        either("source"),
        either("ts_ms"),
        F.col("_m._corrupt_record").alias("_corrupt"),
    )
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    broken = (
        F.col("_corrupt").isNotNull()
        | F.col("op").isNull()
        | ~F.col("op").isin("c", "u", "d", "r")
        | image.isNull()
    )
    for key in keys or []:
        broken = broken | image[key].isNull()
    return opened.withColumn("corrupt", broken).drop("_corrupt")


def dead_letters(parsed: DataFrame) -> DataFrame:
    """The messages that could not be read, as they came."""
    return parsed.filter("corrupt").select("raw")


def change_rows(parsed: DataFrame) -> DataFrame:
    """Flat change rows of the readable messages; a delete carries its last image."""
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return parsed.filter("NOT corrupt").select(
        image.alias("_image"),
        "op",
        F.coalesce("source.ts_ms", "ts_ms").alias("ts_ms"),
        F.coalesce("source.pos", F.lit(0)).alias("pos"),
    ).select("_image.*", *META)


def _unwrapped(messages: DataFrame, row: StructType, value: str, keys: list[str] | None) -> DataFrame:
    flat = StructType(
        [
            *row.fields,
            StructField("__op", StringType()),
            StructField("__table", StringType()),
            StructField("__ts_ms", LongType()),
            StructField("__source_pos", LongType()),
            StructField("__deleted", StringType()),
            StructField("_corrupt_record", StringType()),
        ]
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    offset = [F.col("offset")] if "offset" in messages.columns else []
    text = F.col(value).cast("string")
    parsed = messages.filter(F.col(value).isNotNull()).select(text.alias("raw"), *offset, F.from_json(text, flat, options).alias("_m"))
    op = F.when(F.col("_m.__deleted") == "true", "d").otherwise(F.col("_m.__op"))
    pos = F.coalesce("_m.__source_pos", *offset, F.lit(0)).cast("long")
    read = F.coalesce(op.isin("c", "u", "d", "r"), F.lit(False)) & F.col("_m._corrupt_record").isNull()
    for key in keys or []:
        read = read & F.col(f"_m.{key}").isNotNull()
    return parsed.select("raw", "_m", op.alias("op"), pos.alias("pos"), read.alias("_read"))


def unwrapped_rows(messages: DataFrame, row: StructType, value: str = "value", keys: list[str] | None = None) -> DataFrame:
    """Change rows from flattened records: row columns, ``__op``, ``__table``, ``__ts_ms``, ``__deleted`` and, if the
    connector adds it, ``__source_pos``; without it the topic's ``offset`` orders changes of one millisecond.
    Records with a value of the wrong type, or without one of ``keys``, are not readable."""
    return _unwrapped(messages, row, value, keys).filter("_read").select(
        *[F.col(f"_m.{f.name}") for f in row.fields], "op", F.col("_m.__ts_ms").alias("ts_ms"), "pos"
    )


def unwrapped_dead_letters(messages: DataFrame, row: StructType, value: str = "value", keys: list[str] | None = None) -> DataFrame:
    """The flattened records that ``unwrapped_rows`` with the same ``keys`` cannot read, as they came."""
    return _unwrapped(messages, row, value, keys).filter("NOT _read").select("raw")


def of_table(parsed: DataFrame, table: str) -> DataFrame:
    """Messages of one table of a stream that carries several."""
    return parsed.filter(F.col("source.table") == table)


def to_envelopes(changes: DataFrame, database: str, table: str) -> DataFrame:
    """``value`` messages from change rows; the inverse of decoding, for tests and re-publishing."""
    columns = [c for c in changes.columns if c not in META]
    image = F.struct(*columns)
    source = F.struct(F.lit(database).alias("db"), F.lit(table).alias("table"), "ts_ms", "pos")
    payload = F.struct(
        "op",
        F.when(F.col("op") == "d", image).alias("before"),
        F.when(F.col("op") != "d", image).alias("after"),
        source.alias("source"),
        "ts_ms",
    )
    return changes.select(F.to_json(F.struct(payload.alias("payload"))).alias("value"))


def latest_image(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The last change of each key by (``ts_ms``, ``pos``)."""
    return latest_per_key(changes, keys, ["ts_ms", "pos"])


def as_state(rows: DataFrame) -> DataFrame:
    """Plain rows as state older than any change."""
    if "is_deleted" in rows.columns:
        return rows
    oldest = F.lit(-1).cast("long")
    return rows.withColumns({"is_deleted": F.lit(False), "ts_ms": oldest, "pos": oldest})


def apply_changes(state: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """New state after the changes: c, u and r write the row, d flags it.

    The changes are reduced to the last per key and meet the state in one full
    outer join, in which the newer row wins. So neither the order of arrival nor
    repeats matter, and the state is shuffled once. ``state`` has one row per key. A change without
    a key belongs to no row and is left out; ``parse_envelopes`` with ``keys`` makes it a dead letter.
    """
    held = as_state(state)
    changes = changes.dropna(subset=keys)
    last = latest_image(changes, keys).withColumn("is_deleted", F.col("op") == "d")
    old, new = held.alias("o"), last.select(*held.columns).alias("n")
    on = reduce(lambda a, b: a & b, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys])
    later = F.struct("n.ts_ms", "n.pos") > F.struct("o.ts_ms", "o.pos")
    newer = F.col(f"n.{keys[0]}").isNotNull() & (F.col(f"o.{keys[0]}").isNull() | later)
    return old.join(new, on, "full").select(
        *[F.when(newer, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in held.columns]
    )


def live_rows(state: DataFrame) -> DataFrame:
    return state.filter("NOT is_deleted").drop(*STATE_META)


def bootstrap(
    snapshot: DataFrame, changes: DataFrame, mode: str, start_ms: int, start_pos: int
) -> tuple[DataFrame, DataFrame]:
    """(initial state, changes still to apply) for a snapshot taken at a log position.

    ``initial`` loads the snapshot and continues behind it, ``schema_only`` starts
    empty behind it, ``never`` starts empty from the beginning of the log.
    """
    at = {"is_deleted": F.lit(False), "ts_ms": F.lit(start_ms).cast("long"), "pos": F.lit(start_pos).cast("long")}
    loaded = snapshot.withColumns(at)
    behind = changes.filter(
        (F.col("ts_ms") > start_ms) | ((F.col("ts_ms") == start_ms) & (F.col("pos") > start_pos))
    )
    if mode == "initial":
        return loaded, behind
    if mode == "schema_only":
        return loaded.limit(0), behind
    if mode == "never":
        return loaded.limit(0), changes
    raise ValueError("mode must be initial, schema_only or never")


def read_log(spark: SparkSession, path: str, row: StructType) -> DataFrame:
    """Change rows from files of envelopes, one JSON message per line."""
    return change_rows(parse_envelopes(spark.read.text(path), row))


def log_between(
    changes: DataFrame, start: int | None = None, stop: int | None = None, column: str = "pos"
) -> DataFrame:
    """Log rows from ``start`` up to but without ``stop``, by position or by ``ts_ms``."""
    rows = changes
    if start is not None:
        rows = rows.filter(F.col(column) >= start)
    if stop is not None:
        rows = rows.filter(F.col(column) < stop)
    return rows


def replay(
    snapshot: DataFrame, log: DataFrame, keys: list[str], stop: int | None = None, column: str = "ts_ms"
) -> DataFrame:
    """State just before the stop point, from a backup and the log; the stop is exclusive."""
    return live_rows(apply_changes(snapshot, log_between(log, stop=stop, column=column), keys))


def change_table(spark: SparkSession, path: str, keys: list[str], empty: DataFrame) -> BatchTable:
    """A table kept up to date from a stream of change rows; ``empty`` has its columns.

    Each batch leaves the last change per key it saw.
    """

    def fold(base: DataFrame | None, batches: DataFrame | None) -> DataFrame:
        state = as_state(empty) if base is None else base
        return state if batches is None else apply_changes(state, batches, keys)

    return BatchTable(spark, path, lambda batch: latest_image(batch, keys), fold)


def dead_letter_writer(path: str, good):
    """A ``foreachBatch`` function: unreadable messages go to ``path``, change rows to ``good``.

    The folder is named by batch, so a batch run again replaces its own dead letters.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        dead_letters(batch).write.mode("overwrite").text(f"{path}/batch={batch_id}")
        good(change_rows(batch), batch_id)

    return write_batch


def source_lag(events: DataFrame, source: str, at: str, as_of: Column) -> DataFrame:
    """Newest event and whole seconds behind ``as_of`` per source."""
    newest = events.groupBy(source).agg(F.max(at).alias("last_event"))
    return newest.withColumn("lag_seconds", F.timestamp_diff("SECOND", F.col("last_event"), as_of))
