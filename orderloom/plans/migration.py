"""Online change of a table's layout: copy, catch up, verify, switch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.quality import row_checksums
from orderloom.session import cut
from orderloom.sources.snapshots import SnapshotTable
from orderloom.streaming.changes import apply_changes, live_rows


def _content(df: DataFrame) -> tuple:
    columns = [F.col(c) for c in sorted(df.columns)]
    return tuple(df.agg(F.count(F.lit(1)), *[F.sum(c) for c in row_checksums(*columns)]).first())


def migrate(
    table: SnapshotTable,
    transform: Callable[[DataFrame], DataFrame],
    changes: DataFrame,
    keys: list[str],
    fresh: DataFrame,
) -> int:
    """Moves ``table`` to the layout ``transform`` gives and makes that its next version.

    ``changes`` are those made while the copy ran; ``fresh`` is the old-layout
    table with them applied, which the result must equal row for row, or the old
    version stays in force.
    """
    copied = transform(table.read())
    caught_up = live_rows(apply_changes(copied, transform(changes), keys))
    candidate = cut(caught_up, "migration")
    if _content(candidate) != _content(transform(fresh).select(*candidate.columns)):
        raise RuntimeError("the migrated table differs from the source; nothing was switched")
    return table.replace(candidate)
