"""Keys: surrogate hashes, request hashes, version 7 UUIDs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stands for NULL inside a hashed key; a value has its length and a colon there.
NULL_MARK = "-"


def spelled_out(*columns: Column) -> Column:
    """The values as one text that no other values have: each with its length before it."""
    texts = [c.cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit(NULL_MARK)) for t in texts])


def surrogate_key(*columns: Column) -> Column:
    """A stable key for a natural key: needs no counter, no lookup and no shuffle."""
    return F.sha2(spelled_out(*columns), 256)


def request_hash(body: Column) -> Column:
    return F.sha2(body, 256)


def uuid_v4() -> Column:
    return F.uuid()


def uuid_v7(at: Column, *salt: Column) -> Column:
    """Time-ordered UUID for the event time ``at``.

    48 bits of milliseconds, the version digit, 12 bits, the variant and 62 bits.
    With ``salt`` columns the random part is their hash, so that a retried task
    gives the same ids again; without, it is random.
    """
    ms = F.unix_millis(at.cast("timestamp"))
    time_hex = F.lpad(F.lower(F.hex(ms)), 12, "0")
    seed = spelled_out(*salt) if salt else F.uuid()
    noise = F.md5(seed)
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(noise, 4, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return F.concat_ws(
        "-",
        F.substring(time_hex, 1, 8),
        F.substring(time_hex, 9, 4),
        F.concat(F.lit("7"), F.substring(noise, 1, 3)),
        F.concat(variant, F.substring(noise, 5, 3)),
        F.substring(noise, 8, 12),
    )
