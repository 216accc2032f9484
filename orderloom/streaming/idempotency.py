"""Repeated requests: the first result of a key is kept and replayed until the key expires."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.joins import one_value
from orderloom.operators.merge import latest_per_key
from orderloom.operators.skew import HOT_ROWS, hot_keys, join_one_per_key
from orderloom.operators.windows import running
from orderloom.session import cut
from orderloom.sources.batches import BatchTable

DAY_SECONDS = 24 * 3600


def first_results(
    requests: DataFrame, key: str, at: str, tie: str, request_hash: str, response: Sequence[str] = ()
) -> DataFrame:
    """Each request judged against the first one of its key.

    ``first``, ``replay``, ``mismatch`` (other content under the same key) or
    ``expired`` (24 hours or more after the first). A request without a key is always ``first``.
    The columns named in ``response`` come back as ``stored_x``: a replay gets the first request's, a mismatch none.
    """
    opening = requests.groupBy(key).agg(
        F.min_by(F.struct(at, tie, request_hash, *response), F.struct(at, tie)).alias("_first")
    )
    joined = join_one_per_key(requests, opening, [key])
    age = F.col(at).cast("timestamp").cast("double") - F.col(f"_first.{at}").cast("timestamp").cast("double")
    verdict = (
        F.when(F.col(key).isNull() | ((F.col(at) == F.col(f"_first.{at}")) & (F.col(tie) == F.col(f"_first.{tie}"))), "first")
        .when(age >= DAY_SECONDS, "expired")
        .when(F.col(request_hash) != F.col(f"_first.{request_hash}"), "mismatch")
        .otherwise("replay")
    )
    judged = joined.withColumn("verdict", verdict)
    stored = [
        F.when(F.col("verdict") == "replay", F.col(f"_first.{c}")).when(F.col("verdict") != "mismatch", F.col(c)).alias(f"stored_{c}")
        for c in response
    ]
    return judged.select(*requests.columns, "verdict", *stored)


def _openings(jumps: DataFrame, key: str, rounds: int) -> DataFrame:
    """(key, _rank) of every request that opens its key, by pointer doubling.

    ``jumps`` has the rank of each request and that of the first one after its expiry. After round k each
    row knows the request 2**k openings ahead, and the first 2**k openings are marked.
    """
    table = jumps.withColumn("_open", F.col("_rank") == 1)
    for _ in range(rounds):
        ahead = table.select(key, F.col("_rank").alias("_next"), F.col("_next").alias("_after"))
        reached = table.filter("_open").select(key, F.col("_next").alias("_rank")).distinct().withColumn("_reached", F.lit(True))
        joined = table.join(ahead, [key, "_next"], "left").join(reached, [key, "_rank"], "left")
        opens = F.col("_open") | F.coalesce("_reached", F.lit(False))
        table = cut(joined.select(key, "_rank", F.col("_after").alias("_next"), opens.alias("_open")), "jumps")
    return table.filter("_open").select(key, "_rank")


def settle_requests(
    requests: DataFrame,
    key: str,
    at: str,
    tie: str,
    request_hash: str,
    expiry_seconds: int = DAY_SECONDS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The exact rule over a whole history: after expiry the next request opens the key anew.

    A sweep over requests and their expiry times gives every request its rank in the key and the rank of
    the first request after its expiry. Following these links from the first request gives the openings; they are followed by
    doubling, so the rounds are the logarithm of the lifetimes a key can have. A last sweep gives each request the opening before
    it. A request without a key is always ``first``. ``tie`` tells requests of one time apart.
    """
    columns = requests.columns
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    known = requests.filter(F.col(key).isNotNull()).withColumn("_t", micros)
    expiry = expiry_seconds * 1_000_000
    hot = hot_keys(known, [key], hot_rows)
    ends = known.select(key, tie, (F.col("_t") + expiry).alias("_t"), F.lit(0).alias("_turn"))
    both = known.withColumn("_turn", F.lit(1)).unionByName(ends, allowMissingColumns=True)
    # An end comes before the requests of its moment; the ends come in the order of their requests.
    counts = {"_rank": F.col("_turn"), "_ended": 1 - F.col("_turn")}
    swept = cut(running(both, [key], ["_t", "_turn", tie], counts, hot_rows, hot), "swept")
    jumps = swept.filter("_turn = 0").select(key, F.col("_ended").alias("_rank"), (F.col("_rank") + 1).alias("_next"))
    per_key = known.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.floor((F.max("_t") - F.min("_t")) / expiry).alias("spans"))
    most = per_key.agg(F.max(F.least("n", F.col("spans") + 1)).alias("most")).first().most or 1
    opened = _openings(jumps, key, (most - 1).bit_length()).withColumn("_opens", F.lit(1))
    rows = swept.filter("_turn = 1").drop("_turn", "_ended").join(opened, [key, "_rank"], "left")
    rows = running(rows, [key], ["_rank"], {"_life": F.coalesce("_opens", F.lit(0))}, hot_rows, hot)
    rows = cut(rows.select(*columns, "_life", "_opens"), "lives")
    first = rows.filter("_opens = 1").select(key, "_life", F.struct(at, tie, request_hash).alias("_first"))
    judged = join_one_per_key(rows, first, [key, "_life"], hot_rows=hot_rows)
    verdict = (
        F.when((F.col(at) == F.col(f"_first.{at}")) & (F.col(tie) == F.col(f"_first.{tie}")), "first")
        .when(F.col(request_hash) != F.col(f"_first.{request_hash}"), "mismatch")
        .otherwise("replay")
    )
    keyless = requests.filter(F.col(key).isNull()).select(*columns, F.lit("first").alias("verdict"))
    return judged.select(*columns, verdict.alias("verdict")).unionByName(keyless)


def openings_table(
    spark: SparkSession, path: str, key: str, at: str, tie: str, empty: DataFrame, expiry_seconds: int = DAY_SECONDS
) -> BatchTable:
    """The request that opened each key last; ``empty`` has the columns of a request.

    Batches follow each other in time, so an opening that had expired when the newest one came can meet no
    request any more: it is left out on reading, and ``compact`` does not store it again.
    """

    def latest(df: DataFrame) -> DataFrame:
        return latest_per_key(df, [key], [at, tie])

    def fold(base: DataFrame | None, batches: DataFrame | None) -> DataFrame:
        known = [df for df in (base, batches) if df is not None]
        if not known:
            return empty
        rows = reduce(DataFrame.unionByName, known)
        seconds = F.unix_micros(F.col(at).cast("timestamp"))
        newest = one_value(rows.select(F.max(seconds)))
        return latest(rows.filter(seconds > newest - expiry_seconds * 1_000_000))

    return BatchTable(spark, path, latest, fold)


def settle_writer(
    openings: BatchTable, out: str, key: str, at: str, tie: str, request_hash: str, expiry_seconds: int = DAY_SECONDS
):
    """The exact rule on a stream, as a ``foreachBatch`` function: verdicts go to ``out``.

    What opened a key before joins the batch as its earliest request, so a batch
    is settled like a history, hot keys included. Batches must follow each other
    in time. A batch run again sees the same openings and replaces its verdicts.
    """

    def settle_batch(batch: DataFrame, batch_id: int) -> None:
        columns = batch.columns
        requests = cut(batch, "requests").withColumn("_before", F.lit(False))
        asked = requests.groupBy(key).agg(F.min(at).alias("_earliest"))
        known = openings.read(before=batch_id).select(*columns).join(asked, key)  # of this batch's keys,
        seconds = F.unix_micros(F.col("_earliest").cast("timestamp")) - F.unix_micros(F.col(at).cast("timestamp"))
        alive = known.filter(seconds < expiry_seconds * 1_000_000)  # and not expired
        earlier = alive.select(*columns).withColumn("_before", F.lit(True))
        judged = settle_requests(requests.unionByName(earlier), key, at, tie, request_hash, expiry_seconds)
        judged = cut(judged, "verdicts")
        new = judged.filter("NOT _before").drop("_before")
        new.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        openings.write_batch(new.filter("verdict = 'first'").dropna(subset=[key]).select(*columns), batch_id)

    return settle_batch


def stream_first(requests: DataFrame, key: str, at: str, horizon: str = "24 hours") -> DataFrame:
    """Drops repeats of a key within the horizon, without keeping their results."""
    return requests.withWatermark(at, horizon).dropDuplicatesWithinWatermark([key])
