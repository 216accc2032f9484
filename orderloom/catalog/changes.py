"""Change data, outbox, idempotency, metrics and streams, all from the event table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StructField, StructType

from orderloom.bindings import money
from orderloom.catalog.core import query
from orderloom.functions import dates, rules
from orderloom.functions.amounts import cents, from_cents, total_cents
from orderloom.session import new_folder
from orderloom.sources import topics
from orderloom.streaming import changes, idempotency, late, metrics, outbox, ranges, readmodel, sinks

EVENTS_END = "2024-01-31 00:00:00"
STOP_AT = "2024-01-20 00:00:00"
OP_OF_TYPE = {"signup": "c", "click": "u", "purchase": "u", "error": "d", "view": "r"}
ROW = StructType(
    [
        StructField("user_id", LongType()),
        StructField("value", DecimalType(14, 2)),
        StructField("k", LongType()),
    ]
)

LOG_CTE = """
log AS (
  SELECT user_id, CAST(value AS DECIMAL(14,2)) AS value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' WHEN 'view' THEN 'r' ELSE 'u' END AS op,
         epoch_us(ts) // 1000 AS ts_ms, event_id AS pos FROM events
)"""


def log_of(t, events=None):
    """The events as a change log of one table keyed by user."""
    rows = t.events if events is None else events
    return rows.select(
        "user_id",
        money("value").alias("value"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        rules.lookup(F.col("event_type"), OP_OF_TYPE).alias("op"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        F.col("event_id").alias("pos"),
    )


FILES = 4


def event_stream(t):
    """The event table as a stream in order of time: four micro-batches of FILES files each."""
    path = new_folder(t.spark, "event-files")
    cuts = t.events.agg(F.percentile_approx("event_id", [0.25, 0.5, 0.75])).first()[0]
    bounds = t.events.filter(F.col("event_id").isin(cuts)).select("ts").orderBy("ts").collect()
    bounds = [F.lit(row.ts).cast("timestamp_ntz") for row in bounds]
    part = sum((F.col("ts") >= bound).cast("int") for bound in bounds)
    for number in range(len(bounds) + 1):  # one after the other: a stream takes files by their time
        t.events.filter(part == number).repartition(FILES).write.mode("append").parquet(path)
    return t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", FILES).parquet(path)


LATEST_SQL = f"""
    WITH {LOG_CTE}, ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, pos DESC) AS rn FROM log)
"""


@query(
    "s9_keyed_publish",
    "SELECT CAST(user_id AS VARCHAR) AS key, COUNT(*) AS messages, CAST(SUM(event_id) AS BIGINT) AS ids FROM events GROUP BY 1",
)
def _(t):
    """Messages keyed by user written to files and read back, their bodies decoded."""
    path = new_folder(t.spark, "published")
    topics.publish_files(topics.to_messages(t.events.select("event_id", "user_id", "event_type"), F.col("user_id")), path)
    back = t.spark.read.schema("key string, value string").json(path)
    body = F.from_json("value", "event_id long").getField("event_id")
    return back.groupBy("key").agg(F.count(F.lit(1)).alias("messages"), F.sum(body).alias("ids"))


@query(
    "s15_change_log_between",
    f"WITH {LOG_CTE} SELECT * FROM log WHERE pos >= 500 AND ts_ms < epoch_ms(TIMESTAMP '{STOP_AT}')",
)
def _(t):
    """The log as files of envelopes, read from a position up to a time."""
    path = new_folder(t.spark, "log")
    changes.to_envelopes(log_of(t), "shop_db", "users").write.text(path)
    log = changes.log_between(changes.read_log(t.spark, path, ROW), start=500, column="pos")
    return changes.log_between(log, stop=F.unix_millis(F.lit(STOP_AT).cast("timestamp")), column="ts_ms")


@query("v1_latest_image", LATEST_SQL + "SELECT user_id, value, k, op, ts_ms, pos FROM ranked WHERE rn = 1")
def _(t):
    return changes.latest_image(log_of(t), ["user_id"])


@query("v2_decode_envelopes", f"WITH {LOG_CTE} SELECT * FROM log")
def _(t):
    """The log written as envelopes, under ``payload`` for one half and bare for the other, and decoded."""
    log = log_of(t)
    wrapped = changes.to_envelopes(log.filter("op <> 'u'"), "shop_db", "users")
    bare = changes.to_envelopes(log.filter("op = 'u'"), "shop_db", "users").select(
        F.get_json_object("value", "$.payload").alias("value")
    )
    return changes.change_rows(changes.parse_envelopes(wrapped.unionByName(bare), ROW))


@query("v3_decode_unwrapped", f"WITH {LOG_CTE} SELECT user_id, value, k, op, ts_ms FROM log WHERE op <> 'r'")
def _(t):
    """Flattened records, deletes as flagged rows; the records of type r come as tombstones."""
    log = log_of(t)
    record = F.struct(
        "user_id",
        "value",
        "k",
        F.when(F.col("op") == "d", "u").otherwise(F.col("op")).alias("__op"),
        F.lit("users").alias("__table"),
        F.col("ts_ms").alias("__ts_ms"),
        F.when(F.col("op") == "d", "true").otherwise("false").alias("__deleted"),
    )
    messages = log.select(F.when(F.col("op") != "r", F.to_json(record)).alias("value"))
    return changes.unwrapped_rows(messages, ROW).drop("pos")


@query(
    "v3_unwrapped_dead_letters",
    """
    SELECT event_id % 7 = 0 AS keyless, event_id % 5 = 0 AS wrong_type, event_id % 7 <> 0 AND event_id % 5 <> 0 AS is_read, COUNT(*) AS messages
    FROM events GROUP BY 1, 2, 3
    """,
)
def _(t):
    """Flattened records, some without their key and some with a text for a number: read or dead, none lost."""
    number = F.col("event_id").cast("string")
    record = F.concat(
        F.lit('{"__op":"u","n":'), number, F.when(F.col("event_id") % 7 != 0, F.concat(F.lit(',"id":'), number)).otherwise(""),
        F.when(F.col("event_id") % 5 == 0, F.lit(',"v":"9x"}')).otherwise(F.lit(',"v":9}')),
    )
    messages = t.events.select(record.alias("value"))
    row = StructType([StructField("n", LongType()), StructField("id", LongType()), StructField("v", LongType())])
    good = changes.unwrapped_rows(messages, row, keys=["id"]).select("n", F.lit(True).alias("is_read"))
    lost = changes.unwrapped_dead_letters(messages, row, keys=["id"]).select(F.get_json_object("raw", "$.n").cast("long").alias("n"), F.lit(False).alias("is_read"))
    both = good.unionByName(lost)
    return both.groupBy((F.col("n") % 7 == 0).alias("keyless"), (F.col("n") % 5 == 0).alias("wrong_type"), "is_read").agg(F.count(F.lit(1)).alias("messages"))


STATE_SQL = LATEST_SQL + "SELECT user_id, value, k, op = 'd' AS is_deleted, ts_ms, pos FROM ranked WHERE rn = 1"


@query("v4_apply_changes", STATE_SQL)
def _(t):
    """Two halves of the log, the later one first and one of them twice: the state is the same."""
    log = log_of(t)
    middle = F.lit(STOP_AT).cast("timestamp")
    early, late = log.filter(F.col("ts_ms") < F.unix_millis(middle)), log.filter(F.col("ts_ms") >= F.unix_millis(middle))
    empty = log.limit(0).select("user_id", "value", "k")
    state = changes.apply_changes(empty, late, ["user_id"])
    for batch in [early, early]:
        state = changes.apply_changes(state, batch, ["user_id"])
    return state


@query("v4_apply_stream", STATE_SQL)
def _(t):
    """The log as a stream into a table, batch by batch."""
    root = new_folder(t.spark, "apply")
    empty = log_of(t).limit(0).select("user_id", "value", "k")
    table = changes.change_table(t.spark, f"{root}/table", ["user_id"], empty)
    table.run(log_of(t, event_stream(t)), f"{root}/checkpoint")
    return table.read()


@query(
    "v5_op_labels",
    f"WITH {LOG_CTE} SELECT CASE op WHEN 'c' THEN 'CREATE' WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' ELSE 'SNAPSHOT' END AS label, COUNT(*) AS n FROM log GROUP BY 1",
)
def _(t):
    return log_of(t).groupBy(rules.op_label(F.col("op")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "v6_snapshot_then_stream",
    LATEST_SQL + "SELECT user_id, value, k FROM ranked WHERE rn = 1 AND op <> 'd'",
)
def _(t):
    """A snapshot taken in the middle of the log and the changes behind it give the end state."""
    log = log_of(t)
    stop = log.agg(F.max_by(F.struct("ts_ms", "pos"), F.when(F.col("ts_ms") < F.unix_millis(F.lit(STOP_AT).cast("timestamp")), F.col("pos"))).alias("p")).first().p
    empty = log.limit(0).select("user_id", "value", "k")
    seen = log.filter(F.col("pos") <= stop.pos)
    snapshot = changes.live_rows(changes.apply_changes(empty, seen, ["user_id"]))
    state, behind = changes.bootstrap(snapshot, log, "initial", stop.ts_ms, stop.pos)
    return changes.live_rows(changes.apply_changes(state, behind, ["user_id"]))


@query(
    "v6_bootstrap_modes",
    f"""
    WITH {LOG_CTE}, start AS (SELECT ts_ms AS s_ms, pos AS s_pos FROM log WHERE ts_ms < epoch_ms(TIMESTAMP '{STOP_AT}') ORDER BY ts_ms DESC, pos DESC LIMIT 1),
    placed AS (SELECT *, (ts_ms, pos) > (s_ms, s_pos) AS behind FROM log, start),
    runs AS (SELECT 'initial' AS mode, * FROM placed UNION ALL SELECT 'schema_only', * FROM placed WHERE behind UNION ALL SELECT 'never', * FROM placed),
    ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY mode, user_id ORDER BY ts_ms DESC, pos DESC) AS rn FROM runs)
    SELECT mode, user_id, value, k FROM ranked WHERE rn = 1 AND op <> 'd'
    """,
)
def _(t):
    """A snapshot at a time of the log: loaded, left out, or left out with the log from its beginning."""
    log = log_of(t)
    stop = F.unix_millis(F.lit(STOP_AT).cast("timestamp"))
    start = log.filter(F.col("ts_ms") < stop).agg(F.max(F.struct("ts_ms", "pos")).alias("p")).first().p
    empty = log.limit(0).select("user_id", "value", "k")
    snapshot = changes.replay(empty, log, ["user_id"], stop, "ts_ms")
    ends = []
    for mode in ("initial", "schema_only", "never"):
        state, todo = changes.bootstrap(snapshot, log, mode, start.ts_ms, start.pos)
        end = changes.live_rows(changes.apply_changes(state, todo, ["user_id"]))
        ends.append(end.select(F.lit(mode).alias("mode"), "user_id", "value", "k"))
    return reduce(DataFrame.unionByName, ends)


@query(
    "v7_route_tables",
    "SELECT 'shopdb.shop_db.' || event_type AS topic, COUNT(*) AS messages, COUNT(DISTINCT user_id) AS keys FROM events GROUP BY 1",
)
def _(t):
    """One topic per table, the event type standing for the table."""
    topic = F.concat(F.lit(topics.topic_name("shopdb", "shop_db", "")), F.col("event_type"))
    messages = topics.to_messages(t.events.select("event_id", "user_id", "event_type"), F.col("user_id"), topic)
    return messages.groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct("key").alias("keys")
    )


DEAD_SQL = f"""
    WITH {LOG_CTE} SELECT op, COUNT(*) AS readable, CAST(0 AS BIGINT) AS dead FROM log WHERE op <> 'r' GROUP BY op
    UNION ALL SELECT 'dead', CAST(0 AS BIGINT), COUNT(*) FROM log WHERE op = 'r'
"""


@query(
    "v8_dead_letters",
    DEAD_SQL,
)
def _(t):
    """Messages of type r arrive broken: cut off in the middle. The rest is decoded."""
    log = log_of(t)
    good = changes.to_envelopes(log.filter("op <> 'r'"), "shop_db", "users")
    bad = changes.to_envelopes(log.filter("op = 'r'"), "shop_db", "users").select(F.expr("left(value, 40)").alias("value"))
    parsed = changes.parse_envelopes(good.unionByName(bad), ROW)
    counted = F.when(F.col("corrupt"), "dead").otherwise(F.col("op"))
    return parsed.groupBy(counted.alias("op")).agg(
        F.count_if(~F.col("corrupt")).alias("readable"), F.count_if(F.col("corrupt")).alias("dead")
    )


@query("v8_dead_letters_of_a_stream", DEAD_SQL)
def _(t):
    """The same messages as a stream: dead ones to a folder of their own, change rows to another, batch by batch."""
    path = new_folder(t.spark, "dead-letters")
    messages = changes.to_envelopes(log_of(t, event_stream(t)), "shop_db", "users")
    broken = F.get_json_object("value", "$.payload.op") == "r"
    arrived = messages.select(F.when(broken, F.expr("left(value, 40)")).otherwise(F.col("value")).alias("value"))

    def keep(rows, batch_id):
        rows.write.mode("overwrite").parquet(f"{path}/good/batch={batch_id}")

    writer = changes.dead_letter_writer(f"{path}/dead", keep)
    stream = changes.parse_envelopes(arrived, ROW).writeStream.foreachBatch(writer).option("checkpointLocation", f"{path}/checkpoint")
    stream.trigger(availableNow=True).start().awaitTermination()
    good = t.spark.read.parquet(f"{path}/good").groupBy("op").agg(F.count(F.lit(1)).alias("readable"), F.lit(0).cast("long").alias("dead"))
    dead = t.spark.read.text(f"{path}/dead").agg(F.lit("dead").alias("op"), F.lit(0).cast("long").alias("readable"), F.count(F.lit(1)).alias("dead"))
    return good.unionByName(dead.filter("dead > 0"))


@query(
    "v9_source_lag",
    f"""
    SELECT event_type, MAX(ts) AS last_event, date_sub('second', MAX(ts), TIMESTAMP '{EVENTS_END}') AS lag_seconds FROM events GROUP BY 1
    """,
)
def _(t):
    return changes.source_lag(t.events, "event_type", "ts", dates.instant(EVENTS_END))


@query(
    "v10_replay_to_time",
    f"""
    WITH {LOG_CTE}, ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, pos DESC) AS rn
      FROM log WHERE ts_ms < epoch_ms(TIMESTAMP '{STOP_AT}'))
    SELECT user_id, value, k FROM ranked WHERE rn = 1 AND op <> 'd'
    """,
)
def _(t):
    log = log_of(t)
    stop = F.unix_millis(F.lit(STOP_AT).cast("timestamp"))
    empty = log.limit(0).select("user_id", "value", "k")
    return changes.replay(empty, log, ["user_id"], stop, "ts_ms")


@query(
    "v10_replay_to_position",
    f"""
    WITH {LOG_CTE}, ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, pos DESC) AS rn
      FROM log WHERE pos < (SELECT MAX(pos) FROM log WHERE op = 'd'))
    SELECT user_id, value, k FROM ranked WHERE rn = 1 AND op <> 'd'
    """,
)
def _(t):
    """The state just before the last delete."""
    log = log_of(t)
    stop = log.filter("op = 'd'").agg(F.max("pos")).scalar()
    empty = log.limit(0).select("user_id", "value", "k")
    return changes.replay(empty, log, ["user_id"], stop, "pos")


@query(
    "v11_missing_ranges",
    """
    WITH m AS (SELECT event_id, event_id - ROW_NUMBER() OVER (ORDER BY event_id) AS island FROM events WHERE event_type = 'error')
    SELECT 'log' AS source, MIN(event_id) AS low, MAX(event_id) AS high FROM m GROUP BY island
    """,
)
def _(t):
    """A copy of the log without its errors: the ranges of ids it lacks."""
    ids = t.events.select(F.lit("log").alias("source"), "event_id", "event_type")
    have = ranges.single_numbers(ids, ["source"], F.col("event_id"))
    lack = ranges.single_numbers(ids.filter("event_type <> 'error'"), ["source"], F.col("event_id"))
    return ranges.subtract_ranges(have, lack, ["source"])


@query(
    "v11_parsed_ranges",
    """
    SELECT event_type AS source, event_id AS low, event_id + user_id % 3 AS high FROM events
    UNION ALL SELECT event_type, event_id + 10, event_id + 10 FROM events UNION ALL SELECT 'other', event_id, event_id FROM events
    """,
)
def _(t):
    """Sets of ids as text, such as ``click:5-7:15,other:5``, read back as ranges."""
    first = F.concat_ws("-", F.col("event_id"), F.col("event_id") + F.col("user_id") % 3)
    mine = F.concat_ws(":", F.upper("event_type"), first, F.col("event_id") + 10)
    texts = t.events.select(F.concat(mine, F.lit(", other:"), F.col("event_id").cast("string")).alias("ids"))
    return ranges.parse_ranges(texts, "ids")


OUTBOX_STATUS = "CASE WHEN event_type IN ('click', 'view') THEN 'published' WHEN event_type = 'error' THEN 'failed' ELSE 'pending' END"


def outbox_of(t):
    kind = F.col("event_type")
    return t.events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("aggregate_id"),
        "event_type",
        F.col("props").alias("payload"),
        F.when(kind.isin("click", "view"), "published").when(kind == "error", "failed").otherwise("pending").alias("status"),
        F.when(kind.isin("click", "view"), F.col("ts")).alias("published_at"),
        F.when(kind == "error", F.pmod("event_id", F.lit(5))).otherwise(0).cast("int").alias("retry_count"),
        F.col("ts").alias("created_at"),
    )


@query(
    "v12_outbox_next_batch",
    f"""
    SELECT event_id AS id, user_id AS aggregate_id, event_type FROM events WHERE {OUTBOX_STATUS} = 'pending' ORDER BY ts, event_id LIMIT 100
    """,
)
def _(t):
    return outbox.next_batch(outbox_of(t), 100).select("id", "aggregate_id", "event_type")


@query(
    "v12_outbox_settle",
    f"""
    WITH o AS (SELECT *, {OUTBOX_STATUS} AS status, CASE WHEN event_type = 'error' THEN event_id % 5 ELSE 0 END AS tries FROM events)
    SELECT event_id AS id, CASE WHEN status = 'pending' THEN CASE WHEN event_type = 'purchase' THEN 'published' ELSE 'failed' END
             WHEN status = 'failed' AND tries < 3 THEN 'pending' ELSE status END AS status,
           CAST(tries + CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS INTEGER) AS retry_count
    FROM o
    """,
)
def _(t):
    """Failed rows with tries left become pending again; then the pending ones are settled: sign-ups fail."""
    rows = outbox_of(t)
    outcome = rows.filter("status = 'pending'").select("id", (F.col("event_type") == "purchase").alias("ok"))
    return outbox.settle(outbox.requeue(rows), outcome, dates.instant(EVENTS_END)).select("id", "status", "retry_count")


@query(
    "v12_outbox_log",
    f"""
    WITH o AS (SELECT event_id, ts, {OUTBOX_STATUS} AS status, CASE WHEN event_type = 'error' THEN event_id % 5 ELSE 0 END AS tries FROM events),
    a AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY status ORDER BY ts, event_id) AS place FROM o),
    b AS (SELECT event_id, ts, CASE WHEN status <> 'pending' OR place > 130 THEN status WHEN place <= 50 THEN 'failed' ELSE 'published' END AS status,
                 tries + CASE WHEN status = 'pending' AND place <= 50 THEN 1 ELSE 0 END AS tries FROM a),
    c AS (SELECT event_id, ts, tries, CASE WHEN status = 'failed' AND tries < 3 THEN 'pending' ELSE status END AS status FROM b),
    d AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY status ORDER BY ts, event_id) AS place FROM c)
    SELECT event_id AS id, CASE WHEN status = 'pending' AND place <= 30 THEN 'published' ELSE status END AS status, CAST(tries AS INTEGER) AS retry_count FROM d
    """,
)
def _(t):
    """Batches drained into a log of outcomes: one fails, one is published, failed ones are tried again, oldest first."""
    root, at = new_folder(t.spark, "outbox"), dates.instant(EVENTS_END)

    def broken(messages):
        raise ConnectionError("no broker")

    def publish(messages):
        topics.publish_files(messages, f"{root}/published")

    table = outbox.OutboxLog(t.spark, f"{root}/table")
    table.insert(outbox_of(t))
    table.drain(broken, at, 50)
    table.drain(publish, at, 80)
    table.requeue(at)
    table.drain(publish, at, 30)
    return table.read().select("id", "status", "retry_count")


@query(
    "v13_event_router",
    "SELECT 'shop.' || event_type AS topic, CAST(user_id AS VARCHAR) AS key, COUNT(*) AS messages FROM events GROUP BY 1, 2",
)
def _(t):
    """Messages written to a folder per topic and read back."""
    path = new_folder(t.spark, "topics")
    topics.publish_files(outbox.route(outbox_of(t), "shop."), path)
    back = t.spark.read.schema("topic string, key string, value string").json(path)
    return back.groupBy("topic", "key").agg(F.count(F.lit(1)).alias("messages"))


def requests_of(t, events=None):
    """Requests keyed by user and kind; the value tells repeats from changed requests."""
    rows = t.events if events is None else events
    return rows.select(
        F.concat_ws(":", F.col("user_id").cast("string"), "event_type").alias("idempotency_key"),
        "ts",
        "event_id",
        F.sha2(F.floor(F.col("value") / 10).cast("string"), 256).alias("request_hash"),
    )


REQUESTS_CTE = """
req AS (SELECT user_id || ':' || event_type AS idempotency_key, ts, event_id, sha256(CAST(CAST(floor(value / 10) AS BIGINT) AS VARCHAR)) AS request_hash FROM events)
"""


@query(
    "v14_first_results",
    f"""
    WITH {REQUESTS_CTE}, f AS (SELECT *, FIRST_VALUE(ts) OVER w AS fts, FIRST_VALUE(event_id) OVER w AS fid, FIRST_VALUE(request_hash) OVER w AS fh
         FROM req WINDOW w AS (PARTITION BY idempotency_key ORDER BY ts, event_id))
    SELECT idempotency_key, event_id, CASE WHEN event_id = fid THEN 'first' WHEN ts >= fts + INTERVAL 24 HOUR THEN 'expired'
           WHEN request_hash <> fh THEN 'mismatch' ELSE 'replay' END AS verdict FROM f
    """,
)
def _(t):
    judged = idempotency.first_results(requests_of(t), "idempotency_key", "ts", "event_id", "request_hash")
    return judged.select("idempotency_key", "event_id", "verdict")


@query(
    "v14_replayed_responses",
    f"""
    WITH {REQUESTS_CTE}, f AS (SELECT *, FIRST_VALUE(ts) OVER w AS fts, FIRST_VALUE(event_id) OVER w AS fid, FIRST_VALUE(request_hash) OVER w AS fh
         FROM req WINDOW w AS (PARTITION BY idempotency_key ORDER BY ts, event_id))
    SELECT event_id, CASE WHEN event_id = fid OR ts >= fts + INTERVAL 24 HOUR THEN 200 + event_id % 3 WHEN request_hash <> fh THEN NULL ELSE 200 + fid % 3 END AS stored_code,
           CASE WHEN event_id = fid OR ts >= fts + INTERVAL 24 HOUR THEN 'done ' || event_id WHEN request_hash <> fh THEN NULL ELSE 'done ' || fid END AS stored_body FROM f
    """,
)
def _(t):
    """A repeated request gets the stored code and body of the first."""
    answered = requests_of(t).withColumns(
        {"code": 200 + F.pmod("event_id", F.lit(3)), "body": F.concat(F.lit("done "), F.col("event_id").cast("string"))}
    )
    judged = idempotency.first_results(answered, "idempotency_key", "ts", "event_id", "request_hash", ["code", "body"])
    return judged.select("event_id", "stored_code", "stored_body")


@query(
    "v14_expiring_keys",
    f"""
    WITH RECURSIVE {REQUESTS_CTE},
    openings AS (
      SELECT idempotency_key, MIN(ts) AS opened FROM req GROUP BY 1
      UNION ALL
      SELECT o.idempotency_key, (SELECT MIN(r.ts) FROM req r WHERE r.idempotency_key = o.idempotency_key AND r.ts >= o.opened + INTERVAL 10 DAY)
      FROM openings o WHERE o.opened IS NOT NULL),
    held AS (SELECT o.idempotency_key, o.opened, r.request_hash AS h FROM openings o JOIN req r ON r.idempotency_key = o.idempotency_key AND r.ts = o.opened)
    SELECT q.idempotency_key, q.event_id, CASE WHEN q.ts = h.opened THEN 'first' WHEN q.request_hash <> h.h THEN 'mismatch' ELSE 'replay' END AS verdict
    FROM req q JOIN held h ON h.idempotency_key = q.idempotency_key AND h.opened <= q.ts AND q.ts < h.opened + INTERVAL 10 DAY
    """,
)
def _(t):
    """A key lives ten days from its first request; the next one opens it anew."""
    judged = idempotency.settle_requests(
        requests_of(t), "idempotency_key", "ts", "event_id", "request_hash", expiry_seconds=10 * 24 * 3600
    )
    return judged.select("idempotency_key", "event_id", "verdict")


@query(
    "v15_late_arrivals",
    """
    SELECT user_id, COUNT(*) AS events, CAST(SUM(CAST(value AS DECIMAL(14,2))) AS DECIMAL(20,2)) AS amount FROM events GROUP BY 1
    """,
)
def _(t):
    """Errors arrive a day late; the second load looks back three days and upserts, so nothing is lost or doubled."""
    from orderloom.plans.warehouse import incremental
    from orderloom.operators.merge import upsert

    rows = t.events.select("event_id", "user_id", "ts", money("value").alias("value"), "event_type")
    arrived = F.when(F.col("event_type") == "error", F.col("ts") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("ts"))
    first = rows.filter(arrived < dates.instant(STOP_AT))
    mark = first.agg(F.max("ts").alias("m")).first().m
    loaded = upsert(first, incremental(rows, "ts", mark, lookback_days=3), ["event_id"])
    return loaded.groupBy("user_id").agg(F.count(F.lit(1)).alias("events"), total_cents(cents("value")).alias("amount"))


ARRIVALS_CTE = """
arrived AS (
  SELECT event_id, user_id, ts, CAST(value AS DECIMAL(14,2)) AS value,
         ts + to_days(CASE event_type WHEN 'error' THEN 2 WHEN 'signup' THEN 5 ELSE 0 END) AS came_at FROM events
),
batched AS (SELECT *, datediff('day', DATE '2024-01-01', CAST(came_at AS DATE)) // 7 AS batch FROM arrived),
marks AS (SELECT batch, MAX(MAX(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM batched GROUP BY batch),
split AS (SELECT b.*, COALESCE(b.ts < seen - INTERVAL 3 DAY, FALSE) AS is_late FROM batched b JOIN marks m ON m.batch = b.batch)"""


def late_stream(t):
    """Events in order of arrival, a micro-batch a week: errors come two days late, sign-ups five. Split behind a
    watermark of three days; gives the table of marks, the folder of what was in time and the one of what was late."""
    root = new_folder(t.spark, "late")
    days = rules.lookup(F.col("event_type"), {"error": 2, "signup": 5}, 0)
    arrived = F.date_add(F.col("ts").cast("date"), days)
    week = F.floor(F.date_diff(arrived, F.lit("2024-01-01").cast("date")) / 7)
    rows = t.events.select("event_id", "user_id", "ts", money("value").alias("value"), week.alias("week"))
    first, last = rows.agg(F.min("week"), F.max("week")).first()
    for number in range(first, last + 1):  # one after the other: a stream takes files by their time
        batch = rows.filter(F.col("week") == number).drop("week")
        batch.repartition(FILES).write.mode("append").parquet(f"{root}/arrived")
    stream = t.spark.readStream.schema(rows.drop("week").schema).option("maxFilesPerTrigger", FILES).parquet(f"{root}/arrived")
    marks = late.marks_table(t.spark, f"{root}/marks", "ts")
    writer = late.split_writer(marks, f"{root}/in-time", f"{root}/late", "ts", 3 * 24 * 3600)
    sinks.run(stream, writer, f"{root}/checkpoint")
    return marks, f"{root}/in-time", f"{root}/late"


@query(
    "v15_late_stream",
    f"""
    WITH {ARRIVALS_CTE}
    SELECT event_id, is_late FROM split
    """,
)
def _(t):
    """Every event of a stream ends in one of two tables: in time, or late behind the watermark."""
    _, in_time, behind = late_stream(t)
    read = t.spark.read.schema("event_id long")
    both = read.parquet(in_time).withColumn("is_late", F.lit(False))
    return both.unionByName(read.parquet(behind).withColumn("is_late", F.lit(True))).select("event_id", "is_late")


@query(
    "v15_late_repaired",
    f"""
    WITH {ARRIVALS_CTE}
    SELECT CAST(ts AS DATE) AS day, COUNT(*) AS events, CAST(SUM(value) AS DECIMAL(20,2)) AS amount,
           COUNT(*) FILTER (is_late) AS repaired FROM split GROUP BY 1
    """,
)
def _(t):
    """Totals per day as of the stream, brought up to date with what came late; days without late rows are not touched."""
    _, in_time, behind = late_stream(t)
    kind = "event_id long, user_id long, ts timestamp_ntz, value decimal(14,2)"
    rows, missed = (t.spark.read.schema(kind).parquet(folder) for folder in (in_time, behind))
    rows, missed = (df.withColumn("day", F.col("ts").cast("date")) for df in (rows, missed))
    measures = {"events": F.count(F.lit(1)), "amount": total_cents(cents("value"))}
    closed = rows.groupBy("day").agg(*[c.alias(n) for n, c in measures.items()])
    return late.repaired(closed, rows, missed, "day", measures)


# ---- metrics -----------------------------------------------------------------

COUNTER_CTE = """
steps AS (
  SELECT event_id, event_type, ts, CAST(value AS DECIMAL(14,2)) AS value, LAG(CAST(value AS DECIMAL(14,2))) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS before FROM events
),
inc AS (SELECT *, CASE WHEN before IS NULL THEN NULL WHEN value >= before THEN value - before ELSE value END AS increase FROM steps)
"""


def counters_of(t):
    return t.events.select("event_id", "event_type", "ts", cents("value").alias("value"))


@query(
    "v16_counter_rate",
    f"""
    WITH {COUNTER_CTE}
    SELECT event_id, CAST(SUM(increase) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW) AS DECIMAL(20,2)) AS increase_in_range
    FROM inc
    """,
)
def _(t):
    """Increase over the last hour of each event type's value, read as a counter that may restart."""
    rated = metrics.counter_rate(counters_of(t), ["event_type"], "ts", "value", "event_id", 3600)
    return rated.select("event_id", from_cents("increase_in_range", 20).alias("increase_in_range"))


@query(
    "v16_tumbling_increase",
    f"""
    WITH {COUNTER_CTE}
    SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, CAST(SUM(increase) AS DECIMAL(20,2)) AS increase FROM inc GROUP BY 1, 2
    """,
)
def _(t):
    stepped = metrics.counter_increase(counters_of(t), ["event_type"], "ts", "value", "event_id")
    summed = metrics.tumbling_increase(stepped, ["event_type"], "ts", "1 hour")
    return summed.select("event_type", "window_start", from_cents("increase", 20).alias("increase"))


@query(
    "v17_gauge_ratio",
    """
    WITH w AS (SELECT user_id, CAST(ts AS DATE) AS day, MAX(CASE WHEN event_type = 'error' THEN value END) AS error, MAX(CASE WHEN event_type = 'view' THEN value END) AS view
               FROM events GROUP BY 1, 2)
    SELECT user_id, day, ROUND(CASE WHEN view <> 0 THEN error * 100 / view END, 4) AS error_pct, COALESCE(CASE WHEN view <> 0 THEN error * 100 / view END > 80, FALSE) AS over_limit FROM w
    """,
)
def _(t):
    """One metric as a percentage of another per instance and day, and whether it passes 80."""
    samples = t.events.select("user_id", F.col("ts").cast("date").alias("day"), F.col("event_type").alias("metric"), "value")
    ratio = metrics.percent(F.col("error"), F.col("view"))
    return metrics.wide(samples, ["user_id", "day"], ["error", "view"]).select(
        "user_id", "day", F.round(ratio, 4).alias("error_pct"), F.coalesce(ratio > 80, F.lit(False)).alias("over_limit")
    )


@query(
    "v18_alert_hold_time",
    """
    WITH s AS (SELECT event_type, ts, event_id, value > 10 AS broken FROM events),
    i AS (SELECT *, SUM(CASE WHEN broken THEN 0 ELSE 1 END) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM s),
    g AS (SELECT event_type, MIN(ts) AS started_at, MAX(ts) AS ended_at, COUNT(*) AS samples FROM i WHERE broken GROUP BY event_type, island)
    SELECT * FROM g WHERE date_sub('second', started_at, ended_at) >= 3600
    """,
)
def _(t):
    """Stretches of at least an hour in which every sample of a series was above 10."""
    samples = t.events.select("event_type", "ts", "event_id", (F.col("value") > 10).alias("broken"))
    return metrics.held(samples, ["event_type"], "ts", "event_id", "broken", F.lit(3600))


RULES = [
    ("value_high", "purchase", ">", 60.0, 600, "warning"),
    ("value_very_high", "purchase", ">", 120.0, 60, "critical"),
    ("value_low", "click", "<", 20.0, 1800, "warning"),
]


@query(
    "v18_alert_rules",
    """
    WITH rules(rule, metric, op, threshold, hold, severity) AS (VALUES ('value_high', 'purchase', '>', 60.0, 600, 'warning'),
      ('value_very_high', 'purchase', '>', 120.0, 60, 'critical'), ('value_low', 'click', '<', 20.0, 1800, 'warning')),
    s AS (SELECT rule, severity, hold, ts, event_id, CASE WHEN op = '>' THEN value > threshold ELSE value < threshold END AS broken
          FROM events JOIN rules ON metric = event_type),
    i AS (SELECT *, SUM(CASE WHEN broken THEN 0 ELSE 1 END) OVER (PARTITION BY rule ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM s),
    g AS (SELECT rule, severity, hold, MIN(ts) AS started_at, MAX(ts) AS ended_at, COUNT(*) AS samples FROM i WHERE broken GROUP BY rule, severity, hold, island)
    SELECT rule, severity, started_at, ended_at, samples FROM g WHERE date_sub('second', started_at, ended_at) >= hold
    """,
)
def _(t):
    """Warning and critical rules kept as rows of a table, each with its own hold time."""
    samples = t.events.select("ts", "event_id", F.col("event_type").alias("metric"), "value")
    judged = metrics.breaches(samples, metrics.rules_table(t.spark, RULES))
    return metrics.held(judged, ["rule", "severity"], "ts", "event_id", "broken", F.col("hold_seconds"))


@query(
    "v19_lag_severity",
    f"""
    WITH l AS (SELECT user_id, date_sub('second', MAX(ts), TIMESTAMP '{EVENTS_END}') // 600 AS lag FROM events GROUP BY 1)
    SELECT user_id, lag, CASE WHEN lag = 0 THEN 'in sync' WHEN lag < 30 THEN 'minor' WHEN lag < 120 THEN 'moderate' ELSE 'critical' END AS severity,
           CASE WHEN lag >= 120 THEN 2 WHEN lag >= 30 THEN 1 ELSE 0 END AS exit_level FROM l
    """,
)
def _(t):
    """Severity bands of the lag per user, counted in units of ten minutes to meet all of them."""
    lagging = changes.source_lag(t.events, "user_id", "ts", dates.instant(EVENTS_END))
    lag = F.floor(F.col("lag_seconds") / 600).alias("lag")
    return lagging.select("user_id", lag).select(
        "user_id", "lag", rules.lag_severity(F.col("lag")).alias("severity"), rules.exit_level(F.col("lag")).alias("exit_level")
    )


# ---- streams -----------------------------------------------------------------


@query(
    "v20_typed_stream_to_files",
    "SELECT event_id, event_type, CAST(value AS DECIMAL(14,2)) AS value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def _(t):
    """Messages of a stream decoded to typed rows and appended to files."""
    body = F.to_json(F.struct("event_id", "event_type", money("value").alias("value"), F.get_json_object("props", "$.k").cast("long").alias("k")))
    messages = event_stream(t).select(body.alias("value"))
    typed = topics.decode_json(messages, "event_id long, event_type string, value decimal(14,2), k long")
    root = new_folder(t.spark, "typed")
    readmodel.run_to_files(typed, f"{root}/rows", f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/rows")


@query(
    "s8_stream_upsert",
    "SELECT event_id, user_id, event_type, CAST(value AS DECIMAL(14,2)) AS value, CAST(ts AS DATE) AS day FROM events",
)
def _(t):
    """The stream upserted into a table partitioned by day, every event coming twice."""
    root = new_folder(t.spark, "upsert")
    rows = event_stream(t).select(
        "event_id", "user_id", "event_type", money("value").alias("value"), F.col("ts").cast("date").alias("day"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"),
    )
    sinks.run(rows, sinks.upsert_writer(f"{root}/table", ["event_id"], "day", ["copy"]), f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/table").drop("copy")


@query(
    "s8_late_rows",
    """
    SELECT user_id, event_id, ts, user_id % 4 AS part FROM events
    QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def _(t):
    """The newest event per user, though the older half of the events arrives last."""
    path = f"{new_folder(t.spark, 'late')}/table"
    rows = t.events.select("user_id", "event_id", "ts", F.pmod("user_id", F.lit(4)).alias("part"))
    middle = t.events.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    for batch, half in enumerate([F.col("event_id") > middle, F.col("event_id") <= middle]):
        sinks.upsert_writer(path, ["user_id"], "part", ["ts", "event_id"])(rows.filter(half), batch)
    return t.spark.read.parquet(path).select("user_id", "event_id", "ts", F.col("part").cast("long").alias("part"))


@query(
    "v7_routed_stream",
    """
    SELECT CASE WHEN event_type = 'click' OR (event_type = 'view' AND event_id % 10 <> 0) THEN event_type ELSE 'dead' END AS destination, COUNT(*) AS messages FROM events GROUP BY 1
    """,
)
def _(t):
    """One topic for several tables: what is listed, readable and has its key goes to its table, all else to the dead letters."""
    root = new_folder(t.spark, "routed")
    row = StructType([StructField("event_id", LongType())])
    keyed = F.when((F.col("event_type") != "view") | (F.col("event_id") % 10 != 0), F.col("event_id"))
    image = F.struct(F.struct(F.lit("c").alias("op"), F.struct(keyed.alias("event_id")).alias("after"), F.struct(F.col("event_type").alias("table")).alias("source"), F.lit(1).alias("ts_ms")).alias("payload"))
    text_of = F.when(F.col("event_type") == "error", F.concat(F.lit("{broken "), F.col("event_id").cast("string"))).otherwise(F.to_json(image))
    messages = event_stream(t).select(text_of.alias("value"))

    def writer(name):
        return lambda rows, batch: rows.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch}")

    tables = {name: (row, ["event_id"], writer(name)) for name in ("click", "view")}
    sinks.run(messages, sinks.route_writer(tables, f"{root}/dead"), f"{root}/checkpoint")
    counts = [
        t.spark.read.schema("event_id long").parquet(f"{root}/{name}").agg(F.count(F.lit(1)).alias("messages")).withColumn("destination", F.lit(name))
        for name in tables
    ]
    dead = t.spark.read.text(f"{root}/dead").agg(F.count(F.lit(1)).alias("messages")).withColumn("destination", F.lit("dead"))
    return reduce(DataFrame.unionByName, [*counts, dead]).select("destination", "messages")


@query(
    "v14_expiring_keys_stream",
    """
    SELECT idempotency_key, event_id, verdict FROM (
      SELECT user_id || ':' || event_type AS idempotency_key, event_id, 1 AS x, CASE
        WHEN ROW_NUMBER() OVER w = 1 THEN 'first'
        WHEN sha256(CAST(CAST(floor(value / 10) AS BIGINT) AS VARCHAR)) <> FIRST_VALUE(sha256(CAST(CAST(floor(value / 10) AS BIGINT) AS VARCHAR))) OVER w THEN 'mismatch'
        ELSE 'replay' END AS verdict
      FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id))
    """,
)
def _(t):
    """On a stream, with keys that live for the whole month."""
    root = new_folder(t.spark, "settled")
    empty = requests_of(t).limit(0)
    expiry = 40 * 24 * 3600
    openings = idempotency.openings_table(t.spark, f"{root}/openings", "idempotency_key", "ts", "event_id", empty, expiry)
    writer = idempotency.settle_writer(
        openings, f"{root}/verdicts", "idempotency_key", "ts", "event_id", "request_hash", expiry
    )
    sinks.run(requests_of(t, event_stream(t)), writer, f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/verdicts").select("idempotency_key", "event_id", "verdict")


@query(
    "v18_alerts_stream",
    """
    WITH s AS (SELECT event_type, ts, event_id, value > 10 AS broken FROM events),
    i AS (SELECT *, SUM(CASE WHEN broken THEN 0 ELSE 1 END) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM s),
    g AS (SELECT event_type, island, MIN(ts) AS started_at FROM i WHERE broken GROUP BY event_type, island)
    SELECT g.event_type, started_at, MIN(i.ts) AS fired_at FROM g JOIN i ON i.event_type = g.event_type AND i.island = g.island AND i.broken
      AND i.ts >= started_at + INTERVAL 1 HOUR GROUP BY g.event_type, started_at
    """,
)
def _(t):
    """Alerts of the stream: when each breach had lasted an hour."""
    root = new_folder(t.spark, "alerts")
    samples = event_stream(t).select("event_type", "ts", "event_id", (F.col("value") > 10).alias("broken"))
    empty = t.spark.createDataFrame([], "event_type string, since timestamp_ntz, reported boolean, seen_at timestamp_ntz")
    state = metrics.breaches_table(t.spark, f"{root}/state", ["event_type"], empty)
    writer = metrics.alert_writer(state, f"{root}/fired", ["event_type"], "ts", "event_id", "broken", 3600)
    sinks.run(samples, writer, f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/fired").select("event_type", "started_at", "fired_at")


@query(
    "v21_read_model_stream",
    "SELECT user_id, COUNT(*) AS events, CAST(SUM(CAST(value AS DECIMAL(14,2))) AS DECIMAL(20,2)) AS amount FROM events GROUP BY 1",
)
def _(t):
    """Totals per user kept up to date batch by batch."""
    root = new_folder(t.spark, "totals")
    measures = {"events": F.count(F.lit(1)), "amount": total_cents(cents("value"))}
    table = readmodel.totals_table(t.spark, f"{root}/table", ["user_id"], measures)
    table.run(event_stream(t), f"{root}/checkpoint")
    return table.read()


WINDOWS_SQL = "SELECT user_id, time_bucket(INTERVAL 1 MINUTE, ts) AS window_start, COUNT(*) AS requests FROM events GROUP BY 1, 2"


@query("v22_request_counter", WINDOWS_SQL)
def _(t):
    return readmodel.window_counts(t.events, "user_id", "ts", "1 minute")


@query("v22_request_counter_stream", WINDOWS_SQL)
def _(t):
    """The same kept up to date batch by batch: no window waits for a watermark, however late its events are."""
    root = new_folder(t.spark, "counter")
    table = readmodel.totals_table(t.spark, f"{root}/table", ["user_id", "window_start"], {"requests": F.count(F.lit(1))})
    minute = F.window(F.col("ts").cast("timestamp"), "1 minute")["start"].cast("timestamp_ntz")
    table.run(event_stream(t).withColumn("window_start", minute), f"{root}/checkpoint")
    return table.read()
