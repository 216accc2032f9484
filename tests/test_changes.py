"""Change data, streams, outbox, idempotency, metrics."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from orderloom.session import new_folder
from orderloom.sources import topics
from orderloom.streaming import changes, idempotency, late, metrics, outbox, readmodel, sinks

ROW = StructType([StructField("id", LongType()), StructField("name", StringType())])
LOG = "id long, name string, op string, ts_ms long, pos long"
EVENTS = [
    (1, "a", "c", 10, 1), (2, "b", "c", 10, 2), (1, "a2", "u", 20, 3), (2, "b", "d", 30, 4),
    (3, "c", "r", 30, 5), (1, "a3", "u", 30, 6), (2, "b2", "c", 40, 7), (3, "c", "d", 50, 8),
]


def brute_state(events):
    state = {}
    for id_, name, op, ts, pos in sorted(events, key=lambda e: (e[3], e[4])):
        state[id_] = (name, op == "d", ts, pos)
    return state


def as_dict(state):
    return {r.id: (r.name, r.is_deleted, r.ts_ms, r.pos) for r in state.collect()}


@pytest.fixture
def log(spark):
    return spark.createDataFrame(EVENTS, LOG)


def test_state_does_not_depend_on_order_or_repeats(spark, log):
    empty = log.limit(0).select("id", "name")
    for shuffle in range(3):
        events = EVENTS + EVENTS[2:5]
        random.Random(shuffle).shuffle(events)
        state = empty
        for part in (events[:4], events[4:7], events[7:]):
            state = changes.apply_changes(state, spark.createDataFrame(part, LOG), ["id"])
        assert as_dict(state) == brute_state(EVENTS)


def test_an_old_change_does_not_revive_a_deleted_row(spark, log):
    gone = changes.apply_changes(log.limit(0).select("id", "name"), log, ["id"])
    late = spark.createDataFrame([(3, "late", "u", 45, 7)], LOG)
    assert as_dict(changes.apply_changes(gone, late, ["id"]))[3][1] is True


def test_replay_stops_before_the_point(log):
    empty = log.limit(0).select("id", "name")
    alive = lambda **k: sorted((r.id, r.name) for r in changes.replay(empty, log, ["id"], **k).collect())
    assert alive(stop=30) == [(1, "a2"), (2, "b")]
    assert alive(stop=31) == [(1, "a3"), (3, "c")]
    assert alive(stop=6, column="pos") == [(1, "a2"), (3, "c")]
    assert alive() == [(1, "a3"), (2, "b2")]
    snapshot = changes.replay(empty, log, ["id"], stop=5, column="pos")
    rest = changes.log_between(log, start=5)
    assert sorted((r.id, r.name) for r in changes.replay(snapshot, rest, ["id"]).collect()) == alive()


def test_bootstrap_modes(spark, log):
    snapshot = changes.replay(log.limit(0).select("id", "name"), log, ["id"], stop=5, column="pos")
    state, behind = changes.bootstrap(snapshot, log, "initial", 30, 4)
    assert (state.count(), behind.count()) == (1, 4)
    assert as_dict(changes.apply_changes(state, behind, ["id"]))[1] == ("a3", False, 30, 6)
    assert changes.bootstrap(snapshot, log, "schema_only", 30, 4)[0].isEmpty()
    empty, all_of_it = changes.bootstrap(snapshot, log, "never", 30, 4)
    assert empty.isEmpty() and all_of_it.count() == len(EVENTS)
    with pytest.raises(ValueError):
        changes.bootstrap(snapshot, log, "sometimes", 0, 0)


def message(op, before, after, wrapped=True, table="t"):
    body = {"op": op, "before": before, "after": after, "source": {"db": "d", "table": table, "ts_ms": 5, "gtid": "g:1", "pos": 9}, "ts_ms": 6}
    return json.dumps({"payload": body} if wrapped else body)


def test_decoding_and_dead_letters(spark):
    good = [message("c", None, {"id": 1, "name": "x"}), message("d", {"id": 2, "name": "y"}, None, False), message("r", None, {"id": 3, "name": None}, table="other")]
    bad = ["not json", "{}", message("x", None, {"id": 4, "name": "z"}), message("u", {"id": 5, "name": "q"}, None), good[0][:50]]
    messages = spark.createDataFrame([(v,) for v in good + bad + [None]], "value string")
    parsed = changes.parse_envelopes(messages, ROW)
    assert sorted(r.raw for r in changes.dead_letters(parsed).collect()) == sorted(bad)
    rows = sorted(tuple(r) for r in changes.change_rows(changes.of_table(parsed, "t")).collect())
    assert rows == [(1, "x", "c", 5, 9), (2, "y", "d", 5, 9)]


def test_unwrapped_records(spark):
    values = [
        json.dumps({"id": 1, "name": "x", "__op": "c", "__table": "t", "__ts_ms": 7, "__deleted": "false"}),
        json.dumps({"id": 1, "name": "x", "__op": "d", "__table": "t", "__ts_ms": 8, "__deleted": "true"}),
        None,
    ]
    values += ["not json", "{}", json.dumps({"id": 2, "name": "y", "__op": "u", "__ts_ms": 8, "__source_pos": 4})]
    messages = spark.createDataFrame([(v,) for v in values], "value string")
    assert sorted(tuple(r) for r in changes.unwrapped_rows(messages, ROW).collect()) == [
        (1, "x", "c", 7, 0), (1, "x", "d", 8, 0), (2, "y", "u", 8, 4),
    ]
    assert sorted(r.raw for r in changes.unwrapped_dead_letters(messages, ROW).collect()) == ["not json", "{}"]


def test_unwrapped_records_of_wrong_types_and_without_keys(spark):
    good, lost = json.dumps({"id": 1, "name": "x", "__op": "c"}), [json.dumps({"id": "abc", "name": "x", "__op": "c"}), json.dumps({"name": "x", "__op": "c"})]
    messages = spark.createDataFrame([(v,) for v in [good, *lost]], "value string")
    assert [r.id for r in changes.unwrapped_rows(messages, ROW, keys=["id"]).collect()] == [1]
    assert sorted(r.raw for r in changes.unwrapped_dead_letters(messages, ROW, keys=["id"]).collect()) == sorted(lost)


def test_changes_without_a_key(spark):
    lost = message("c", None, {"id": None, "name": "x"})
    parsed = changes.parse_envelopes(spark.createDataFrame([(lost,)], "value string"), ROW, keys=["id"])
    assert [r.raw for r in changes.dead_letters(parsed).collect()] == [lost]
    state = spark.createDataFrame([(1, "a")], "id long, name string")
    nothing = spark.createDataFrame([(None, "x", "c", 1, 1)], "id long, name string, op string, ts_ms long, pos long")
    assert [r.id for r in changes.apply_changes(state, nothing, ["id"]).collect()] == [1]


def file_stream(spark, frames, schema):
    """A stream that takes one of the frames per batch."""
    path = new_folder(spark, "input")
    for df in frames:
        df.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_streamed_changes_equal_the_batch(spark, log):
    parts = [spark.createDataFrame(EVENTS[i : i + 3], LOG) for i in (6, 0, 3)]
    path = new_folder(spark, "stream")
    table = changes.change_table(spark, f"{path}/t", ["id"], log.limit(0).select("id", "name"))
    assert table.read().isEmpty()
    table.run(file_stream(spark, parts, log.schema), f"{path}/checkpoint")
    assert as_dict(table.read()) == brute_state(EVENTS)
    table.compact()
    assert as_dict(table.read()) == brute_state(EVENTS)
    before = as_dict(table.read(before=2))
    table.compact()
    assert as_dict(table.read(before=2)) == before  # what the newest batch found is still there
    table.write_batch(parts[2], 2)  # the newest batch, run again
    assert as_dict(table.read()) == brute_state(EVENTS)
    table.write_batch(spark.createDataFrame([(1, "new", "u", 99, 99)], LOG), 3)
    assert as_dict(table.read())[1] == ("new", False, 99, 99)


def test_streamed_totals_count_a_repeated_batch_once(spark):
    parts = [spark.createDataFrame([(1, 5), (2, 1)], "k int, v long"), spark.createDataFrame([(1, 7)], "k int, v long")]
    path = new_folder(spark, "totals")
    table = readmodel.totals_table(spark, f"{path}/t", ["k"], {"n": F.count(F.lit(1)), "s": F.sum("v")})
    table.run(file_stream(spark, parts, parts[0].schema), f"{path}/checkpoint")
    expected = {(1, 2, 12), (2, 1, 1)}
    read = lambda: {tuple(r) for r in table.read().collect()}
    assert read() == expected
    one = spark.read.parquet(f"{path}/t/batches").filter("batch = 1").count()
    table.write_batch(parts[1] if one == 1 else parts[0], 1)
    assert read() == expected
    table.compact()
    assert read() == expected


def test_dead_letters_of_a_stream(spark):
    values = spark.createDataFrame([(message("c", None, {"id": 1, "name": "x"}),), ("broken",)], "value string")
    path = new_folder(spark, "dlq")
    taken = []
    writer = changes.dead_letter_writer(f"{path}/dead", lambda df, _: taken.extend(df.collect()))
    parsed = changes.parse_envelopes(file_stream(spark, [values], values.schema), ROW)
    parsed.writeStream.foreachBatch(writer).option("checkpointLocation", f"{path}/c").trigger(availableNow=True).start().awaitTermination()
    assert [r.id for r in taken] == [1]
    assert [r.value for r in spark.read.text(f"{path}/dead").select("value").collect()] == ["broken"]


def test_tables_of_one_stream_go_their_own_ways(spark):
    other = StructType([StructField("sku", StringType())])
    lost = [message("c", None, {"q": 1}, table="unknown"), "broken", message("x", None, {"id": 3, "name": "y"}), message("c", None, {"name": "keyless"})]
    values = [message("c", None, {"id": 1, "name": "x"}), message("c", None, {"sku": "s"}, table="items"), *lost, None]
    messages = spark.createDataFrame([(v,) for v in values], "value string")
    path = new_folder(spark, "routed")
    people = changes.change_table(spark, f"{path}/t", ["id"], spark.createDataFrame([], ROW))
    items = changes.change_table(spark, f"{path}/items", ["sku"], spark.createDataFrame([], other))
    writer = sinks.route_writer({"t": (ROW, ["id"], people.write_batch), "items": (other, ["sku"], items.write_batch)}, f"{path}/dead")
    sinks.run(file_stream(spark, [messages], messages.schema), writer, f"{path}/checkpoint")
    assert [(r.id, r.name) for r in people.read().collect()] == [(1, "x")]
    assert [r.sku for r in items.read().collect()] == ["s"]
    assert sorted(r.value for r in spark.read.text(f"{path}/dead").collect()) == sorted(lost)


def test_stream_upserts_leave_other_partitions_alone(spark):
    parts = [spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id int, v string, p int"), spark.createDataFrame([(2, "B", 1), (3, "c", 2)], "id int, v string, p int")]
    path = new_folder(spark, "upserted")
    sinks.run(file_stream(spark, parts, parts[0].schema), sinks.upsert_writer(f"{path}/t", ["id"], "p", ["v"]), f"{path}/checkpoint")
    found = {r.id: r.v for r in spark.read.parquet(f"{path}/t").collect()}
    assert found[1] == "a" and found[3] == "c" and len(found) == 3


def outbox_rows(spark, n):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, "order", str(i % 3), "OrderCreated" if i % 2 else "OrderPaid", "{}", "pending", None, 0, start + dt.timedelta(seconds=n - i)) for i in range(n)]
    return spark.createDataFrame(
        rows,
        "id long, aggregate_type string, aggregate_id string, event_type string, payload string, status string, "
        "published_at timestamp_ntz, retry_count int, created_at timestamp_ntz",
    )


def test_outbox(spark):
    path = new_folder(spark, "outbox")
    table = outbox.OutboxLog(spark, path, grace_seconds=2)
    table.insert(outbox_rows(spark, 7))
    now, sent = F.lit("2024-06-01").cast("timestamp_ntz"), []

    def broken(messages):
        raise ConnectionError("no broker")

    def publish(messages):
        sent.extend(int(r.key) for r in messages.collect())

    assert table.drain(broken, now, 3) == 3
    states = {r.id: (r.status, r.retry_count) for r in table.read().collect()}
    assert states == {i: ("failed", 1) if i > 3 else ("pending", 0) for i in range(7)}  # the last ids are the oldest
    assert table.drain(publish, now, 3) == 3
    assert table.requeue(now) == 3
    late = outbox_rows(spark, 8).filter("id = 7").withColumn("created_at", F.lit(None).cast("timestamp_ntz"))
    table.insert(late)
    assert [table.drain(publish, now, 3) for _ in range(3)] == [3, 2, 0]
    assert len(sent) == 8 and table.read().filter("status <> 'published'").isEmpty()
    assert table.read().filter("retry_count = 1").count() == 3 and table.requeue(now) == 0
    table.compact()
    assert table.read().count() == 8 and table.drain(publish, now, 3) == 0
    table.compact(purge_before=F.lit("2024-07-01").cast("timestamp_ntz"))
    assert table.read().isEmpty()


def test_draining_writes_what_the_batch_has(spark):
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    many = spark.range(200_000).select(
        "id", F.lit("order").alias("aggregate_type"), F.lit("1").alias("aggregate_id"), F.lit("OrderPaid").alias("event_type"), F.lit("{}").alias("payload"),
        F.lit("pending").alias("status"), F.lit(None).cast("timestamp_ntz").alias("published_at"), F.lit(0).alias("retry_count"),
        (start + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("created_at"),
    )
    path = new_folder(spark, "outbox")
    table = outbox.OutboxLog(spark, path)
    table.insert(many)
    for _ in range(2):
        assert table.drain(lambda messages: None, start, 100) == 100
    assert spark.read.parquet(f"{path}/outcomes").count() == 200
    assert spark.read.json(f"{path}/base/versions").count() == 1


HOUR = 3600


def request_rows(spark, hours):
    start = dt.datetime(2024, 1, 1)
    rows = [(k, start + dt.timedelta(hours=h), i, digest) for i, (k, h, digest) in enumerate(hours)]
    return spark.createDataFrame(rows, "key string, at timestamp, seq int, hash string")


REQUESTS = [("a", 0, "x"), ("a", 1, "x"), ("a", 23.9, "y"), ("a", 24, "y"), ("a", 30, "y"), ("a", 48.5, "z"), ("b", 5, "x")]
VERDICTS = ["first", "replay", "mismatch", "first", "replay", "first", "first"]


def test_requests_settled_over_a_history(spark):
    rows = request_rows(spark, REQUESTS)
    exact = idempotency.settle_requests(rows, "key", "at", "seq", "hash")
    assert [r.verdict for r in exact.orderBy("seq").collect()] == VERDICTS
    simple = idempotency.first_results(rows, "key", "at", "seq", "hash")
    assert [r.verdict for r in simple.orderBy("seq").collect()] == ["first", "replay", "mismatch", "expired", "expired", "expired", "first"]


def run_stream(stream, spark):
    path = new_folder(spark, "out")
    stream.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/c").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/rows")


def test_requests_settled_on_a_stream(spark):
    rows = request_rows(spark, REQUESTS)
    parts = [rows.filter(c) for c in ("seq < 3", "seq IN (3, 6)", "seq IN (4, 5)")]
    path = new_folder(spark, "settled")
    openings = idempotency.openings_table(spark, f"{path}/openings", "key", "at", "seq", rows.limit(0))
    writer = idempotency.settle_writer(openings, f"{path}/verdicts", "key", "at", "seq", "hash")
    sinks.run(file_stream(spark, parts, rows.schema), writer, f"{path}/checkpoint")
    verdicts = lambda: [r.verdict for r in spark.read.parquet(f"{path}/verdicts").orderBy("seq").collect()]
    assert verdicts() == VERDICTS
    writer(parts[1], 1)  # run again
    assert verdicts() == VERDICTS


def settled_by_hand(rows, expiry):
    """rows (key, at, seq, hash) -> seq: verdict, one after the other."""
    opened, out = {}, {}
    for key, at, seq, digest in sorted(rows, key=lambda r: (r[1], r[2])):
        first = opened.get(key)
        if key is None or first is None or (at - first[0]).total_seconds() >= expiry:
            opened[key], out[seq] = (at, digest), "first"
        else:
            out[seq] = "replay" if first[1] == digest else "mismatch"
    return out


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_settling_follows_the_rule(spark, hot_rows):
    rnd, start = random.Random(2), dt.datetime(2024, 1, 1)
    rows = [(rnd.choice(["a", "a", "a", "b", "c", None]), start + dt.timedelta(seconds=rnd.randint(0, 400)), i, rnd.choice("xy")) for i in range(300)]
    df = spark.createDataFrame(rows, "key string, at timestamp, seq int, hash string").repartition(4)
    found = idempotency.settle_requests(df, "key", "at", "seq", "hash", 10, hot_rows).collect()
    assert {r.seq: r.verdict for r in found} == settled_by_hand(rows, 10) and len(found) == 300


def test_many_lifetimes_take_few_rounds(spark, monkeypatch):
    cuts, plain = [], idempotency.cut
    monkeypatch.setattr(idempotency, "cut", lambda df, label: (cuts.append(label), plain(df, label))[1])
    df = spark.range(10_000).select(F.lit("k").alias("key"), F.timestamp_seconds(F.col("id") * 60).alias("at"), F.col("id").alias("seq"), F.lit("h").alias("hash"))
    assert idempotency.settle_requests(df, "key", "at", "seq", "hash", 60).filter("verdict = 'first'").count() == 10_000
    assert len(cuts) <= 16


def test_expired_openings_leave_the_table(spark):
    rows = request_rows(spark, [("a", 0, "x"), ("b", 23, "x"), ("c", 40, "x"), ("d", 41, "x")])
    openings = idempotency.openings_table(spark, new_folder(spark, "openings"), "key", "at", "seq", rows.limit(0))
    for batch in range(4):
        openings.write_batch(rows.filter(F.col("seq") == batch), batch)
    openings.compact()
    assert sorted(r.key for r in openings.base.read().collect()) == ["b", "c"]
    assert sorted(r.key for r in openings.read().collect()) == ["b", "c", "d"]


def test_late_rows_are_set_aside(spark):
    start = dt.datetime(2024, 1, 1)
    parts = [[(1, 0), (2, 100)], [(3, 95), (4, 90), (5, 89), (6, None), (7, 200)], [(8, 189), (9, 190)]]
    frames = [spark.createDataFrame([(i, None if s is None else start + dt.timedelta(seconds=s)) for i, s in p], "id int, at timestamp") for p in parts]
    path = new_folder(spark, "late")
    marks = late.marks_table(spark, f"{path}/marks", "at")
    write = late.split_writer(marks, f"{path}/in", f"{path}/late", "at", 10)
    ids = lambda folder: sorted(r.id for r in spark.read.parquet(f"{path}/{folder}").collect())
    sinks.run(file_stream(spark, frames, frames[0].schema), write, f"{path}/checkpoint")
    for _ in range(2):
        assert ids("late") == [5, 6, 8] and ids("in") == [1, 2, 3, 4, 7, 9]
        write(frames[1], 1)  # run again
    marks.compact()
    assert marks.base.read().count() == 1 == marks.read().count()


def test_only_touched_groups_are_repaired(spark):
    rows, missed = spark.createDataFrame([(1, 5), (2, 7)], "g int, v long"), spark.createDataFrame([(2, 1), (3, 1)], "g int, v long")
    closed = spark.createDataFrame([(1, 99), (2, 7)], "g int, total long")  # 99 shows that group 1 is not touched
    out = late.repaired(closed, rows, missed, "g", {"total": F.sum("v")})
    assert sorted(tuple(r) for r in out.collect()) == [(1, 99, 0), (2, 8, 1), (3, 1, 1)]


def test_repeats_dropped_on_a_stream(spark):
    rows = request_rows(spark, [("a", 0, "x"), ("b", 0, "x"), ("a", 1, "x")])
    stream = file_stream(spark, [rows.filter("seq < 2"), rows.filter("seq = 2")], rows.schema)
    assert sorted(r.key for r in run_stream(idempotency.stream_first(stream, "key", "at"), spark).collect()) == ["a", "b"]


def sample_rows(spark, values, step=60):
    start = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([("i1", start + dt.timedelta(seconds=step * n), n, float(v)) for n, v in enumerate(values)], "instance string, ts timestamp, seq int, value double")


def test_counter_restart(spark):
    samples = sample_rows(spark, [10, 15, 3, 4]).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    rated = metrics.counter_rate(samples, ["instance"], "ts", "value", "seq", 120).orderBy("seq").collect()
    assert [r.increase for r in rated] == [None, 5.0, 3.0, 1.0]
    assert [r.increase_in_range for r in rated] == [None, 5.0, 8.0, 9.0]
    assert rated[3].rate == 9 / 120


BROKEN = [0, 1, 1, 1, 0, 1, 0, 1, 1, 1, 1]


def test_alerts_fire_after_the_hold_time(spark):
    states = sample_rows(spark, BROKEN).withColumn("broken", F.col("value") > 0)
    batch = metrics.held(states, ["instance"], "ts", "seq", "broken", F.lit(120)).orderBy("started_at").collect()
    assert [(r.started_at.minute, r.ended_at.minute, r.samples) for r in batch] == [(1, 3, 3), (7, 10, 4)]
    expected = [(1, 3), (7, 9)]
    for cuts in [("seq < 3", "seq BETWEEN 3 AND 7", "seq > 7"), ("seq < 4", "seq = 4", "seq BETWEEN 5 AND 9", "seq = 10"), ("seq >= 0",)]:
        parts = [states.filter(c) for c in cuts]
        path = new_folder(spark, "alerts")
        empty = spark.createDataFrame([], "instance string, since timestamp, reported boolean, seen_at timestamp")
        table = metrics.breaches_table(spark, f"{path}/state", ["instance"], empty)
        writer = metrics.alert_writer(table, f"{path}/fired", ["instance"], "ts", "seq", "broken", 120)
        sinks.run(file_stream(spark, parts, states.schema), writer, f"{path}/checkpoint")
        fired = lambda: [(r.started_at.minute, r.fired_at.minute) for r in spark.read.parquet(f"{path}/fired").orderBy("started_at").collect()]
        assert fired() == expected
        writer(parts[-1], len(parts) - 1)  # run again
        assert fired() == expected


def test_rules_table(spark):
    samples = spark.createDataFrame([("lag_seconds", "i1", v) for v in (30.0, 31.0, 121.0)] + [("io_running", "i1", 0.0)], "metric string, instance string, value double")
    judged = metrics.breaches(samples, metrics.rules_table(spark))
    assert sorted((r.rule, r.value) for r in judged.filter("broken").collect()) == [
        ("io_thread_stopped", 0.0), ("replication_lag_critical", 121.0), ("replication_lag_warning", 31.0), ("replication_lag_warning", 121.0),
    ]


def test_an_unknown_operator_is_an_error(spark):
    samples = spark.createDataFrame([("m", 1.0)], "metric string, value double")
    with pytest.raises(Exception, match="unknown operator"):
        metrics.breaches(samples, metrics.rules_table(spark, [("r", "m", "~", 1.0, 1, "warning")])).collect()


def test_gauges_side_by_side(spark):
    samples = spark.createDataFrame([("i1", "used", 30.0), ("i1", "max", 40.0), ("i2", "used", 1.0), ("i2", "max", 0.0)], "instance string, metric string, value double")
    wide = metrics.wide(samples, ["instance"], ["used", "max"]).withColumn("pct", metrics.percent(F.col("used"), F.col("max")))
    assert {r.instance: r.pct for r in wide.collect()} == {"i1": 75.0, "i2": None}


def test_messages_and_topics(spark):
    df = spark.createDataFrame([(1, None)], "id int, v string")
    row = topics.to_messages(df, F.col("id"), F.lit("t")).first()
    assert (row.key, row.value, row.topic) == ("1", '{"id":1,"v":null}', "t")
    assert topics.topic_name("p", "d", "t") == "p.d.t"
    import re

    pattern = topics.topic_pattern("p", "d", ["orders", "items"])
    assert re.fullmatch(pattern, "p.d.orders") and not re.fullmatch(pattern, "p.d.other")
    back = topics.decode_json(topics.to_messages(df, F.col("id")), "id int, v string")
    assert back.collect() == df.collect()
