"""Upserts, type 1-3 dimensions, diffs: laws and small cases."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderloom.functions.keys import surrogate_key
from orderloom.operators import merge, scd
from orderloom.operators.quality import row_checksums
from orderloom.plans.materialise import materialise
from orderloom.session import cut, new_folder
from orderloom.sources import tables
from orderloom.sources.increments import IncrementTable
from orderloom.sources.snapshots import SnapshotTable, WatermarkStore
from orderloom.sources.tables import merge_partitions, write_by


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, None, 30)], "id int, name string, n int")


@pytest.fixture
def source(spark):
    return spark.createDataFrame([(2, None, 21), (4, "d", 40)], "id int, name string, n int")


def test_upsert_overwrites_listed_columns_even_with_null(target, source):
    all_columns = merge.upsert(target, source, ["id"])
    assert sorted(map(str, all_columns.collect())) == sorted(
        ["Row(id=1, name='a', n=10)", "Row(id=2, name=None, n=21)", "Row(id=3, name=None, n=30)", "Row(id=4, name='d', n=40)"]
    )
    only_n = {r.id: (r.name, r.n) for r in merge.upsert(target, source, ["id"], update=["n"]).collect()}
    assert only_n[2] == ("b", 21) and only_n[4] == ("d", 40)
    nothing = {r.id: (r.name, r.n) for r in merge.upsert(target, source, ["id"], update=[]).collect()}
    assert nothing[2] == ("b", 20) and nothing[4] == ("d", 40)


def test_upsert_is_idempotent(target, source):
    once = merge.upsert(target, source, ["id"])
    assert sorted(map(str, merge.upsert(once, source, ["id"]).collect())) == sorted(map(str, once.collect()))


def test_upsert_reduces_a_repeated_source(spark, target):
    twice = spark.createDataFrame([(1, "x", 1, 5), (1, "y", 2, 6), (1, "z", 3, 4)], "id int, name string, n int, seq int")
    assert [r.name for r in merge.upsert(target, twice, ["id"], latest_by=["seq"]).filter("id = 1").collect()] == ["y"]


def test_additive_and_absent(spark, target):
    more = spark.createDataFrame([(1, 5), (1, 6), (9, 1)], "id int, n int")
    assert rows(merge.additive_upsert(target, more, ["id"], ["n"])) == [(1, 21), (2, 20), (3, 30), (9, 1)]
    new = spark.createDataFrame([(1, "no", 0), (8, "yes", 8)], "id int, name string, n int")
    assert merge.insert_absent(target, new.union(new), ["id"]).count() == merge.insert_absent(target, new, ["id"]).count()
    assert {r.id: r.name for r in merge.insert_absent(target, new, ["id"]).collect()} == {1: "a", 2: "b", 3: None, 8: "yes"}


def test_update_ignores_null_conditions(target):
    assert rows(merge.update_where(target, F.col("name") == "a", {"n": F.lit(0)}), "id", "n") == [(1, 0), (2, 20), (3, 30)]


def test_split_keeps_every_row_once(target):
    keep, archive = merge.split_where(target, F.col("name") == "a")
    assert (keep.count(), archive.count()) == (2, 1)


def test_soft_delete_keeps_the_first_time(spark):
    base = spark.createDataFrame([(1, None), (2, None)], "id int, deleted_at timestamp_ntz")
    first, second = F.lit("2024-01-01").cast("timestamp_ntz"), F.lit("2024-02-01").cast("timestamp_ntz")
    again = merge.soft_delete(merge.soft_delete(base, F.col("id") == 1, first), F.col("id") == 1, second)
    assert rows(again.filter("id = 1"), "deleted_at") == [(dt.datetime(2024, 1, 1),)]
    assert merge.restore(again, F.col("id") == 1).filter("deleted_at IS NOT NULL").isEmpty()


def taken_in_order(stock, asked):
    """(accepted by seq, stock after), one request after the other."""
    left, out = dict(stock), {}
    for key, seq, wanted in sorted(asked, key=lambda r: r[1]):
        out[seq] = wanted is not None and left.get(key) is not None and wanted <= left[key]
        if out[seq]:
            left[key] -= wanted
    return out, left


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_requests_take_what_earlier_ones_left(spark, hot_rows):
    rnd = random.Random(1)
    stock = [("a", 1000), ("b", 7), ("c", 0), ("d", 64), ("e", None), ("f", 3)]
    asked = [(rnd.choice("aaaaabcdegx"), i, rnd.choice([0, 1, 2, 3, 30, 31, 33, 64, 200, 600, None])) for i in range(250)]
    df = spark.createDataFrame(asked, "p string, seq int, wanted long").repartition(3)
    answered, after = merge.guarded_decrement(spark.createDataFrame(stock, "p string, available long"), df, ["p"], "available", "wanted", ["seq"], hot_rows)
    verdicts, left = taken_in_order(stock, asked)
    found = answered.collect()
    assert {r.seq: r.accepted for r in found} == verdicts and len(found) == 250
    assert {r.p: r.available for r in after.collect()} == left


def test_requests_of_keys_that_are_not_hot_take_one_pass(spark, monkeypatch):
    """However many a key has; a chain of requests that never fit would take the rounds many of them."""
    monkeypatch.setattr(merge, "_decrement_in_rounds", None)
    rnd = random.Random(2)
    asked = [(rnd.choice("ab"), i, rnd.randrange(1, 400)) for i in range(400)]
    stock = [("a", 9000), ("b", 100)]
    df = spark.createDataFrame(asked, "p string, seq int, wanted long").repartition(5)
    answered, after = merge.guarded_decrement(spark.createDataFrame(stock, "p string, available long"), df, ["p"], "available", "wanted", ["seq"])
    verdicts, left = taken_in_order(stock, asked)
    assert {r.seq: r.accepted for r in answered.collect()} == verdicts and dict(rows(after)) == left


def test_stock_and_places_that_repeat_go_by_rounds(spark):
    stock = spark.createDataFrame([("a", 9), ("b", 5), ("b", 5), ("c", 4)], "p string, available long")
    asked = spark.createDataFrame([("a", 1, 4), ("a", 1, 4), ("b", 1, 5), ("c", 1, 3), ("c", 2, 2), (None, 1, 1), (None, 1, 1)], "p string, seq int, wanted long")
    answered, _ = merge.guarded_decrement(stock, asked, ["p"], "available", "wanted", ["seq"])
    found = sorted(map(str, answered.select("p", "seq", "accepted").collect()))
    assert len(found) == 8 and [r.accepted for r in answered.filter("p = 'c'").orderBy("seq").collect()] == [True, False]
    assert answered.filter("p IS NULL AND NOT accepted").count() == 2 and answered.filter("p = 'b'").count() == 2


def test_no_requests_leave_the_stock(spark):
    stock = spark.createDataFrame([("a", 5)], "p string, available long")
    none = spark.createDataFrame([], "p string, seq int, wanted long")
    answered, after = merge.guarded_decrement(stock, none, ["p"], "available", "wanted", ["seq"])
    assert answered.isEmpty() and rows(after) == [("a", 5)]


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_transition(spark, hot_rows):
    state = spark.createDataFrame([(1, "pending"), (2, "shipped"), (3, "pending"), (4, None)], "id int, status string")
    asked = spark.createDataFrame([(1, 2), (1, 1), (2, 3), (7, 4), (None, 5), (4, 6)], "id int, seq int")
    answered, after = merge.transition(asked, state, "id", "status", "pending", "confirmed", ["seq"], hot_rows)
    assert [r.verdict for r in answered.orderBy("seq").collect()] == [
        "OK", "INVALID_STATUS:confirmed", "INVALID_STATUS:shipped", "NOT_FOUND", "NOT_FOUND", "INVALID_STATUS:NULL",
    ]
    assert rows(after) == [(1, "confirmed"), (2, "shipped"), (3, "pending"), (4, None)]


DIM = "dim_sk string, nk int, name string, effective_from date, effective_to date, is_current boolean"


def load_three(spark):
    def day(text):
        return F.lit(text)

    snap = lambda *r: spark.createDataFrame(list(r), "nk int, name string")
    dim = scd.scd2_initial(snap((1, "a"), (2, "b"), (3, None)), "nk", day("2024-01-01"))
    dim = scd.scd2_merge(dim, snap((1, "a2"), (2, "b"), (3, "c"), (4, "d")), "nk", ["name"], day("2024-02-01"))
    return scd.scd2_merge(dim, snap((1, "a3"), (2, None), (3, "c"), (4, "d")), "nk", ["name"], day("2024-03-01"))


def test_type_2_history(spark):
    dim = load_three(spark)
    history = {}
    for r in dim.orderBy("nk", "effective_from").collect():
        history.setdefault(r.nk, []).append((r.name, str(r.effective_from), r.effective_to and str(r.effective_to)))
    assert history[1] == [("a", "2024-01-01", "2024-02-01"), ("a2", "2024-02-01", "2024-03-01"), ("a3", "2024-03-01", None)]
    assert history[2] == [("b", "2024-01-01", "2024-03-01"), (None, "2024-03-01", None)]
    assert history[3] == [(None, "2024-01-01", "2024-02-01"), ("c", "2024-02-01", None)]
    assert history[4] == [("d", "2024-02-01", None)]


def test_type_2_laws(spark):
    dim = load_three(spark)
    following = F.lead("effective_from").over(Window.partitionBy("nk").orderBy("effective_from"))
    assert dim.withColumn("f", following).filter("NOT (effective_to <=> f)").isEmpty()
    assert dim.groupBy("nk").agg(F.count_if("is_current").alias("n")).filter("n <> 1").isEmpty()
    assert dim.select("dim_sk").distinct().count() == dim.count()
    same = dim.filter("is_current").select("nk", "name")
    again = scd.scd2_merge(dim, same, "nk", ["name"], F.lit("2024-04-01"))
    assert sorted(map(str, again.collect())) == sorted(map(str, dim.select(*again.columns).collect()))


def test_type_2_missing_keys(spark):
    dim = load_three(spark)
    left = dim.filter("is_current AND nk <> 4").select("nk", "name")
    kept = scd.scd2_merge(dim, left, "nk", ["name"], F.lit("2024-04-01"))
    closed = scd.scd2_merge(dim, left, "nk", ["name"], F.lit("2024-04-01"), close_missing=True)
    assert kept.filter("nk = 4 AND is_current").count() == 1
    assert [str(r.effective_to) for r in closed.filter("nk = 4").collect()] == ["2024-04-01"]


def test_type_3(spark):
    dim = spark.createDataFrame([(1, "x", None, None), (2, "y", "w", dt.date(2023, 1, 1))], "nk int, city string, previous_city string, city_changed_on date")
    snap = spark.createDataFrame([(1, "z"), (2, "y")], "nk int, city string")
    after = scd.scd3_merge(dim, snap, "nk", "city", F.lit("2024-05-01"))
    assert rows(after) == [(1, "z", "x", dt.date(2024, 5, 1)), (2, "y", "w", dt.date(2023, 1, 1))]


def test_diff_leads_from_one_snapshot_to_the_other(target, source):
    after = merge.upsert(target, source, ["id"]).filter("id <> 1")
    audit = scd.diff(target, after, "id", "t")
    assert sorted((r.record_id, r.action) for r in audit.collect()) == [(1, "DELETE"), (2, "UPDATE"), (4, "INSERT")]
    assert sorted(map(str, scd.apply_diff(target, audit, "id").collect())) == sorted(map(str, after.collect()))
    update = audit.filter("action = 'UPDATE'").first()
    assert (update.old_values, update.new_values) == ('{"id":2,"name":"b","n":20}', '{"id":2,"name":null,"n":21}')
    assert scd.diff(target, target, "id", "t").isEmpty()


def test_snapshot_table_reads_while_it_is_rewritten(spark, target, source):
    table = SnapshotTable(spark, new_folder(spark, "t"))
    assert not table.exists()
    table.replace(target)
    table.replace(merge.upsert(table.read(), source, ["id"]), tag="7")
    assert (table.read().count(), table.read(1).count(), table.tag()) == (4, 3, "7")


def test_partitions_not_touched_stay_as_they_are(spark):
    path = new_folder(spark, "parts")
    first = spark.createDataFrame([(1, "a", 2023), (2, "b", 2024)], "id int, v string, y int")
    merge_partitions(first, path, ["id"], "y")
    files = lambda y: sorted(r.f for r in spark.read.parquet(path).filter(F.col("y") == y).select(F.input_file_name().alias("f")).distinct().collect())
    before = files(2023)
    merge_partitions(spark.createDataFrame([(2, "B", 2024), (3, "c", 2024)], "id int, v string, y int"), path, ["id"], "y")
    assert files(2023) == before
    assert rows(spark.read.parquet(path).select("id", "v")) == [(1, "a"), (2, "B"), (3, "c")]


def test_stored_rows_are_not_shuffled_by_partition(spark, monkeypatch):
    path, plans = new_folder(spark, "whole-years"), []
    monkeypatch.setattr(tables, "cut", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df, label))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for v in "ab":
            merge_partitions(spark.createDataFrame([(1, v, 2023), (2, v, 2024)], "id int, v string, y int"), path, ["id"], "y")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(plans) == 1 and "BroadcastHashJoin" in plans[0] and plans[0].count("LeftSemi") == 1 and "SortMergeJoin [coalesce" not in plans[0]
    assert rows(spark.read.parquet(path).select("id", "v")) == [(1, "b"), (2, "b")]


def test_rows_without_a_partition_value_are_kept(spark):
    path, kind = new_folder(spark, "nulls"), "id int, v string, y int"
    merge_partitions(spark.createDataFrame([(1, "a", None), (2, "b", 2024)], kind), path, ["id"], "y")
    merge_partitions(spark.createDataFrame([(3, "c", None), (4, "d", 2024)], kind), path, ["id"], "y")
    assert rows(spark.read.parquet(path).select("id", "v")) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_write_by_replaces_only_what_it_brings(spark):
    path = new_folder(spark, "days")
    write_by(spark.createDataFrame([(1, 1), (2, 2)], "v int, d int"), path, "d")
    write_by(spark.createDataFrame([(9, 2)], "v int, d int"), path, "d")
    assert rows(spark.read.parquet(path).select("v", "d")) == [(1, 1), (9, 2)]


def test_watermarks(spark):
    marks = WatermarkStore(spark, new_folder(spark, "marks"))
    assert marks.get("orders") is None
    marks.put("orders", dt.datetime(2024, 1, 1))
    marks.put("orders", dt.datetime(2024, 1, 2, 3, 4, 5, 678000))
    marks.put("other", dt.datetime(2025, 1, 1))
    assert marks.get("orders") == dt.datetime(2024, 1, 2, 3, 4, 5, 678000)


def test_materialise(spark, target, source):
    root = new_folder(spark, "models")
    assert materialise(target, "v_target", "view").count() == 3
    assert materialise(target, "x", "ephemeral") is target
    assert materialise(target, "t", "table", root).count() == 3
    materialise(target, "inc", "incremental", root, ["id"])
    wider = source.withColumn("extra", F.lit(True))
    grown = materialise(wider, "inc", "incremental", root, ["id"])
    assert {r.id: r.extra for r in grown.collect()} == {1: None, 2: True, 3: None, 4: True}
    with pytest.raises(ValueError):
        materialise(wider.withColumn("more", F.lit(1)), "inc", "incremental", root, ["id"], "fail")
    with pytest.raises(ValueError):
        materialise(target, "x", "sometimes")


def test_evolve(target):
    after = merge.evolve(target, rename={"n": "amount"}, cast={"amount": "decimal(10,2)"}, add={"c": ("string", F.lit("VND"))}, drop=["name"])
    assert after.dtypes == [("id", "int"), ("amount", "decimal(10,2)"), ("c", "string")]


def test_a_late_row_does_not_overwrite_a_newer_one(spark):
    path = f"{new_folder(spark, 'late')}/t"
    for rows in ([(1, "new", 10, 2024)], [(1, "old", 5, 2024), (2, "b", 1, 2024)], [(1, "newest", 11, 2024)]):
        merge_partitions(spark.createDataFrame(rows, "id int, v string, ts int, y int"), path, ["id"], "y", ["ts"])
        if rows[0][1] == "old":
            assert {r.id: r.v for r in spark.read.parquet(path).collect()} == {1: "new", 2: "b"}
    assert {r.id: r.v for r in spark.read.parquet(path).collect()} == {1: "newest", 2: "b"}


def test_two_changes_on_one_day_and_one_from_before(spark):
    rows = lambda name: spark.createDataFrame([(1, name)], "nk int, name string")
    dim = scd.scd2_initial(rows("a"), "nk", F.lit("2024-01-01"))
    for name in ("b", "c"):
        dim = scd.scd2_merge(dim, rows(name), "nk", ["name"], F.lit("2024-02-01"))
    found = dim.collect()
    assert sorted((r.name, r.is_current) for r in found) == [("a", False), ("c", True)]
    assert len({r.dim_sk for r in found}) == 2
    with pytest.raises(Exception, match="as_of lies before"):
        scd.scd2_merge(dim, rows("d"), "nk", ["name"], F.lit("2024-01-15")).collect()


def test_keys_and_checksums_tell_bars_apart(spark):
    rows = spark.createDataFrame([("a|b", "c", 1), ("a", "b|c", 2), (None, "-", 3), ("-", None, 4), ("1:a", "", 5), ("1", ":a", 6)], "x string, y string, n int")
    assert rows.select(surrogate_key(F.col("x"), F.col("y")).alias("k")).distinct().count() == 6
    assert rows.select(F.concat(*[c.cast("string") for c in row_checksums(F.col("x"), F.col("y"))])).distinct().count() == 6


def increments(spark, **options):
    return IncrementTable(spark, new_folder(spark, "inc"), ["k"], **options)


def keyed(spark, pairs, kind="k string, v int"):
    return spark.createDataFrame(pairs, kind)


def test_a_run_writes_its_own_rows_only(spark):
    table = increments(spark)
    table.append(spark.range(100_000).select(F.col("id").cast("string").alias("k"), F.lit(0).alias("v")))
    for run in range(1, 4):
        table.append(keyed(spark, [(str(run), run), (f"new {run}", run)]), tag=f"r{run}")
    assert [(e.base, e.row_count) for e in table.log()] == [(True, 100_000), (False, 2), (False, 2), (False, 2)]
    folders = [f"{table.path}/rows/_run={e.run}" for e in table.log()[1:]]
    assert [spark.read.parquet(f).inputFiles().__len__() for f in folders] == [1, 1, 1]
    assert table.read().count() == 100_003
    assert {(r.k, r.v) for r in table.read().filter("v > 0").collect()} == {(k, n) for n in (1, 2, 3) for k in (str(n), f"new {n}")}
    assert {(r.k, r.v) for r in table.find([("2",), ("7",), ("new 3",), ("absent",)]).collect()} == {("2", 2), ("7", 0), ("new 3", 3)}
    assert "BroadcastHashJoin" in table.read()._jdf.queryExecution().executedPlan().toString()  # the base is not shuffled


def test_runs_and_folds_give_the_same_table(spark):
    rng = random.Random(5)
    tables = [increments(spark, share=s, most_runs=n) for s, n in ((0.01, 50), (10**9, 50), (10**9, 2))]
    expected = {}
    for run in range(4):
        rows = {rng.choice(["a", "b", "c", "d", None, ""]): rng.choice([None, *range(9)]) for _ in range(3)}
        expected.update(rows)
        for table in tables:
            table.append(keyed(spark, list(rows.items())), tag=str(run))
            assert not table.append(keyed(spark, [("a", -1)]), tag=str(run))
    for table in tables:
        assert {(r.k, r.v) for r in table.read().collect()} == set(expected.items())
        table.compact()
        assert {(r.k, r.v) for r in table.read().collect()} == set(expected.items())
        assert not table.append(keyed(spark, [("a", -1)]), tag="0")  # tags outlive a fold
        found = {(r.k, r.v) for r in table.find([(None,), ("b",)]).collect()}
        assert found == {(k, v) for k, v in expected.items() if k in (None, "b")}


def test_runs_with_repeated_keys_or_other_columns(spark):
    table = increments(spark)
    table.append(keyed(spark, []))  # an empty run makes an empty table
    with pytest.raises(ValueError):
        table.append(keyed(spark, [("a", 1), ("a", 2)]))
    assert table.read().isEmpty()
    table.append(keyed(spark, [("a", 1), ("a", 2), ("b", 3)]), latest_by=["v"])
    table.append(keyed(spark, [("a", "x")], "k string, more string"))
    table.append(keyed(spark, [("c", 7)], "k string, v long"))  # stored in the table's type
    assert {tuple(r) for r in table.read().collect()} == {("a", None, "x"), ("b", 3, None), ("c", 7, None)}
    assert table.read().dtypes == [("k", "string"), ("v", "int"), ("more", "string")]
    with pytest.raises(ValueError):
        table.append(keyed(spark, [("a", 1, 2)], "k string, v int, w int"), on_schema_change="fail")
