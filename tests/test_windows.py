"""Blocked windows against plain ones, with keys small enough to count as hot."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderloom.operators import ranking, skew, windows
from orderloom.operators.skew import hot_keys, join_one_per_key


@pytest.fixture(scope="module")
def rows(spark):
    pick = random.Random(3)
    data = [
        ("hot" if i % 2 else pick.choice(["a", "b", None]), None if i % 13 == 0 else pick.randrange(40), i, None if i % 17 == 0 else pick.randrange(100))
        for i in range(400)
    ]
    return spark.createDataFrame(data, "k string, at int, id int, v int").repartition(7).cache()


def same(actual, expected):
    columns = sorted(expected.columns)
    as_set = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert as_set(actual) == as_set(expected)


@pytest.mark.parametrize("hot_rows", [1, 120, 10**9])
@pytest.mark.parametrize("keys", [["k"], []])
def test_running(rows, keys, hot_rows):
    actual = windows.running(rows, keys, ["at", "id"], {"s": F.col("v"), "n": F.lit(1)}, hot_rows)
    w = Window.partitionBy(*keys).orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0)
    same(actual, rows.withColumn("s", F.sum("v").over(w)).withColumn("n", F.row_number().over(w)))


@pytest.mark.parametrize("hot_rows", [1, 10**9])
def test_running_with_peers(rows, hot_rows):
    known = rows
    actual = windows.running_with_peers(known, ["k"], ["at"], {"s": F.col("v")}, hot_rows)
    same(actual, known.withColumn("s", F.sum("v").over(Window.partitionBy("k").orderBy("at"))))


@pytest.mark.parametrize("hot_rows", [1, 120, 10**9])
@pytest.mark.parametrize("keys", [["k"], []])
def test_numbered(rows, keys, hot_rows):
    actual = windows.numbered(rows, keys, ["at"], rank="r", dense_rank="d", hot_rows=hot_rows)
    w = Window.partitionBy(*keys).orderBy("at")
    same(actual, rows.withColumn("r", F.rank().over(w)).withColumn("d", F.dense_rank().over(w)))


@pytest.mark.parametrize("hot_rows", [1, 10**9])
def test_previous(rows, hot_rows):
    actual = windows.previous(rows, ["k"], ["at", "id"], {"v": "pv", "id": "pid"}, hot_rows)
    w = Window.partitionBy("k").orderBy("at", "id")
    same(actual, rows.withColumn("pv", F.lag("v").over(w)).withColumn("pid", F.lag("id").over(w)))


@pytest.mark.parametrize("block_seconds", [None, 10])
def test_sliding(rows, block_seconds):
    timed = rows.withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("at") * 3).cast("timestamp_ntz"))
    actual = windows.sliding(timed, ["k"], "ts", 10, {"s": F.sum("v"), "n": F.count("v")}, block_seconds)
    w = Window.partitionBy("k").orderBy(F.col("at") * 3).rangeBetween(-10, 0)
    same(actual, timed.withColumn("s", F.sum("v").over(w)).withColumn("n", F.count("v").over(w)))


@pytest.mark.parametrize("hot_rows", [1, 120, 10**9])
def test_join_one_per_key_keeps_all_rows(rows, hot_rows):
    known = rows.withColumn("m", F.create_map(F.lit("a"), F.col("v")))
    totals = known.groupBy("k").agg(F.sum("v").alias("t"))
    expected = rows.withColumn("t", F.sum("v").over(Window.partitionBy("k")))
    same(join_one_per_key(known, totals, ["k"], hot_rows=hot_rows).drop("m"), expected)
    same(windows.with_total(rows, ["k"], {"t": F.sum("v")}, hot_rows), expected)
    equal = rows.select("k")
    assert equal.count() == join_one_per_key(equal, totals.select("k"), ["k"], "left_semi", hot_rows).count()


def test_equal_rows_do_not_share_a_share(spark):
    rows = spark.range(1000).select(F.lit("x").alias("k"))
    joined = join_one_per_key(rows, rows.distinct().withColumn("t", F.lit(1)), ["k"], hot_rows=100)
    assert joined.count() == 1000


def test_hot_keys_are_listed_with_their_shares(rows):
    assert {(r.k, r._shares) for r in hot_keys(rows, ["k"], 150).collect()} == {("hot", 2)}
    assert hot_keys(rows, ["k"]) is None


@pytest.mark.parametrize("tracked", [65_536, 16])
def test_hot_keys_are_those_of_a_full_count(spark, monkeypatch, tracked):
    """Sketches that are sure, and (16 items for 3,000 keys) some that are not."""
    monkeypatch.setattr(skew, "TRACKED", tracked)
    rnd = random.Random(8)
    drawn = [(None if key % 5 == 0 else f"k{key}", key % 3) for key in (int(rnd.paretovariate(0.6)) % 3000 for _ in range(6000))]
    frame = spark.createDataFrame(drawn, "a string, b int").repartition(7)
    counts = Counter(drawn)
    for hot_rows in (1, 5, 100, 10**6):
        found = hot_keys(frame, ["a", "b"], hot_rows)
        expected = {(*key, -(-n // hot_rows)) for key, n in counts.items() if n > hot_rows}
        assert {tuple(r) for r in (found.collect() if found else [])} == expected
    assert hot_keys(frame.limit(0), ["a"], 1) is None


def test_keys_are_not_shuffled_to_find_hot_ones(rows):
    assert skew._may_be_hot(rows, ["id"], 1000) == []
    assert len(skew._may_be_hot(rows, ["k"], 150)) == 1


def test_without_hot_keys_the_plan_is_the_plain_one(tables):
    orders, sums = tables.orders, {"s": F.col("o_totalprice")}
    summed = windows.running(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], sums)
    plan = summed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Union" not in plan


@pytest.mark.parametrize("hot_rows", [1, 60, 10**6])
def test_sliding_sums_split_busy_series(spark, hot_rows):
    rnd = random.Random(4)
    start = dt.datetime(2024, 1, 1)
    drawn = [(rnd.choice("aaaab"), rnd.choice([None, *range(40)]), i, rnd.choice([None, 1, 2, 5])) for i in range(200)]
    drawn += [("n", s, 900 + s, None) for s in range(4)]
    frame = spark.createDataFrame([(k, None if s is None else start + dt.timedelta(seconds=s), i, v) for k, s, i, v in drawn], "k string, at timestamp, id int, v long")

    def expected(key, at):
        seen = [v for k, s, _, v in drawn if k == key and v is not None and (s is None if at is None else s is not None and at - 7 <= s <= at)]
        return sum(seen) if seen else None

    found = windows.sliding_sums(frame.repartition(3), ["k"], "at", 7, {"s": F.col("v")}, hot_rows).collect()
    assert {r.id: r.s for r in found} == {i: expected(k, s) for k, s, i, _ in drawn} and len(found) == len(drawn)


def test_sliding_sums_do_not_add_up_each_range_anew(spark):
    """A frame that slides is summed up again at every row: time grew with the rows in a range."""
    start = dt.datetime(2024, 1, 1)
    frame = spark.createDataFrame([("a", start + dt.timedelta(seconds=s // 2), s, 0.5 * s) for s in range(60)], "k string, at timestamp_ntz, id int, v double")
    summed = windows.sliding_sums(frame, ["k"], "at", 7, {"s": F.col("v"), "n": F.lit(1).cast("decimal(4,1)")})
    assert "RangeFrame" not in summed._jdf.queryExecution().analyzed().toString()
    assert [f.dataType.simpleString() for f in summed.schema[-2:]] == ["double", "decimal(14,1)"]
    for r in summed.collect():
        seen = [0.5 * s for s in range(60) if r.id // 2 - 7 <= s // 2 <= r.id // 2]
        assert r.s == sum(seen) and r.n == len(seen)


@pytest.fixture(params=[10_000, 40])
def few(request, monkeypatch):
    """Bins are sorted in one task, in partitions, or either."""
    monkeypatch.setattr(ranking, "FEW", request.param)


@pytest.mark.parametrize("tiles, count", [(1, 400), (3, 400), (5, 400), (100, 30)])
def test_ntile(rows, tiles, count, few):
    some = rows.drop("k").dropna().filter(F.col("id") < count)
    actual = ranking.with_ntile(some, [("v", True), ("id", False)], tiles, "t")
    w = Window.orderBy(F.desc("v"), "id")
    same(actual, some.withColumn("t", F.ntile(tiles).over(w)))


@pytest.mark.parametrize("down", [True, False])
def test_ntile_with_nulls(rows, down, few):
    some = rows.select("id", F.when(F.col("id") % 3 != 0, F.col("v")).alias("v"))
    w = Window.orderBy(F.desc("v") if down else F.asc("v"), "id")
    same(ranking.with_ntile(some, [("v", down), ("id", False)], 4, "t"), some.withColumn("t", F.ntile(4).over(w)))


def test_ntiles_of_several_types(spark, few):
    some = spark.range(500).select(
        "id",
        F.when(F.col("id") % 7 > 0, F.col("id") % 3).cast("string").alias("text"),
        F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(F.col("id") % 50).cast("double").alias("number"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % 90).cast("int")).alias("day"),
        (F.col("id") % 11).cast("decimal(12,2)").alias("amount"),
    )
    tiled = {f"t_{c}": ([(c, i % 2 == 0), ("id", True)], 4 + i) for i, c in enumerate(["text", "number", "day", "amount"])}
    expected = some
    for name, (order, tiles) in tiled.items():
        w = Window.orderBy(*[F.desc(c) if down else F.asc(c) for c, down in order])
        expected = expected.withColumn(name, F.ntile(tiles).over(w))
    same(ranking.with_ntiles(some, tiled), expected)


def test_ntile_sorts_only_the_rows_around_its_openings(spark, monkeypatch):
    """A third of the rows share a value; of the other ones few are sorted."""
    sorted_rows = []
    rows_at = ranking._rows_at
    monkeypatch.setattr(ranking, "_rows_at", lambda df, order, at, n: sorted_rows.append(n) or rows_at(df, order, at, n))
    monkeypatch.setattr(ranking, "FEW", 1000)
    some = spark.range(200_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.xxhash64("id")).alias("v"))
    tiled = ranking.with_ntile(some, [("v", False), ("id", False)], 5, "t")
    counts = {r.t: (r.n, r.low, r.high) for r in tiled.groupBy("t").agg(F.count("id").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()}
    assert {n for n, _, _ in counts.values()} == {40_000}
    assert all(counts[i][2] <= counts[i + 1][1] for i in range(1, 5))
    assert 0 < sum(sorted_rows) < 200_000 * 4 // 50


def test_ntile_of_nothing(rows):
    assert ranking.with_ntile(rows.filter("v < 0"), [("v", False), ("id", False)], 5, "t").count() == 0


@pytest.mark.parametrize("hot_rows", [10**9, 1])
@pytest.mark.parametrize("down", [True, False])
def test_position_and_ranks(rows, down, hot_rows):
    some = rows.select("id", F.when(F.col("id") % 5 != 0, F.col("v")).alias("v"))
    actual = ranking.with_ranks(some, "v", "id", down, tiles={"t7": 7, "t900": 900}, hot_rows=hot_rows)
    by = F.desc("v") if down else F.asc("v")
    w, total = Window.orderBy(by), Window.orderBy(by, "id")
    expected = (
        some.withColumn("row_number", F.row_number().over(total))
        .withColumn("rank", F.rank().over(w))
        .withColumn("dense_rank", F.dense_rank().over(w))
        .withColumn("t7", F.ntile(7).over(total))
        .withColumn("t900", F.ntile(900).over(total))
    )
    same(actual, expected)


def test_ranks_of_nothing_and_their_plan(rows):
    assert ranking.with_ranks(rows.filter("v < 0"), "v", "id", tiles={"t": 3}).count() == 0
    plan = ranking.with_ranks(rows, "v", "id")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_top_per_key_beyond_the_threshold(rows, spark):
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", 5)
    try:
        for k in (4, 5, 30):
            top = ranking.top_per_key(rows, ["k"], [F.desc("v"), F.col("id")], k)
            w = Window.partitionBy("k").orderBy(F.desc("v"), "id")
            same(top, rows.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k))
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_top_per_key_prunes_before_the_shuffle(rows):
    top = ranking.top_per_key(rows, ["k"], [F.desc("v"), F.col("id")], 2)
    assert top._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert top.groupBy("k").count().filter("count > 2").isEmpty()
