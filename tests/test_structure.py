"""Trees, shards and ranges against goldens and brute force."""

import bisect
import hashlib
import random

import pytest
import seed
from pyspark.sql import functions as F

from orderloom.operators import hierarchy, sharding
from orderloom.session import new_folder
from orderloom.streaming import ranges


def test_paths(spark):
    paths = [r.path for r in hierarchy.descend(seed.categories(spark)).orderBy("path").collect()]
    assert len(paths) == 11
    assert paths[:3] == ["Electronics", "Electronics > Accessories", "Electronics > Laptops"]
    below = hierarchy.descend(seed.categories(spark), F.col("id") == 1)
    assert {r.id: r.depth for r in below.collect()} == {1: 0, 2: 1, 5: 1, 8: 1, 3: 2, 4: 2, 6: 2, 7: 2}


def test_cycles_and_depth_limit_end_the_walk(spark):
    ring = spark.createDataFrame([(1, 3, "a"), (2, 1, "b"), (3, 2, "c")], "id long, parent_id long, name string")
    assert hierarchy.descend(ring, F.col("id") == 1).count() == 3
    assert hierarchy.descend(seed.categories(spark), max_depth=1).count() == 7
    assert hierarchy.closure(ring).count() == 9
    tail = ring.unionByName(spark.createDataFrame([(4, 1, "d")], ring.schema))
    assert sorted(r.ancestor for r in hierarchy.ancestors_of(hierarchy.closure(tail), 4).collect()) == [1, 2, 3, 4]


def test_closure(spark):
    pairs = hierarchy.closure(seed.categories(spark))
    assert [(r.ancestor, r.depth) for r in hierarchy.ancestors_of(pairs, 4).orderBy("depth").collect()] == [(4, 0), (2, 1), (1, 2)]
    assert hierarchy.descendants_of(pairs, 1).count() == 8


def test_a_deep_chain(spark):
    chain = spark.range(25).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent_id"), F.lit("n").alias("name"))
    assert hierarchy.descend(chain).agg(F.max("depth"), F.count("id")).first() == (24, 25)


def test_two_thousand_levels_take_few_rounds(spark, monkeypatch):
    cuts, plain = [], hierarchy.cut
    monkeypatch.setattr(hierarchy, "cut", lambda df, label: (cuts.append(label), plain(df, label))[1])
    chain = spark.range(2000).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent_id"))
    found = hierarchy.below(chain, 0)
    assert found.agg(F.max("depth"), F.count("id"), F.sum("depth")).first() == (1999, 2000, 1999 * 1000)
    assert len(cuts) <= 12


@pytest.mark.parametrize("max_depth", [None, 0, 2, 5])
def test_any_links_walked_as_by_hand(spark, max_depth):
    """Trees, cycles, self links and parents that are no nodes, with nested start nodes."""
    rnd = random.Random(9)
    up = {i: rnd.choice([None, rnd.randrange(60), rnd.randrange(60), i, 99]) if i % 4 else rnd.randrange(60) for i in range(60)}
    nodes = spark.createDataFrame([(i, p, f"n{i % 7}" if i % 13 else None) for i, p in up.items()], "id long, parent_id long, name string")
    chains = {}
    for i in up:
        chain, at = [i], up[i]
        while at is not None and at not in chain:
            chain.append(at)
            at = up.get(at)
        chains[i] = chain if max_depth is None else chain[: max_depth + 1]
    pairs = sorted((a, i, d) for i, c in chains.items() for d, a in enumerate(c))
    assert sorted(tuple(r) for r in hierarchy.closure(nodes, max_depth).collect()) == pairs
    starts = {i for i in up if i % 3 == 0}
    walked = hierarchy.descend(nodes, F.col("id") % 3 == 0, max_depth).select("id", "depth").collect()
    assert sorted(tuple(r) for r in walked) == sorted((i, d) for a, i, d in pairs if a in starts)


def test_no_nodes(spark):
    none = spark.createDataFrame([], "id long, parent_id long, name string")
    assert hierarchy.closure(none).isEmpty() and hierarchy.descend(none).isEmpty()


def test_nested_sets_with_gaps(spark):
    nested = seed.nested(spark)
    assert sorted(r.id for r in hierarchy.subtree(nested, F.col("id") == 1).collect()) == list(range(1, 9))
    depths = {1: 0, 2: 1, 3: 2, 4: 2, 5: 1, 6: 2, 7: 2, 8: 1, 9: 0, 10: 1, 11: 1}
    assert {r.id: r.depth for r in hierarchy.nested_depth(nested).collect()} == depths
    brute = {(a[0], d[0]) for a in seed.NESTED for d in seed.NESTED if a[1] <= d[1] <= a[2]}
    found = [(r.ancestor, r.descendant) for r in hierarchy.nested_ancestors(nested, 4).collect()]
    assert len(found) == len(brute) and set(found) == brute


def test_numbering_agrees_with_the_links(spark):
    numbered = hierarchy.number_nested_sets(seed.categories(spark)).collect()
    bounds = sorted(x for r in numbered for x in (r.lft, r.rgt))
    assert bounds == list(range(1, 23))
    pairs = {(r.ancestor, r.descendant) for r in hierarchy.closure(seed.categories(spark)).collect()}
    assert {(a.id, d.id) for a in numbered for d in numbered if a.lft <= d.lft <= a.rgt} == pairs


def test_hash_and_range_shards(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(sharding.hash_shard(F.lit(5), 3)) == 2
    assert one(sharding.hash_shard(F.lit(-1), 3)) == 2
    assert [one(sharding.range_shard(F.lit(k), [10, 20])) for k in (9, 10, 19, 20)] == [0, 1, 1, 2]
    moved = {k for k in range(1000, 1005) if one(sharding.hash_shard(F.lit(k), 4) != sharding.hash_shard(F.lit(k), 5))}
    assert moved == {1004}


def brute_ring(nodes, replicas):
    points = sorted((hashlib.md5(f"{n}:{i}".encode()).hexdigest(), n) for n in nodes for i in range(replicas))
    hexes = [p for p, _ in points]

    def find(key):
        return points[bisect.bisect(hexes, hashlib.md5(key.encode()).hexdigest()) % len(points)][1]

    return find


@pytest.mark.parametrize("replicas", [1, 150])
def test_ring(spark, replicas):
    nodes = ["shard-0", "shard-1", "shard-2"]
    keys = spark.range(3000).select(F.concat(F.lit("customer:"), F.col("id").cast("string")).alias("k"))
    ring = sharding.ring_points(spark, nodes, replicas)
    find = brute_ring(nodes, replicas)
    placed = sharding.ring_shard(keys, F.col("k"), ring).collect()
    assert len(placed) == 3000 and all(r.shard == find(r.k) for r in placed)


def test_a_new_node_moves_about_its_share(spark):
    keys = spark.range(5000).select(F.concat(F.lit("customer:"), F.col("id").cast("string")).alias("k"))
    names = [f"shard-{n}" for n in range(4)]
    three = sharding.ring_shard(keys, F.col("k"), sharding.ring_points(spark, names[:3], 150), "before")
    four = sharding.ring_shard(three, F.col("k"), sharding.ring_points(spark, names, 150), "after")
    assert 0.18 < sharding.moved_fraction(four, F.col("before"), F.col("after")).first().fraction < 0.32
    # Keys only move to the new node.
    assert {r.after for r in four.filter("before <> after").select("after").distinct().collect()} == {"shard-3"}


def test_one_shard_is_one_directory(spark):
    path = new_folder(spark, "shards")
    sharding.write_sharded(spark.range(30).withColumnRenamed("id", "k"), F.col("k") % 3, path)
    read = spark.read.parquet(path).filter("shard = 2")
    assert "PartitionFilters: [isnotnull(shard" in read._jdf.queryExecution().executedPlan().toString()
    assert read.count() == 10


def test_distribution_and_totals(spark):
    df = spark.range(9).select((F.col("id") % 3 % 2).alias("shard"), "id")
    assert sorted((r.shard, r.rows, r.skew) for r in sharding.distribution(df, "shard").collect()) == [(0, 6, 1.3333), (1, 3, 0.6667)]
    merged = {r.source: r.n for r in sharding.per_shard_and_total(df, "shard", {"n": F.count(F.lit(1))}).collect()}
    assert merged == {"0": 6, "1": 3, "total": 9}


def test_directory(spark):
    df, listing = spark.range(3), spark.createDataFrame([(1, "eu")], "id long, shard string")
    assert {r.id: r.shard for r in sharding.directory_shard(df, listing, "id", "rest").collect()} == {0: "rest", 1: "eu", 2: "rest"}


def spelled(df):
    return {(r.source, n) for r in df.collect() for n in range(r.low, r.high + 1)}


def test_range_subtraction(spark):
    sets = spark.createDataFrame([("a:1-10:20-30:40, B:1-5",), ("a:11-12",)], "s string")
    gone = spark.createDataFrame([("a:5-6:25-29,b:1-5,c:1-9",)], "s string")
    have, lack = ranges.parse_ranges(sets, "s"), ranges.parse_ranges(gone, "s")
    for hot_rows in (10**9, 1):
        missing = ranges.subtract_ranges(have, lack, ["source"], hot_rows)
        assert sorted((r.source, r.low, r.high) for r in missing.collect()) == [
            ("a", 1, 4), ("a", 7, 12), ("a", 20, 24), ("a", 30, 30), ("a", 40, 40),
        ]
        assert spelled(missing) == spelled(have) - spelled(lack)
