"""Hierarchies, sharding, statement logs and capacity."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.catalog.core import query
from orderloom.catalog.relational import TREE_CTE, place_tree
from orderloom.functions.amounts import cents, total_cents
from orderloom.operators import hierarchy, sharding
from orderloom.plans import capacity
from orderloom.session import cut, new_folder
from orderloom.sources import slowlog

WALK_CTE = f"""
{TREE_CTE},
walk AS (SELECT id, parent_id, name, 0 AS depth, name AS path, [name || chr(2) || id] AS steps FROM tree WHERE parent_id IS NULL
         UNION ALL SELECT c.id, c.parent_id, c.name, w.depth + 1, w.path || ' > ' || c.name, list_append(w.steps, c.name || chr(2) || c.id)
         FROM tree c JOIN walk w ON w.id = c.parent_id),
pairs AS (SELECT id AS ancestor, id AS descendant, 0 AS depth FROM tree
          UNION ALL SELECT t.parent_id, p.descendant, p.depth + 1 FROM pairs p JOIN tree t ON t.id = p.ancestor WHERE t.parent_id IS NOT NULL),
nested AS (
  SELECT w.id, 2 * (ROW_NUMBER() OVER (ORDER BY steps) - 1) - w.depth + 1 AS lft,
         2 * (ROW_NUMBER() OVER (ORDER BY steps) - 1) - w.depth + 2 * s.n AS rgt, w.depth
  FROM walk w JOIN (SELECT ancestor, COUNT(*) AS n FROM pairs GROUP BY 1) s ON s.ancestor = w.id)
"""


def nested_places(t):
    return cut(hierarchy.number_nested_sets(place_tree(t)), "nested")


@query(
    "h1_subtree",
    f"""
    WITH RECURSIVE {WALK_CTE}
    SELECT c.id, c.lft FROM nested c JOIN nested p ON c.lft BETWEEN p.lft AND p.rgt WHERE p.id = 'r1'
    """,
)
def _(t):
    """All that lies inside one region's interval."""
    return hierarchy.subtree(nested_places(t), F.col("id") == "r1").select("id", "lft")


@query("h2_descendants_with_path", f"WITH RECURSIVE {WALK_CTE} SELECT id, parent_id, name, depth, path FROM walk")
def _(t):
    return hierarchy.descend(place_tree(t))


@query(
    "h3_depth_from_nested_sets",
    f"""
    WITH RECURSIVE {WALK_CTE}
    SELECT c.id, CAST(COUNT(*) - 1 AS INTEGER) AS depth FROM nested c JOIN nested p ON c.lft BETWEEN p.lft AND p.rgt GROUP BY c.id
    """,
)
def _(t):
    return hierarchy.nested_depth(nested_places(t))


@query("h4_closure_table", f"WITH RECURSIVE {WALK_CTE} SELECT ancestor, descendant, depth FROM pairs")
def _(t):
    return hierarchy.closure(place_tree(t))


@query("h4_ancestors", f"WITH RECURSIVE {WALK_CTE} SELECT ancestor, descendant, depth FROM pairs WHERE descendant = 'c100'")
def _(t):
    return hierarchy.ancestors_of(hierarchy.closure(place_tree(t)), "c100")


@query("h5_nested_set_numbers", f"WITH RECURSIVE {WALK_CTE} SELECT id, lft, rgt FROM nested")
def _(t):
    return hierarchy.number_nested_sets(place_tree(t)).select("id", "lft", "rgt")


@query(
    "h5_ancestors_by_nesting",
    f"""
    WITH RECURSIVE {WALK_CTE}
    SELECT p.id AS ancestor, c.id AS descendant FROM nested c JOIN nested p ON c.lft BETWEEN p.lft AND p.rgt
    """,
)
def _(t):
    """The pairs of the nested set join, by an equi join on buckets of the numbering."""
    return hierarchy.nested_ancestors(nested_places(t), width=64)


@query(
    "h6_category_path",
    """
    SELECT p_partkey, p_type || ' > ' || p_brand AS category_path FROM part
    """,
)
def _(t):
    """Path of each product's category in a tree built from types and brands."""
    brands = t.part.select("p_type", "p_brand").distinct()
    tree = t.part.select("p_type").distinct().select(
        F.col("p_type").alias("id"), F.lit(None).cast("string").alias("parent_id"), F.col("p_type").alias("name")
    ).unionByName(
        brands.select(F.concat_ws("/", "p_type", "p_brand").alias("id"), F.col("p_type").alias("parent_id"), F.col("p_brand").alias("name"))
    )
    paths = hierarchy.descend(tree).select("id", F.col("path").alias("category_path"))
    return t.part.join(paths, F.concat_ws("/", "p_type", "p_brand") == F.col("id")).select("p_partkey", "category_path")


# ---- sharding ----------------------------------------------------------------


@query("k1_hash_shard", "SELECT c_custkey, c_custkey % 3 AS shard FROM customer")
def _(t):
    return t.customer.select("c_custkey", sharding.hash_shard(F.col("c_custkey"), 3).alias("shard"))


@query(
    "k2_range_shard",
    "SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 2 WHEN o_totalprice >= 100000 THEN 1 ELSE 0 END AS shard FROM orders",
)
def _(t):
    return t.orders.select("o_orderkey", sharding.range_shard(F.col("o_totalprice"), [100_000, 300_000]).alias("shard"))


@query(
    "k3_directory_shard",
    """
    SELECT c_custkey, CASE WHEN r_name IN ('ASIA', 'EUROPE') THEN 'shard-' || lower(r_name) ELSE 'shard-rest' END AS shard
    FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
    """,
)
def _(t):
    """Nations of two regions have a shard of their own in the directory, all others share one."""
    listed = t.region.filter("r_name IN ('ASIA', 'EUROPE')")
    directory = t.nation.join(listed, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.concat(F.lit("shard-"), F.lower("r_name")).alias("shard")
    )
    placed = sharding.directory_shard(t.customer, directory, "c_nationkey", "shard-rest")
    return placed.select("c_custkey", "shard")


def ring_cte(name: str, nodes: int, replicas: int) -> str:
    return f"""
{name} AS (SELECT md5('shard-' || n || ':' || i) AS position, 'shard-' || n AS node
           FROM (SELECT unnest(range({nodes})) AS n) CROSS JOIN (SELECT unnest(range({replicas})) AS i)),
{name}_placed AS (SELECT k.c_custkey, COALESCE(r.node, (SELECT arg_min(node, position) FROM {name})) AS shard
           FROM (SELECT c_custkey, md5('customer:' || c_custkey) AS h FROM customer) k ASOF LEFT JOIN {name} r ON k.h < r.position)"""


def _customer_key():
    return F.concat(F.lit("customer:"), F.col("c_custkey").cast("string"))


def on_ring(t, nodes: int, name: str, df=None):
    ring = sharding.ring_points(t.spark, [f"shard-{n}" for n in range(nodes)], 150)
    return sharding.ring_shard(t.customer.select("c_custkey") if df is None else df, _customer_key(), ring, name)


@query("k4_consistent_hash_ring", f"WITH {ring_cte('ring', 3, 150)} SELECT c_custkey, shard FROM ring_placed")
def _(t):
    return on_ring(t, 3, "shard")


@query(
    "k5_distribution",
    """
    WITH s AS (SELECT o_custkey % 3 AS shard, COUNT(*) AS rows FROM orders GROUP BY 1)
    SELECT shard, rows, ROUND(rows / (SELECT SUM(rows) FROM s) * 100, 2) AS share_pct, ROUND(rows * 3 / (SELECT SUM(rows) FROM s), 4) AS skew FROM s
    """,
)
def _(t):
    return sharding.distribution(t.orders.select(sharding.hash_shard(F.col("o_custkey"), 3).alias("shard")), "shard")


@query(
    "k6_moved_by_modulo",
    """
    SELECT COUNT(*) AS keys, COUNT(*) FILTER (c_custkey % 4 <> c_custkey % 5) AS moved,
           ROUND(COUNT(*) FILTER (c_custkey % 4 <> c_custkey % 5) / COUNT(*), 4) AS fraction FROM customer
    """,
)
def _(t):
    key = F.col("c_custkey")
    return sharding.moved_fraction(t.customer, sharding.hash_shard(key, 4), sharding.hash_shard(key, 5))


@query(
    "k6_moved_by_ring",
    f"""
    WITH {ring_cte('r4', 4, 150)}, {ring_cte('r5', 5, 150)}
    SELECT COUNT(*) AS keys, COUNT(*) FILTER (a.shard <> b.shard) AS moved, ROUND(COUNT(*) FILTER (a.shard <> b.shard) / COUNT(*), 4) AS fraction
    FROM r4_placed a JOIN r5_placed b USING (c_custkey)
    """,
)
def _(t):
    both = on_ring(t, 5, "after", on_ring(t, 4, "before"))
    return sharding.moved_fraction(both, F.col("before"), F.col("after"))


@query(
    "k7_single_shard_read",
    "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_custkey % 3 = 2 AND o_custkey = 5",
)
def _(t):
    """Orders written by shard; one customer's orders are read from one directory."""
    path = new_folder(t.spark, "shards")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    sharding.write_sharded(rows, sharding.hash_shard(F.col("o_custkey"), 3), path)
    one = t.spark.read.parquet(path).filter((F.col("shard") == 5 % 3) & (F.col("o_custkey") == 5))
    return one.select("o_orderkey", "o_totalprice", "o_orderstatus")


@query(
    "k7_all_shards_read",
    "SELECT CAST(o_custkey % 3 AS INTEGER) AS shard, COUNT(*) AS pending FROM orders WHERE o_orderstatus = 'P' GROUP BY 1",
)
def _(t):
    path = new_folder(t.spark, "shards")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    sharding.write_sharded(rows, sharding.hash_shard(F.col("o_custkey"), 3), path)
    return t.spark.read.parquet(path).filter("o_orderstatus = 'P'").groupBy("shard").agg(F.count(F.lit(1)).alias("pending"))


@query(
    "k8_split_shard",
    """
    SELECT CASE WHEN year(o_orderdate) <> 1998 THEN CAST(year(o_orderdate) AS INTEGER) WHEN month(o_orderdate) <= 6 THEN 19981 ELSE 19982 END AS shard, COUNT(*) AS orders
    FROM orders GROUP BY 1
    """,
)
def _(t):
    """Orders by year; the directory of one year is split into halves."""
    path = new_folder(t.spark, "split")
    rows = t.orders.select("o_orderkey", "o_orderdate")
    sharding.write_sharded(rows, F.year("o_orderdate"), path)
    half = F.when(F.month("o_orderdate") <= 6, 19981).otherwise(19982)
    moved = f"{path}-split"
    sharding.split_shard(t.spark, path, 1998, half, moved)
    rest = t.spark.read.parquet(path).filter("shard <> 1998").select("o_orderkey", "shard")
    halves = t.spark.read.parquet(moved).select("o_orderkey", "shard")
    return rest.unionByName(halves).groupBy("shard").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "k9_federated_regions",
    """
    SELECT r_name AS region, COUNT(*) AS customers, CAST(SUM(CAST(c_acctbal AS DECIMAL(14,2))) AS DECIMAL(20,2)) AS balance
    FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1
    """,
)
def _(t):
    """Customers placed in one folder per region, then seen as one table again."""
    path = new_folder(t.spark, "regions")
    sharding.write_sharded(t.located_customers.select("customer_nk", "balance", "country"), F.col("country"), path, "region")
    names = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    stored = t.spark.read.parquet(path)
    regional = {n: stored.filter(F.col("region") == n).drop("region") for n in names}
    return sharding.federated(regional).groupBy("region").agg(
        F.count(F.lit(1)).alias("customers"), total_cents(cents("balance")).alias("balance")
    )


# ---- statement logs and capacity ---------------------------------------------


def statements_of(t):
    """Every event as one logged statement with its own literals."""
    text = F.concat(
        F.lit("SELECT * FROM "), "event_type", F.lit("  WHERE id = "), F.col("event_id").cast("string"),
        F.lit(" AND name = 'u"), F.col("user_id").cast("string"), F.lit("' AND k IN (1, 2, "), F.col("user_id").cast("string"), F.lit(");"),
    )
    return t.events.select(
        F.col("ts").alias("time"),
        "user_id",
        F.round(F.col("value") / 100, 4).alias("query_time"),
        F.lit(1).cast("long").alias("rows_sent"),
        (F.col("event_id") * 10).alias("rows_examined"),
        text.alias("sql_text"),
    )


DIGEST = "'select * from ' || event_type || ' where id = ? and name = ? and k in (?)'"


@query(
    "m1_statement_digest",
    f"""
    WITH e AS (SELECT {DIGEST} AS digest, ROUND(value / 100, 4) AS query_time, event_id * 10 AS rows_examined FROM events)
    SELECT digest, COUNT(*) AS calls, ROUND(AVG(query_time) * 1000, 2) AS avg_ms, ROUND(MAX(query_time) * 1000, 2) AS max_ms, ROUND(SUM(query_time) * 1000, 2) AS total_ms,
           CAST(SUM(rows_examined) AS BIGINT) AS rows_examined, ROUND(SUM(rows_examined) / COUNT(*), 2) AS examined_per_sent,
           ROUND(ROUND(SUM(query_time) * 1000, 2) / (SELECT SUM(query_time) * 1000 FROM e) * 100, 1) AS share_pct
    FROM e GROUP BY digest HAVING COUNT(*) >= 10 ORDER BY total_ms DESC LIMIT 20
    """,
)
def _(t):
    return capacity.digest_profile(capacity.digests(statements_of(t)), top=20, min_calls=10)


@query(
    "m2_slow_log_parse",
    f"""
    SELECT date_trunc('second', ts) AS time, 'app' || user_id AS user_host, ROUND(value / 100, 4) AS query_time, CAST(1 AS BIGINT) AS rows_sent, event_id * 10 AS rows_examined, {DIGEST} AS digest
    FROM events WHERE ROUND(value / 100, 4) >= 0.5 AND event_id * 10 >= 1000
    """,
)
def _(t):
    """Statements written as a text log, read back entry by entry, and those over the thresholds."""
    entry = F.format_string(
        "# Time: %s\n# User@Host: app%s\n# Query_time: %s  Lock_time: 0.000100  Rows_sent: %s  Rows_examined: %s\nSET timestamp=1700000000;\n%s",
        F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss"), F.col("user_id").cast("string"), F.col("query_time").cast("decimal(12,4)").cast("string"),
        F.col("rows_sent").cast("string"), F.col("rows_examined").cast("string"), "sql_text",
    )
    path = new_folder(t.spark, "slowlog")
    statements_of(t).select(entry.alias("value")).write.text(path)
    entries = slowlog.over_threshold(slowlog.read_entries(t.spark, path), 0.5, 1000)
    return capacity.digests(entries).select("time", "user_host", "query_time", "rows_sent", "rows_examined", "digest")


@query(
    "m3_repeated_lookups",
    f"""
    SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS window_start, {DIGEST} AS digest, COUNT(*) AS calls FROM events GROUP BY 1, 2, 3 HAVING COUNT(*) >= 2
    """,
)
def _(t):
    return capacity.repeated_lookups(capacity.digests(statements_of(t)), "user_id", "time", "1 day", 2)


@query(
    "m4_growth_forecast",
    """
    WITH s AS (SELECT event_type, CAST(day(ts) AS INTEGER) AS d, COUNT(*) AS n FROM events GROUP BY 1, 2)
    SELECT event_type, ROUND(regr_slope(n, d), 6) AS growth_per_period, arg_max(n, d) AS current_size,
           ROUND(CASE WHEN regr_slope(n, d) > 0 THEN (1000 - arg_max(n, d)) / regr_slope(n, d) END, 4) AS periods_to_limit
    FROM s GROUP BY event_type
    """,
)
def _(t):
    """Events per day as the size of each type's table, fitted by a line."""
    sizes = t.events.groupBy("event_type", F.dayofmonth("ts").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    fitted = capacity.growth(sizes, ["event_type"], F.col("d"), F.col("n"), F.lit(1000))
    return fitted.select(
        "event_type",
        F.round("growth_per_period", 6).alias("growth_per_period"),
        "current_size",
        F.round("periods_to_limit", 4).alias("periods_to_limit"),
    )


@query(
    "m4_sizes_by_schema",
    """
    SELECT c_mktsegment AS schema_name, ROUND(SUM(c_custkey * 1048576) / 1073741824, 2) AS data_gb, ROUND(SUM(c_nationkey * 1048576) / 1073741824, 2) AS index_gb,
           ROUND((SUM(c_custkey * 1048576) + SUM(c_nationkey * 1048576)) / 1073741824, 2) AS total_gb, COUNT(*) AS table_count
    FROM customer GROUP BY 1
    """,
)
def _(t):
    """Customers as tables of a schema per segment, their numbers as megabytes."""
    tables = t.customer.select(
        F.col("c_mktsegment").alias("schema_name"),
        (F.col("c_custkey") * 1048576).alias("data_bytes"),
        (F.col("c_nationkey").cast("long") * 1048576).alias("index_bytes"),
    )
    return capacity.sizes_by_schema(tables)
