"""Trees held as (id, parent_id), as nested sets and as closure tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orderloom.operators.joins import one_value, range_join
from orderloom.operators.ranking import with_position
from orderloom.operators.windows import running
from orderloom.session import cut

PATH_SEPARATOR = " > "


def _chains(
    nodes: DataFrame, key: str, parent: str, element: Column, max_depth: int | None = None, missing: Column | None = None
) -> DataFrame:
    """Each node with ``_chain``: the ``element`` of itself, its parent and so on to the last ancestor.

    After round k a chain has its first 2**k members and knows the id that comes next; one join appends the chain of
    that id. So a tree of depth d takes log2(d) rounds, each written once, and no round looks at a single level. A chain that meets
    itself, in a cycle, ends before the first repeat. A parent that is no node ends it too, with ``missing``
    (made of the id ``_up``) as the last member if that is given.
    """
    table, reach = nodes.select("*", F.array(element).alias("_chain"), F.col(parent).alias("_up")), 1
    while True:
        above = table.select(F.col(key).alias("_above"), F.col("_chain").alias("_more"), F.col("_up").alias("_next"))
        joined = table.join(above, F.col("_up") == F.col("_above"), "left")
        nothing = F.col("_chain") if missing is None else F.when(F.col("_up").isNull(), F.col("_chain")).otherwise(F.array_append("_chain", missing))
        whole = F.when(F.col("_above").isNull(), nothing).otherwise(F.concat("_chain", "_more"))
        grown = joined.withColumn("_whole", whole).withColumn("_chain", F.array_distinct("_whole"))
        goes_on = F.when(F.size("_chain") == F.size("_whole"), F.col("_next"))
        grown = grown.select(*nodes.columns, "_chain", goes_on.alias("_up"))
        seen = Observation()
        watched = grown.observe(seen, F.count(F.when(F.col("_up").isNotNull(), 1)).alias("open"))
        table, reach = cut(watched, "chains"), 2 * reach
        if seen.get["open"] == 0 or (max_depth is not None and reach > max_depth):
            return table.drop("_up")


def _walk(
    nodes: DataFrame, start: Column | None, max_depth: int | None, key: str, parent: str, name: str
) -> DataFrame:
    """Nodes from ``start`` down, with ``depth``, ``path`` and for each step of it the id and a sort text."""
    columns = [key, parent, name]
    begin = F.col(parent).isNull() if start is None else start
    tree = nodes.select(*columns, F.coalesce(begin, F.lit(False)).alias("_start"))
    member = F.struct(F.col(key).alias("id"), F.col(name).alias("name"), F.col("_start").alias("start"))
    chains = _chains(tree, key, parent, member, max_depth)
    # A node lies below each start node in its chain, itself included.
    starts = F.filter(F.sequence(F.lit(0), F.size("_chain") - 1), lambda i: F.get("_chain", i)["start"])
    found = chains.select(*columns, "_chain", F.explode(starts).alias("depth"))
    if max_depth is not None:
        found = found.filter(F.col("depth") <= max_depth)
    way = found.withColumn("_way", F.reverse(F.slice("_chain", F.lit(1), F.col("depth") + 1)))
    nameless = F.exists("_way", lambda x: x["name"].isNull())
    path = F.when(~nameless, F.array_join(F.transform("_way", lambda x: x["name"].cast("string")), PATH_SEPARATOR))
    # The id tells siblings of one name apart.
    steps = F.transform("_way", lambda x: F.concat_ws("\u0002", x["name"].cast("string"), x["id"].cast("string")))
    return way.select(*columns, "depth", path.alias("path"), F.transform("_way", lambda x: x["id"]).alias("_trail"), steps.alias("_steps"))


def descend(
    nodes: DataFrame,
    start: Column | None = None,
    max_depth: int | None = None,
    key: str = "id",
    parent: str = "parent_id",
    name: str = "name",
) -> DataFrame:
    """All nodes below ``start`` (default: the roots) with ``depth`` and ``path``.

    By doubling (see ``_chains``), so without a bound on levels or rows. A node is not entered again on its own path, which ends cycles.
    """
    return _walk(nodes, start, max_depth, key, parent, name).select(key, parent, name, "depth", "path")


def below(nodes: DataFrame, root, key: str = "id", parent: str = "parent_id") -> DataFrame:
    """(id, parent_id, depth) of one node and all below it."""
    tree = nodes.select(F.col(key).alias("id"), F.col(parent).alias("parent_id"))
    chains = _chains(tree, "id", "parent_id", F.col("id"))
    place = F.array_position("_chain", root).cast("int")
    return chains.filter(place > 0).select("id", "parent_id", (place - 1).alias("depth"))


def closure(
    nodes: DataFrame, max_depth: int | None = None, key: str = "id", parent: str = "parent_id"
) -> DataFrame:
    """All (ancestor, descendant, depth) pairs, each node with itself at depth 0.

    The chains of all nodes, by doubling; a node is no ancestor of itself by way of a cycle. A parent that is no node is an ancestor.
    """
    tree = nodes.select(F.col(key).alias("descendant"), F.col(parent).cast(nodes.schema[key].dataType).alias("_parent"))
    chains = _chains(tree, "descendant", "_parent", F.col("descendant"), max_depth, F.col("_up"))
    pairs = chains.select("descendant", F.posexplode("_chain").alias("depth", "ancestor"))
    pairs = pairs if max_depth is None else pairs.filter(F.col("depth") <= max_depth)
    return pairs.select("ancestor", "descendant", "depth")


def ancestors_of(pairs: DataFrame, node) -> DataFrame:
    return pairs.filter(F.col("descendant") == node)


def descendants_of(pairs: DataFrame, node) -> DataFrame:
    return pairs.filter(F.col("ancestor") == node)


def subtree(nested: DataFrame, root: Column, low: str = "lft", high: str = "rgt") -> DataFrame:
    """Nodes inside the interval of the one node that meets ``root``."""
    top = nested.filter(root)
    return nested.filter(F.col(low).between(one_value(top.select(low)), one_value(top.select(high))))


def nested_ancestors(nested: DataFrame, width: int, key: str = "id") -> DataFrame:
    """(ancestor, descendant) pairs by the nesting of intervals, each node with itself."""
    inner = nested.select(F.col(key).alias("descendant"), F.col("lft").alias("_at"))
    outer = nested.select(F.col(key).alias("ancestor"), "lft", "rgt")
    return range_join(inner, outer, "_at", "lft", "rgt", width).select("ancestor", "descendant")


def nested_depth(nested: DataFrame, key: str = "id") -> DataFrame:
    """Depth of each node by its nested set numbers: how many intervals are open around it.

    A sweep over the interval ends, +1 at each opening and -1 past each closing,
    instead of a join of the tree with itself.
    """
    opens = nested.select(F.col(key), F.col("lft").alias("_at"), F.lit(1).alias("_step"), F.lit(1).alias("_turn"))
    closes = nested.select(F.col(key), F.col("rgt").alias("_at"), F.lit(-1).alias("_step"), F.lit(2).alias("_turn"))
    ends = opens.unionByName(closes)
    swept = running(ends, [], ["_at", "_turn", key], {"_open": F.col("_step")})
    return swept.filter("_step = 1").select(key, (F.col("_open") - 1).cast("int").alias("depth"))


def number_nested_sets(
    nodes: DataFrame, key: str = "id", parent: str = "parent_id", name: str = "name"
) -> DataFrame:
    """Nested set numbers from parent links: (id, lft, rgt, depth, path).

    A node in pre-order place p (from 0) at depth d has p intervals opened before
    it, of which p - d are closed again; its own holds two numbers per node below.
    Siblings follow each other by name, then id. A node's way down names all
    nodes it counts for.
    """
    walked = _walk(nodes, None, None, key, parent, name)
    sizes = walked.select(F.explode("_trail").alias(key)).groupBy(key).agg(F.count(F.lit(1)).alias("_size"))
    placed = with_position(walked.select(key, "depth", "path", "_steps"), [F.col("_steps")], "_place")
    left = 2 * (F.col("_place") - 1) - F.col("depth") + 1
    return placed.join(sizes, key).select(
        key, left.alias("lft"), (left + 2 * F.col("_size") - 1).alias("rgt"), "depth", "path"
    )
