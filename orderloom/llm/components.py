"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.session import cut


def connected_components(links: DataFrame, cut: Callable[[DataFrame, str], DataFrame] = cut) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); the component is its smallest node.

    Each round every node takes the label of its least neighbour, twice over, so that paths shorten; then the labels
    become the nodes and the links between different ones go on. What is left shrinks by
    powers; labels and links are written out each round, by ``cut``. Repeated links, loops and either direction are fine; a link
    with a null end is ignored. No links give no rows.
    """
    links = links.filter("a IS NOT NULL AND b IS NOT NULL")
    edges = cut(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    rounds: list[DataFrame] = []
    while True:
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        labels = both.groupBy("node").agg(F.least("node", F.min("other")).alias("label"))
        for _ in range(2):
            labels = cut(labels, "labels")
            labels = labels.join(labels.toDF("label", "next"), "label").select("node", F.col("next").alias("label"))
        labels = cut(labels, "labels")
        rounds.append(labels)
        ends = edges.join(labels.toDF("a", "x"), "a").join(labels.toDF("b", "y"), "b").filter("x <> y")
        edges = cut(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        if not edges.limit(1).count():
            break
    found = rounds[0].toDF("node", "component")
    for labels in rounds[1:]:
        later = labels.toDF("component", "later")
        found = found.join(later, "component", "left").select("node", F.coalesce("later", "component").alias("component"))
    return cut(found, "components")
