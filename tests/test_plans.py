"""The plans of all registered queries, as they are where nothing fits a broadcast."""

from orderloom.catalog import QUERIES

NEVER = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"]


def gathered(lines: list[str]) -> list[str]:
    """What is below each exchange into one partition."""
    return [lines[i + 1].strip(" +-:|") for i, line in enumerate(lines[:-1]) if "Exchange SinglePartition" in line]


def test_no_plan_gathers_a_table_in_one_task(spark, folder):
    limits = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for limit in limits:
        spark.conf.set(limit, "-1")
    try:
        for name, build in QUERIES.items():
            plan = build(spark, folder)._jdf.queryExecution().executedPlan().toString()
            assert not [node for node in NEVER if node in plan], name
            # Into one task go aggregates only: of a month, a block, a shard, the ring; or partial ones.
            below = [node for node in gathered(plan.split("\n")) if not node.startswith(("HashAggregate", "Project [prefix", "SortAggregate"))]
            assert not below, (name, below)
    finally:
        for limit in limits:
            spark.conf.unset(limit)
