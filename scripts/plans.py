"""Print the physical plan of registered queries after running them (AQE's
final plan), for plan review: exchanges, join strategies, scans."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def count_nodes(plan) -> dict[str, int]:
    """Operator counts of a physical plan (JVM object): AQE's current plan and
    every query stage are walked; a cached relation counts once as its scan."""
    counts: dict[str, int] = {}

    def walk(node) -> None:
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name in ("ShuffleQueryStage", "BroadcastQueryStage", "TableCacheQueryStage"):
            return walk(node.plan())
        counts[name] = counts.get(name, 0) + 1
        if name == "InMemoryTableScan":
            return None
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))
        return None

    walk(plan)
    return counts


KEYS = ("Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
        "Window", "HashAggregate", "ObjectHashAggregate", "ArrowEvalPython", "MapInPandas",
        "Scan parquet", "InMemoryTableScan", "ReusedExchange", "CartesianProduct", "BroadcastNestedLoopJoin")


def main() -> None:
    sf = os.environ.get("PLAN_SF_DIR", "/root/testdata/sf0.01")
    from deckforge.plans.queries import QUERIES
    from deckforge.session import build_session
    spark = build_session("local[8]", 8)
    names = sys.argv[1:] or list(QUERIES)
    for name in names:
        df = QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan()
        counts = count_nodes(plan)
        print(f"{name}: " + ", ".join(f"{k}={counts[k]}" for k in KEYS if counts.get(k)))
        if os.environ.get("PLAN_FULL"):
            print(plan.toString())


if __name__ == "__main__":
    main()
