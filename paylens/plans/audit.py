"""Plan audit: shuffle, join and scan shape of every registered query.

    python -m paylens.plans.audit /root/testdata/sf0.01 > PLANS.md

Each query's own frame is executed and its final adaptive plan (without the
initial one, reused exchanges and reused subqueries once) is summarised: shuffle exchanges by kind, join strategies, aggregate
operators, scans with pushed filters, and anything we never want to see
(cartesian products, nested-loop joins, Python evaluation).
"""

from __future__ import annotations

import re
import sys

MARKERS = {
    "hash exch": r"Exchange hashpartitioning",
    "range exch": r"Exchange rangepartitioning",
    "single exch": r"Exchange SinglePartition",
    "bcast": r"BroadcastExchange",
    "SMJ": r"SortMergeJoin",
    "BHJ": r"BroadcastHashJoin",
    "hash agg": r"HashAggregate\(",
    "obj/sort agg": r"(ObjectHashAggregate|SortAggregate)\(",
    "window": r"\bWindow\b",
    "scans": r"FileScan parquet|Scan parquet",
    "pushed": r"PushedFilters: \[[^\]]",
}
NEVER = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def _nodes(df) -> list[tuple[int, object]]:
    """Execute ``df``; the nodes of its final adaptive plan with their depths, in order: inputs,
    then subqueries. A reused exchange or subquery stands without the nodes
    below it, and so does every further use of a cached table."""
    df.collect()
    jvm = df.sparkSession._jvm
    out, seen, todo = [], set(), [(0, df._jdf.queryExecution().executedPlan())]
    while todo:
        depth, node = todo.pop()
        out.append((depth, node))
        kind, below = node.getClass().getSimpleName(), []
        if kind == "AdaptiveSparkPlanExec":
            below = [node.executedPlan()]
        elif kind.endswith("QueryStageExec"):
            below = [node.plan()]
        elif kind == "InMemoryTableScanExec":
            cache = jvm.System.identityHashCode(node.relation().cacheBuilder())
            below = [] if cache in seen else [node.relation().cachedPlan()]
            seen.add(cache)
        elif kind not in ("ReusedExchangeExec", "ReusedSubqueryExec"):
            below = [seq.apply(i) for seq in (node.children(), node.subqueries()) for i in range(seq.size())]
        todo += [(depth + 1, p) for p in reversed(below)]
    return out


def final_plan(df) -> str:
    """The final plan as text, one node a line."""
    return "\n".join("  " * depth + node.simpleString(25) for depth, node in _nodes(df))


def file_scans(df) -> list[str]:
    """The path behind every file scan of the final plan."""
    return [node.relation().location().rootPaths().apply(0).toString() for _, node in _nodes(df)
            if node.getClass().getSimpleName() == "FileSourceScanExec"]


def audit(spark, sf_dir: str) -> list[tuple[str, dict, list[str]]]:
    from paylens.plans.registry import QUERIES
    rows = []
    for name, fn in QUERIES.items():
        if name.startswith("incremental_"):
            continue
        plan = final_plan(fn(spark, sf_dir))
        counts = {k: len(re.findall(rx, plan)) for k, rx in MARKERS.items()}
        bad = [n for n in NEVER if n in plan]
        rows.append((name, counts, bad))
    return rows


def main(argv=None):
    from paylens.session import get_session
    sf_dir = (argv or sys.argv[1:] or ["/root/testdata/sf0.01"])[0]
    spark = get_session(master="local[8]", shuffle_partitions=8)
    rows = audit(spark, sf_dir)
    print("# Plan audit\n")
    print(f"Final (adaptive) physical plans of the registered batch queries on `{sf_dir}`, produced by "
          "`python -m paylens.plans.audit`. Queries over the materialised store start from a plain "
          "Parquet scan of it. Reused exchanges and subqueries are counted once. A 'single exch' "
          "only ever sits above an aggregate (enforced in tests/test_plans.py); 'never-nodes' lists "
          "cartesian products, nested-loop joins or Python evaluation (none).\n")
    print("| query | " + " | ".join(MARKERS) + " | never-nodes |")
    print("|---|" + "---|" * (len(MARKERS) + 1))
    for name, counts, bad in rows:
        print(f"| {name} | " + " | ".join(str(counts[k]) for k in MARKERS) + f" | {', '.join(bad) or '-'} |")


if __name__ == "__main__":
    main()
