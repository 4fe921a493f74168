"""Write PLANS.md: a per-query summary of the physical plans (before AQE) at one scale.

    python tools/plan_report.py [sf_dir]
"""
import re
import sys
from collections import Counter

sys.path.insert(0, "/root/repo")

from martkit.session import build_session  # noqa: E402
from martkit.plans.queries import REGISTRY  # noqa: E402

OPS = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition", "BroadcastExchange",
       "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
       "HashAggregate", "ObjectHashAggregate", "SortAggregate", "Window", "Generate", "TakeOrderedAndProject",
       "ArrowEvalPython", "BatchEvalPython"]
SHORT = {"Exchange hashpartitioning": "hash exch", "Exchange rangepartitioning": "range exch",
         "Exchange SinglePartition": "single exch", "BroadcastExchange": "bcast exch", "SortMergeJoin": "SMJ",
         "BroadcastHashJoin": "BHJ", "ShuffledHashJoin": "SHJ", "BroadcastNestedLoopJoin": "BNLJ",
         "CartesianProduct": "cartesian", "HashAggregate": "hash agg", "ObjectHashAggregate": "obj agg",
         "SortAggregate": "sort agg", "Window": "window", "Generate": "generate", "TakeOrderedAndProject": "top-k",
         "ArrowEvalPython": "py arrow", "BatchEvalPython": "py udf"}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 16)
    lines = ["# Physical plans", "",
             f"Generated by `tools/plan_report.py` from `{sf}` (plans before adaptive re-planning; broadcast",
             "choices here come from file-size estimates, and AQE may change them at run time).",
             "Counts are operator occurrences. No plan contains a cartesian product, a nested-loop join or a",
             "Python evaluation node (also asserted in `tests/test_plans.py`); the one window (control table)",
             "runs over one flag per table.", "",
             "| query | operators | scans: pushed filters |", "| --- | --- | --- |"]
    for name in sorted(REGISTRY):
        plan = REGISTRY[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        c = Counter(op for op in OPS for _ in re.finditer(re.escape(op) + r"\b", plan))
        ops = ", ".join(f"{SHORT[o]} {c[o]}" for o in OPS if c[o])
        pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)) - {""})
        lines.append(f"| {name} | {ops or '-'} | {'; '.join(p[:90] for p in pushed) or '-'} |")
    open("/root/repo/PLANS.md", "w").write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
