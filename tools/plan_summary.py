"""Summarise the physical plan of every registered batch query as a
markdown table: shuffles (with their keys), scanned columns, pushed
filters, and the operators that matter at scale.

    python tools/plan_summary.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

WATCH = ("Expand", "Generate", "HashAggregate", "SortAggregate", "ObjectHashAggregate",
         "Sort ", "Subquery", "BroadcastExchange", "CartesianProduct",
         "BroadcastNestedLoopJoin", "SortMergeJoin", "BroadcastHashJoin", "Window ",
         "ArrowEvalPython", "BatchEvalPython")


def summarise(text: str) -> dict:
    shuffles = []
    for m in re.finditer(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|"
                         r"RoundRobinPartitioning)\(?([^,\]]*(?:, [^,\]]*)*?)?(?:, \d+)?\)?, "
                         r"(?:ENSURE_REQUIREMENTS|REPARTITION_BY_COL)|Exchange (SinglePartition)", text):
        kind = m.group(1) or m.group(3)
        keys = re.sub(r"#\d+L?", "", m.group(2) or "")
        shuffles.append(f"{kind}({keys})" if keys else kind)
    reads = sorted(set(re.sub(r"#\d+L?", "", r) for r in re.findall(r"ReadSchema: ([^\n]*)", text)))
    pushed = sorted(set(re.findall(r"PushedFilters: (\[[^\]]*\])", text)))
    pushed += sorted(set("partition " + re.sub(r"#\d+L?", "", p) for p in
                         re.findall(r"PartitionFilters: (\[[^\]]+\])", text)))
    ops = []
    for w in WATCH:
        n = text.count(w)
        if n:
            ops.append(f"{w.strip()} x{n}")
    return {"shuffles": shuffles, "reads": reads, "pushed": pushed, "ops": ops}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from clickguard import catalog as e
    from clickguard.plans.explain import plan_text
    from clickguard.session import local_session

    spark = local_session(8)
    print("# Physical plans of the registered batch queries\n")
    print(f"Generated by `python tools/plan_summary.py {sf_dir}` (pre-AQE physical plans, "
          "`explain()`); stream queries run a streaming job and are left out.\n")
    print("| query | shuffles | columns read | pushed filters | operators |")
    print("|---|---|---|---|---|")
    for name, fn in e.queries().items():
        if name.startswith("stream_"):
            continue
        s = summarise(plan_text(fn(spark, sf_dir), "simple"))
        cell = lambda xs: "<br>".join(f"`{x}`" for x in xs) or "—"
        print(f"| {name} | {len(s['shuffles'])}: {cell(s['shuffles'])} | {cell(s['reads'])} | "
              f"{cell(s['pushed'])} | {', '.join(s['ops'])} |")


if __name__ == "__main__":
    main(sys.argv)
