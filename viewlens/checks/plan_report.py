"""Physical-plan summary of every registered query (markdown table).

    python -m viewlens.checks.plan_report --sf /root/testdata/sf0.1 > PLANS.md

Counts, per query, the shuffles by kind, join strategies, aggregate
operators, partial window limits, top-k nodes and Python stages in the
executed plan (final adaptive plan after one run). Single-partition
exchanges are listed with what they carry.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

MARKERS = [
    ("hash shuffles", r"Exchange hashpartitioning"),
    ("range shuffles", r"Exchange rangepartitioning"),
    ("single-partition", r"Exchange SinglePartition"),
    ("broadcasts", r"BroadcastExchange"),
    ("BHJ", r"BroadcastHashJoin"),
    ("SMJ", r"SortMergeJoin"),
    ("hash agg", r"\bHashAggregate"),
    ("sort agg", r"SortAggregate"),
    ("object agg", r"ObjectHashAggregate"),
    ("partial WGL", r"WindowGroupLimit .*Partial"),
    ("top-k", r"TakeOrderedAndProject"),
    ("python", r"MapInPandas|ArrowEvalPython|BatchEvalPython|PythonMapInArrow"),
]


def final_plan(plan: str) -> str:
    """Only the final adaptive plans (drop every '== Initial Plan ==' section)."""
    out, skip, depth = [], False, 0
    for ln in plan.splitlines():
        if "== Initial Plan ==" in ln:
            skip, depth = True, len(ln) - len(ln.lstrip(" :|+-"))
            continue
        if skip:
            d = len(ln) - len(ln.lstrip(" :|+-"))
            if "== Final Plan ==" in ln or d < depth:
                skip = False
            else:
                continue
        out.append(ln)
    return "\n".join(out)


def summarize(plan: str) -> dict[str, int]:
    return {name: len(re.findall(pat, plan)) for name, pat in MARKERS}


def single_partition_inputs(plan: str) -> list[str]:
    lines = [ln.strip(" :+-") for ln in plan.splitlines()]
    out = []
    for i, ln in enumerate(lines):
        if ln.startswith("Exchange SinglePartition") and i + 1 < len(lines):
            nxt = re.sub(r"#\d+L?", "", lines[i + 1])
            out.append(nxt[:90])
    return out


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    sys.path.insert(0, os.getcwd())
    from viewlens.plans.registry import QUERIES
    from viewlens.session import build_local_session
    spark = build_local_session()
    sc = spark.sparkContext
    sc.setLogLevel("ERROR")
    names = a.names or list(QUERIES)
    print(f"# Physical plans at {a.sf}\n")
    print("Final adaptive plans (`spark.sql.shuffle.partitions=8`, AQE on). `jobs before` are the jobs a query runs while it is "
          "built: written inputs, stored totals and the passes of the tile cut points; their plans are not in the other columns. "
          "`jobs` counts those of the plan itself.\n")
    print("| query | jobs before | jobs | " + " | ".join(n for n, _ in MARKERS) + " | single-partition input |")
    print("|---|" + "---|" * (len(MARKERS) + 3))
    for n in names:
        sc.setJobGroup(f"{n} before", n)
        df = QUERIES[n](spark, a.sf)
        sc.setJobGroup(f"{n} itself", n)
        execution = df._jdf.queryExecution()
        execution.toRdd().count()  # runs this very plan, which adapts it
        plan = final_plan(execution.executedPlan().toString())
        s = summarize(plan)
        jobs = [len(sc.statusTracker().getJobIdsForGroup(f"{n} {part}")) for part in ("before", "itself")]
        sp = "; ".join(single_partition_inputs(plan)) or ""
        print(f"| `{n}` | {jobs[0]} | {jobs[1]} | " + " | ".join(str(s[k]) for k, _ in MARKERS) + f" | {sp} |", flush=True)


if __name__ == "__main__":
    main()
