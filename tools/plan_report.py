"""Plan shapes of every registered analysis (after execution, AQE final
plan), written as a Markdown table: shuffles, scans, join strategies,
pushed filters, codegen stages and Python operators.

    python tools/plan_report.py [--sf /root/testdata/sf0.1] [--out PLANS.md]
"""

from __future__ import annotations

import argparse
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.registry import load_all  # noqa: E402
from tidemark.session import get_session  # noqa: E402


def nodes(df) -> list[tuple[str, str]]:
    """(class, description) of every node of the plan that ran, subqueries
    included, adaptive wrappers taken off."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    items = lambda seq: [seq.apply(i) for i in range(seq.size())]
    while todo:
        n = todo.pop()
        name = n.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(n.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(n.plan())
        else:
            out.append((name, n.simpleString(10_000) if name == "FileSourceScanExec" else ""))
            if name != "ReusedExchangeExec":
                todo += items(n.children()) + items(n.subqueries())
    return out


def shape(plan: list[tuple[str, str]]) -> dict:
    names = [n for n, _ in plan]
    return {
        "shuffles": names.count("ShuffleExchangeExec"),
        "reused": names.count("ReusedExchangeExec"),
        "scans": names.count("FileSourceScanExec"),
        "bhj": names.count("BroadcastHashJoinExec"),
        "smj": names.count("SortMergeJoinExec"),
        "shj": names.count("ShuffledHashJoinExec"),
        "nlj": names.count("BroadcastNestedLoopJoinExec") + names.count("CartesianProductExec"),
        "pushed": sum(bool(re.search(r"PushedFilters: \[[^\]]+\]", d)) for n, d in plan if n == "FileSourceScanExec"),
        "codegen": names.count("WholeStageCodegenExec"),
        "python": sum(bool(re.search("Python|Pandas|Arrow", n)) for n in names),
        "window_group_limit": names.count("WindowGroupLimitExec"),
    }


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--out", default="PLANS.md")
    a = ap.parse_args()
    spark = get_session()
    reg = load_all()
    lines = ["# Plan shapes (AQE final plans, " + Path(a.sf).name + ", local)", "",
             "Generated by `tools/plan_report.py`. Columns: shuffle exchanges, reused exchanges, parquet scans, "
             "broadcast-hash / sort-merge / shuffled-hash / nested-loop joins, scans with pushed filters, "
             "whole-stage-codegen stages, Python operators, partial top-k (WindowGroupLimit), seconds.", "",
             "| analysis | shuffles | reused | scans | BHJ | SMJ | SHJ | NLJ | pushed | codegen | python | wgl | s |",
             "|---|---|---|---|---|---|---|---|---|---|---|---|---|"]
    for n in sorted(reg):
        df = reg[n].build(spark, a.sf)
        t0 = time.perf_counter()
        # run the DataFrame's own physical plan (rows stay in the executors)
        # so the adaptive plan read below is the final one
        df._jdf.queryExecution().toRdd().count()
        el = time.perf_counter() - t0
        s = shape(nodes(df))
        lines.append(f"| {n} | {s['shuffles']} | {s['reused']} | {s['scans']} | {s['bhj']} | {s['smj']} | {s['shj']} | "
                     f"{s['nlj']} | {s['pushed']} | {s['codegen']} | {s['python']} | {s['window_group_limit']} | "
                     f"{el:.2f} |")
    Path(a.out).write_text("\n".join(lines) + "\n")
    print(f"wrote {a.out}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
