"""Write PLANS.md: the final (adaptive) physical plan of every registered query.

    python tools/plan_report.py [sf_dir] > PLANS.md

Each query is executed once (through its own QueryExecution, so the plan
shown is AQE's final plan), then summarised: shuffles, broadcasts, joins,
map-side limits, generators, Python nodes, and the columns each scan reads.
"""

from __future__ import annotations

import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

NODE = re.compile(r"^[\s:+\-|]*(\*\(\d+\) )?([A-Za-z]+)")


def summarise(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange SinglePartition|Exchange rangepartitioning", plan)),
        "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
        "joins": sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", plan))),
        "map_side_limit": "WindowGroupLimit" in plan and "Partial" in plan,
        "python": bool(re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython", plan)),
        "scans": sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))),
    }


def compact(plan: str) -> list[str]:
    out = []
    for line in plan.split("\n"):
        if not line.strip() or "ReadSchema" in line and "FileScan" not in line:
            continue
        m = re.match(r"^([\s:+\-|]*)(.*)$", line)
        text = m.group(2)
        text = re.sub(r"\[[^\]]{60,}\]", "[...]", text)
        out.append((m.group(1) + text)[:140])
    return out


def main(argv):
    from tallyflow.session import get_session
    from tallyflow.plans import catalog
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=8)
    print(f"# Physical plans (AQE final) at `{sf_dir}`\n")
    print("Produced by `tools/plan_report.py` on local[8], shuffle partitions 8, static broadcast off "
          "(`tallyflow.session.DEFAULT_CONF`). *shuffles* counts hash/single/range exchanges.\n")
    print("| query | shuffles | broadcasts | joins | map-side top-N | Python | sec |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    details = []
    for name, fn in catalog.QUERIES.items():
        df = fn(spark, sf_dir)
        qe = df._jdf.queryExecution()
        t0 = time.perf_counter()
        qe.toRdd().count()
        sec = time.perf_counter() - t0
        full = qe.executedPlan().toString()
        plan = full.split("== Initial Plan ==")[0]
        s = summarise(plan)
        s["scans"] = summarise(full)["scans"]
        print(f"| `{name}` | {s['shuffles']} | {s['broadcasts']} | "
              f"{', '.join(s['joins']) or '-'} | {'yes' if s['map_side_limit'] else '-'} | "
              f"{'yes' if s['python'] else 'no'} | {sec:.2f} |")
        details.append((name, s, compact(plan)))
    print()
    for name, s, lines in details:
        print(f"## `{name}`\n")
        print("Scans read: " + "; ".join(f"`{x}`" for x in s["scans"]) + "\n")
        print("```")
        print("\n".join(lines))
        print("```\n")


if __name__ == "__main__":
    main(sys.argv)
