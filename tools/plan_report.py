"""Summarise the final (adaptive) physical plan of every catalog query.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from augur.plans.catalog import QUERIES  # noqa: E402
from augur.session import build_session  # noqa: E402


def final_lines(plan: str) -> list[str]:
    """The lines that ran: every nested adaptive plan (subqueries have their
    own) prints its final and then its initial plan; the initial ones end
    where the indentation falls back to that of their heading."""
    out, skip = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if "== Initial Plan ==" in line and skip is None:
            skip = depth
        if skip is not None and line.strip() and depth < skip:
            skip = None
        if skip is None:
            out.append(line)
    return out


def summarise(plan: str) -> dict:
    lines = final_lines(plan)
    ex = [x for x in lines if re.search(r"\bExchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", x)]
    return {
        "hash": sum("hashpartitioning" in x for x in ex),
        "range": sum("rangepartitioning" in x for x in ex),
        "single": sum("SinglePartition" in x for x in ex),
        "reused": sum("ReusedExchange" in x for x in lines),
        "bcast": sum("BroadcastExchange" in x for x in lines),
        "smj": sum("SortMergeJoin" in x for x in lines),
        "bhj": sum("BroadcastHashJoin" in x for x in lines),
        "window": sum(re.search(r"\bWindow \[", x) is not None for x in lines),
        "pushed": sorted({p for x in lines for p in re.findall(r"PushedFilters: \[([^\]]+)\]", x) if p}),
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("plan-report", "local[8]", 8)
    print(f"# Final physical plans ({os.path.basename(sf_dir)}, local[8], AQE)\n")
    print("Counts of exchanges by kind in each query's final adaptive plan (generated by")
    print("`tools/plan_report.py`). `single` exchanges carry at most one row per task or per")
    print("file: the final merge of a global (ungrouped) aggregate, or the per-file offset table")
    print("of dense keys. The range exchange of a dense key runs in the job that writes the")
    print("sorted ranges, so it is not part of the plans below; so do tables a query writes first.")
    print("Subqueries count. `window` counts window operators: the offset window over one row per")
    print("range file, and the per-range numbering of update sequences. Joins are chosen by AQE at")
    print("runtime; at this scale every dimension is under the broadcast threshold.\n")
    print("| query | hash | range | single | reused | broadcast | SMJ | BHJ | window | pushed filters |")
    print("|---|---|---|---|---|---|---|---|---|---|")
    for name in sorted(QUERIES):
        df = QUERIES[name](spark, sf_dir)
        df.collect()
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        pushed = "; ".join(p[:60] for p in s["pushed"] if p != "IsNotNull(user_id)")[:120]
        print(f"| {name} | {s['hash']} | {s['range']} | {s['single']} | {s['reused']} | {s['bcast']} | "
              f"{s['smj']} | {s['bhj']} | {s['window']} | {pushed} |")
    spark.stop()


if __name__ == "__main__":
    main()
