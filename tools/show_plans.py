"""Print the final (adaptive) physical plans of the headline queries as operator trees.

Usage: python tools/show_plans.py [sf_dir] > PLANS.md
Each query is executed once (``collect``) so the adaptive plan is final, then its tree is printed
with operator names and key arguments only.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from quarry.plans import catalog  # noqa: E402
from quarry.session import get_session  # noqa: E402

HEADLINE = ["postings", "index_dump", "and_query", "and_query_semijoin", "tfidf", "kmeans_assign",
            "tokens_paged", "link_class"]
KEEP = re.compile(r"(Exchange|BroadcastExchange|BroadcastHashJoin|SortMergeJoin|HashAggregate|"
                  r"ObjectHashAggregate|SortAggregate|Window|Generate|Scan|FileScan|AQEShuffleRead|"
                  r"TakeOrderedAndProject|Union|Filter|BroadcastQueryStage|ShuffleQueryStage|"
                  r"InMemoryTableScan|Project|Sort|WholeStageCodegen|ColumnarToRow)")


def condense(line: str) -> str | None:
    m = re.match(r"^([\s:+\-*()0-9]*)([A-Za-z][A-Za-z]*)(.*)$", line)
    if not m or not KEEP.search(m.group(2)):
        return None
    prefix, op, rest = m.groups()
    detail = ""
    if op in ("Exchange",):
        detail = " " + re.sub(r", \[plan_id=\d+\]", "", rest.strip())[:80]
    elif op in ("BroadcastHashJoin", "SortMergeJoin"):
        detail = " " + rest.strip()[:80]
    elif op.endswith("Aggregate"):
        k = re.search(r"keys=\[([^\]]*)\]", rest)
        detail = f" keys=[{k.group(1)}]" if k else ""
    elif op == "FileScan":
        detail = " " + " ".join(rest.split()[:1])
    elif op == "Project" or op == "Filter" or op == "Generate":
        detail = ""
    return f"{prefix}{op}{detail}"


def squeeze(lines: list[str]) -> list[str]:
    """Collapse chains of the same operator (e.g. the Porter step projections) into one line."""
    out, prev, count = [], None, 0
    for ln in lines:
        op = ln.strip(" :+-*()0123456789")
        if op == prev and op in ("Project", "Filter"):
            count += 1
            continue
        if count > 1:
            out[-1] += f"  (x{count})"
        out.append(ln)
        prev, count = op, 1
    if count > 1:
        out[-1] += f"  (x{count})"
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    print(f"# Physical plans (final adaptive plans, {sf}, local[8])\n")
    print("Generated by `tools/show_plans.py`. Operators only; expressions omitted. Steps a query runs")
    print("before its final job (materializing the index or the postings of a batch) are separate plans not shown.\n")
    for name in HEADLINE:
        df = catalog.CATALOG[name](spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]
        lines = squeeze([c for c in (condense(x) for x in plan.splitlines()) if c])
        print(f"## {name}\n\n```")
        print("\n".join(lines))
        print("```\n")


if __name__ == "__main__":
    main()
