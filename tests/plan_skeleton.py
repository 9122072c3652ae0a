"""Print the executed physical plan of a registered query as a compact skeleton.

Usage: python tests/plan_skeleton.py QUERY [sf_dir]

Runs the query, then walks the final adaptive plan: one line per operator
(joins with their strategy and type, exchanges with their partitioning,
aggregates, windows, scans with their read schema). Cached relations are shown
as one leaf, not expanded.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEEP = ("Join", "Exchange", "Aggregate", "Window", "Scan", "Generate", "Union", "Limit", "Expand",
        "TakeOrdered", "Sort", "Filter")


def _children(node):
    seq = node.children()
    return [seq.apply(i) for i in range(seq.size())]


def _describe(node) -> str:
    name = node.nodeName()
    text = re.sub(r"#\d+L?", "", node.simpleString(200))
    text = re.sub(r"\[plan_id=\d+\]", "", text)
    if "Scan parquet" in text or name.startswith("FileSourceScan") or "FileScan" in text:
        m = re.search(r"ReadSchema: (struct<[^>]*>)", text)
        f = re.search(r"PushedFilters: (\[[^\]]*\])", text)
        return f"Scan parquet {m.group(1) if m else ''} pushed={f.group(1) if f else '[]'}"
    return text[:160]


def skeleton(plan, depth: int = 0, out: list | None = None) -> list:
    out = [] if out is None else out
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return skeleton(plan.executedPlan(), depth, out)
    if name in ("ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage", "TableCacheQueryStage"):
        if name == "TableCacheQueryStage":
            out.append("  " * depth + "CachedRelation")
            return out
        return skeleton(plan.plan(), depth, out)
    if name in ("InMemoryTableScan",):
        out.append("  " * depth + "CachedRelation")
        return out
    if name.startswith("WholeStageCodegen") or name in ("InputAdapter", "ColumnarToRow", "AQEShuffleRead",
                                                         "ReusedExchange", "Project"):
        if name == "ReusedExchange":
            out.append("  " * depth + "ReusedExchange (shuffle written once, read again)")
            return out
        for c in _children(plan):
            skeleton(c, depth, out)
        return out
    if any(k in name for k in KEEP):
        out.append("  " * depth + _describe(plan))
        depth += 1
    for c in _children(plan):
        skeleton(c, depth, out)
    return out


def main() -> None:
    from __spark_entry__ import queries
    from tastegraph.session import get_session

    name = sys.argv[1]
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 8, extra_conf={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    df = queries()[name](spark, sf)
    df.collect()
    print("\n".join(skeleton(df._jdf.queryExecution().executedPlan())))


if __name__ == "__main__":
    main()
