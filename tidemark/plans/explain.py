"""Print a registered query's physical plan, or a digest of several.

``python -m tidemark.plans.explain SF_DIR KEY``       -> explain("formatted")
``python -m tidemark.plans.explain SF_DIR --digest K1 K2 ...``
    -> per key: exchanges, joins, windows, aggregates, Python nodes (AQE off,
       so the digest is the static plan Catalyst chose).
"""

from __future__ import annotations

import re
import sys

_NODES = ("Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
          "BroadcastNestedLoopJoin", "CartesianProduct", "Window", "WindowGroupLimit", "HashAggregate",
          "SortAggregate", "ObjectHashAggregate", "TakeOrderedAndProject", "MapInArrow", "MapInPandas",
          "BatchEvalPython", "ArrowEvalPython", "FileScan", "Scan ExistingRDD")


def digest(df) -> dict[str, int]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = {}
    for line in plan.splitlines():
        m = re.match(r"^[\s:+\-*()0-9]*([A-Za-z][A-Za-z ]*?)(?:\s|\[|\(|$)", line)
        if not m:
            continue
        name = m.group(1).strip()
        for n in _NODES:
            if name == n or name.startswith(n + " "):
                out[n] = out.get(n, 0) + 1
    ex = plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") \
        + plan.count("Exchange SinglePartition") + plan.count("Exchange RoundRobin")
    out["shuffle exchanges"] = ex
    return out


def main(argv):
    from tidemark.plans import registry
    from tidemark.session import build_session
    sf = argv[0]
    spark = build_session("local[4]", shuffle_partitions=8)
    qs = registry.queries()
    if argv[1] == "--digest":
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for k in argv[2:]:
            d = digest(qs[k](spark, sf))
            print(f"| `{k}` | " + ", ".join(f"{n} {c}" for n, c in sorted(d.items())) + " |")
    else:
        qs[argv[1]](spark, sf).explain("formatted")


if __name__ == "__main__":
    main(sys.argv[1:])
