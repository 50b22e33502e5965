"""Digest of final AQE plans (exchanges, joins, aggregates, scans) for PLANS.md.

    python tools/plan_digest.py [--sf /root/testdata/sf0.01] name ...

Runs with size-based broadcast disabled, i.e. the plan large tables get.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = ("Exchange", "Join", "ReusedExchange", "HashAggregate", "FileScan", "Generate", "Union", "Filter")


def digest(plan: str) -> list[str]:
    final = plan.split("== Initial Plan ==")[0]
    out = []
    for line in final.splitlines():
        if any(k in line for k in KEEP):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r", \[plan_id=\d+\]", "", line)
            line = re.sub(r"Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/", "Location: [", line)
            out.append(line.rstrip()[:190])
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="+")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    a = ap.parse_args()
    from tidemark.plans import registry
    from tidemark.session import build_session

    spark = build_session("local[8]", shuffle_partitions=16, extra={
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    registry.load_all()
    for n in a.names:
        df = registry.QUERIES[n](spark, a.sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"### {n}\n\n```")
        print("\n".join(digest(plan)))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
