"""Print a registered query's physical plan (after running it, so AQE's final plan shows).

    python tools/explain.py coalesce_upsert [--sf /root/testdata/sf0.1] [--mode formatted]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("name")
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--mode", default="formatted")
    ap.add_argument("--no-run", action="store_true")
    ap.add_argument("--big", action="store_true", help="no size-based broadcast: the plan large tables get")
    a = ap.parse_args()
    from tidemark.plans import registry
    from tidemark.session import build_session

    extra = {}
    if a.big:
        extra = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    spark = build_session("local[8]", shuffle_partitions=16, extra=extra)
    registry.load_all()
    df = registry.QUERIES[a.name](spark, a.sf)
    if not a.no_run:
        df.collect()  # same QueryExecution, so explain shows AQE's final plan
    df.explain(a.mode)
    spark.stop()


if __name__ == "__main__":
    main()
