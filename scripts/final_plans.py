"""Print the final (post-AQE) physical plan of registered queries, with a
count of shuffles, reused shuffles, broadcasts and Python nodes.

    python scripts/final_plans.py [sf_dir] query [query ...]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keyledger.plans.queries import QUERIES  # noqa: E402
from keyledger.session import build_session  # noqa: E402


def main():
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    extra = {"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8"}
    if os.environ.get("NO_BROADCAST") == "1":
        extra["spark.sql.autoBroadcastJoinThreshold"] = "-1"
    spark = build_session(tempfile.mkdtemp(prefix="run-"), extra=extra)
    verbose = os.environ.get("VERBOSE") == "1"
    for name in args or list(QUERIES):
        df = QUERIES[name](spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        if "== Final Plan ==" in plan:
            plan = plan.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
        shuffles = len(re.findall(r"\bExchange (hash|range|Single)", plan))
        reused = plan.count("ReusedExchange")
        bcast = plan.count("BroadcastExchange")
        python = len(re.findall(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas", plan))
        print(f"{name}: shuffles={shuffles} reused={reused} broadcasts={bcast} "
              f"python_nodes={python}")
        if verbose:
            print(plan)


if __name__ == "__main__":
    main()
