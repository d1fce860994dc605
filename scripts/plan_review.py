"""Physical-plan shape of every bound query, as it would plan on large inputs.

Spark's estimate-based broadcast (``autoBroadcastJoinThreshold``) and AQE are
switched off, so the plan shows only the library's own choices: explicit,
size-checked broadcasts; everything else is a shuffle join.  Prints a
Markdown table: shuffles, broadcasts, join kinds, aggregates, generators and
whether a filter reached a Parquet scan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rollcall import build_session  # noqa: E402
from rollcall.plans.bindings import QUERIES  # noqa: E402


def shape(plan: str) -> dict[str, int]:
    count = lambda pat: len(re.findall(pat, plan))
    return {
        "shuffles": count(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition"),
        "broadcasts": count(r"BroadcastExchange"),
        "smj": count(r"SortMergeJoin"),
        "bhj": count(r"BroadcastHashJoin"),
        "hash_agg": count(r"HashAggregate\(") // 2,
        "sort_agg": count(r"SortAggregate\(") // 2,
        "generate": count(r"Generate "),
        "pushed": count(r"PushedFilters: \[[^\]]"),
    }


def main(sf_dir: str) -> None:
    spark = build_session("local[8]", shuffle_partitions=8, conf={
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"})
    cols = ["shuffles", "broadcasts", "smj", "bhj", "hash_agg", "sort_agg", "generate", "pushed"]
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, query in QUERIES.items():
        df = query(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = shape(plan)
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
