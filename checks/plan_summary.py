"""Summarise the executed (adaptive, final) plan of registered queries.

    python -m checks.plan_summary [sf_dir] [key ...]

Per key: shuffle exchanges, reused exchanges, broadcasts, windows, sort
aggregates and scans in the final plan, after running it once.
"""

from __future__ import annotations

import re
import sys


def summarise(plan: str) -> dict[str, int]:
    final = plan.split("== Initial Plan ==")[0]
    return {
        "shuffles": len(re.findall(r"Exchange (hash|range|single|round)", final))
                    - len(re.findall(r"ReusedExchange \[[^\n]*Exchange (hash|range)", final)),
        "reused": final.count("ReusedExchange"),
        "broadcasts": final.count("BroadcastExchange"),
        "bhj": final.count("BroadcastHashJoin"),
        "smj": final.count("SortMergeJoin"),
        "windows": len(re.findall(r"\bWindow \[", final)),
        "sort_aggs": final.count("SortAggregate("),
        "scans": final.count("FileScan parquet"),
    }


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    only = argv[1:]
    sys.path.insert(0, ".")
    from pyspark.sql import SparkSession

    from possum.plans.queries import QUERIES
    from possum.plans.session import apply_recommended

    spark = (apply_recommended(SparkSession.builder.master("local[8]"))
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "16")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    for key in only or list(QUERIES):
        df = QUERIES[key](spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"{key:26s} " + " ".join(f"{k}={v}" for k, v in summarise(plan).items()), flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
