"""Benchmark the headline queries; print ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is planned fresh and run with ``write.format("noop")`` (every
output column is produced, nothing is collected).  One warm-up pass over all
queries, then ``BENCH_RUNS`` (default 5) interleaved rounds; each query
reports its median.  ``value`` is the sum of the
headline medians; the ``*_window`` / ``*_two_step`` entries time the other
strategies of the same relations and are not in the sum (``pdv_normalised_join``
is the literal self-join form of the normalisation).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["pdv_normalised", "latest_pdv", "latest_estab", "client_accounts", "pdv_emps",
            "revenue_matrix"]
EXTRA = ["pdv_normalised_window", "pdv_normalised_join", "latest_pdv_window",
         "latest_estab_window", "exit_ranks", "exit_ranks_window", "exit_ranks_split",
         "pdv_normalised_split", "revenue_matrix_two_step"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    from pyspark.sql import SparkSession

    from possum.plans.queries import QUERIES
    from possum.plans.session import apply_recommended

    # The checkpoint folder comes from the session (spark.checkpoint.dir);
    # possum.plans.session.checkpoint_dir only fills in a local one if unset.
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName("possum-bench")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "8g")
               .config("spark.sql.shuffle.partitions", str(max(8, 2 * cpus)))
               .config("spark.sql.session.timeZone", "UTC"))
    spark = apply_recommended(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    def once(key: str) -> float:
        t0 = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    keys = HEADLINE + EXTRA
    errors: dict[str, str] = {}
    for key in keys:
        try:
            once(key)
        except Exception as exc:  # report, keep benchmarking the others
            errors[key] = f"{type(exc).__name__}: {str(exc)[:200]}"
    samples: dict[str, list[float]] = {k: [] for k in keys if k not in errors}
    for _ in range(runs):
        for key in list(samples):
            try:
                samples[key].append(once(key))
            except Exception as exc:
                errors[key] = f"{type(exc).__name__}: {str(exc)[:200]}"
                del samples[key]
    timings = {k: round(statistics.median(v), 3) for k, v in samples.items() if v}
    setup = {
        "spark_version": spark.version,
        "master": spark.sparkContext.master,
        "driver_memory": spark.sparkContext.getConf().get("spark.driver.memory", "default"),
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
        "aqe": spark.conf.get("spark.sql.adaptive.enabled"),
        "warm": True,
        "statistic": f"median of {runs} interleaved runs after one warm-up pass",
        "action": "write.format('noop')",
    }
    spark.stop()
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.get(k, 0.0) for k in HEADLINE), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "headline": HEADLINE,
        "complete": not errors,
        "errors": errors,
        "setup": setup,
    }))


if __name__ == "__main__":
    main()
