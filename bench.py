"""Benchmark the headline queries on whole tables.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_QUERIES`` (comma list, default the headline set),
``BENCH_EVENT_LOG_DIR`` (if set, Spark's event log is written there for
stage and task times; the UI stays off).
Each query is run to completion with the ``noop`` sink (the full plan
executes, nothing is collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "ratings",
    "rating_distribution",
    "overall_mean",
    "item_activity_histogram",
    "user_activity_histogram",
    "user_order_check",
    "user_step_violations",
    "popular_items",
    "sampled_ratings",
    "split_sizes",
    "baseline_errors",
    "top_neighbours",
    "knn_test_errors",
    "knn_errors_by_k",
    "knn_recommendations_titled",
    "knn_recommendations_for_user",
    "als_test_errors",
    "als_recommendations",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from rateflow.plans.catalog import QUERIES
    from rateflow.session import build_session, checkpoint_dir, scratch

    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "20g"),
             "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):
        extra.update({"spark.eventLog.enabled": "true",
                      "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]})
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 4 * cpus),
                          app_name="rateflow-bench", extra=extra)
    checkpoint_dir(spark)

    def run(name: str, d: str) -> float:
        with scratch(spark):    # tables that the query has written go with it
            t0 = time.perf_counter()
            QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

    # Warm the JVM (class loading, codegen) on the smallest tables; not timed.
    small = re.sub(r"sf[0-9.]+/?$", "sf0.001", sf_dir.rstrip("/"))
    if os.path.isdir(small):
        for n in ("ratings", "top_neighbours"):
            run(n, small)

    times = {}
    for name in names:
        times[name] = round(run(name, sf_dir), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    extra_out = file_check(spark, sf_dir, times)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        **extra_out,
    }))
    spark.stop()


def file_check(spark, sf_dir: str, times: dict) -> dict:
    """The original order-and-value check over a rating CSV file.

    The files hold a header and the rating view, sorted by (user, item) as the
    original rating file is and repeated with shifted user ids (``BENCH_FILE_COPIES``,
    default 34: 20 million lines at sf0.1); writing them is not timed.  The
    check (line numbers, order flags, offenders, value counts, last row) is
    timed from a cold cache.
    """
    from pyspark.sql import functions as F

    from rateflow.operators.file_order import file_order
    from rateflow.session import scratch_path
    from rateflow.sources import tpch_ratings, write_ratings

    out = scratch_path(spark, "bench_file")
    copies = int(os.environ.get("BENCH_FILE_COPIES", "34"))
    one = tpch_ratings(spark, sf_dir)
    shift = int(one.agg(F.max("user_id")).first()[0] or 0)
    many = (one.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
            .withColumn("user_id", F.col("user_id") + F.col("copy") * shift))
    write_ratings(many, out, "csv", order=["user_id", "item_id"], header=True)
    spark.catalog.clearCache()
    t0 = time.perf_counter()
    found = file_order(spark, out)
    facts = found["facts"].first()
    found["values"].collect()
    found["user_steps"].count()
    found["item_order"].count()
    dt = time.perf_counter() - t0
    times["file_order_check"] = round(dt, 3)
    print(f"# file_order_check: {dt:.3f}s over {facts['n_lines']} lines", file=sys.stderr, flush=True)
    return {"file_check_lines": int(facts["n_lines"]),
            "file_check_lines_per_sec": round(facts["n_lines"] / dt)}


if __name__ == "__main__":
    main()
