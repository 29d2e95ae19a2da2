"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced with the ``noop`` sink (full execution, no collect):
one warm-up run, then the median of ``$BENCH_REPS`` (default 1) timed runs.  Prints one
JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ("features_illuminate", "longitudinal_wide", "vector_batch_topk")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "1"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from strata.plans.catalog import load_all
    from strata.session import get_session

    spark = get_session(f"local[{cpus}]", app="strata-bench", **{
        "spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2)),
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    reg = load_all()
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name, q in reg.items():
        if only and name not in only:
            continue
        try:
            runs = []
            for i in range(reps + 1):
                t = time.perf_counter()
                q.run(spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i > 0:
                    runs.append(time.perf_counter() - t)
            times[name] = round(statistics.median(runs), 3)
        except Exception as e:  # keep going; report
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
        print(f"# {name}: {times.get(name, errors.get(name))}", file=sys.stderr, flush=True)
    head = {k: times[k] for k in HEADLINE if k in times}
    out = {
        "metric": "total_median_sec_all_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "headline": head,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": int(cpus),
        "reps": reps,
        "errors": errors,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
