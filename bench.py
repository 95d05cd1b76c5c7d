"""Benchmark: run every registered query at ``$BENCH_SF_DIR`` and print one JSON line.

Each query is executed to completion with the ``noop`` sink (full plan, no
collect). One warm-up run, then ``$BENCH_RUNS`` (default 3) timed runs; the
reported per-query time is the median. ``value`` is the sum of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from rosterflow.plans.registry import all_queries
    from rosterflow.session import get_session

    n_cpus = int(cpus) if cpus.isdigit() else (os.cpu_count() or 8)
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", n_cpus)))
    qs = all_queries()
    names = only or list(qs)
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        try:
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()   # warm-up
            samples = []
            for _ in range(runs):
                t0 = time.perf_counter()
                qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                samples.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(samples), 4)
        except Exception as e:  # keep going; report the failure
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = Path(sf_dir).name.replace("sf", "")
    out = {"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 4), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir,
           "cpus": n_cpus, "runs": runs}
    if "fuzzy_pairs" in times:
        out["baseline"] = {"fuzzy_pairs": {"ours_sec": times["fuzzy_pairs"], "baseline_blocked_sec": 0.82,
                                           "baseline_brute_force_sec": 15.27, "baseline_sf": 0.1}}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
