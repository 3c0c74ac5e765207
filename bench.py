"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default all registered).  Each query runs once
with a ``noop`` write (full execution, nothing collected).  Prints one JSON line.  No query is
started after BENCH_BUDGET seconds (default 1500); those are named under ``not_run``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from boxframe.plans.catalog import queries  # noqa: E402
from boxframe.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cpus, app="boxframe-bench")
    qs = queries()
    names = wanted or list(qs)
    # warm-up (untimed): JVM start, JIT and Python workers are not part of any query
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        for name in ("voc_eval", "apply_model"):
            qs[name](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    begin, budget, not_run = time.perf_counter(), float(os.environ.get("BENCH_BUDGET", "1500")), []
    errors: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        if t0 - begin > budget:
            not_run.append(name)
            continue
        try:
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001
            errors[name] = repr(e)[:200]
    sf = sf_dir.rsplit("sf", 1)[-1]
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus}
    if errors:
        out["errors"] = errors
    if not_run:
        out["not_run"] = not_run
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
