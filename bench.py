"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "feature_mart", "value": <sec>, "unit": "sec",
 "queries": {"q": sec, ...}, "total": <sum of queries>, "sf": <scale factor>}

The headline value is the flagship ``feature_mart`` query (the whole job's

All queries are first run once each (warm-up: JIT, generated code, file
cache); then each is timed as the median of ``BENCH_REPEAT`` interleaved runs
(default 3), with a full collect of its rows.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from paygrid.plans.queries import QUERIES  # noqa: E402
from paygrid.session import build_session  # noqa: E402

HEADLINE = (
    "feature_mart",
    "feature_mart_with_copies",
    "feature_mart_by_segment",
    "contract_wide",
    "upsert_features",
    "temporal_features",
    "vacancy_count",
    "market_fallback",
    "scan_base",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(f"local[{cpus}]", app_name="paygrid-bench",
                          shuffle_partitions=max(cpus, 4))
    for name in HEADLINE:   # warm-up pass over every query (JIT, codegen, file cache)
        try:
            QUERIES[name](spark, sf_dir).collect()
        except Exception:
            pass
    runs: dict[str, list[float]] = {name: [] for name in HEADLINE}
    for _ in range(repeat):   # interleaved, so a slow minute does not fall on one query
        for name in HEADLINE:
            try:
                t0 = time.perf_counter()
                QUERIES[name](spark, sf_dir).collect()
                runs[name].append(time.perf_counter() - t0)
            except Exception:  # report the failure, keep the one-line contract
                traceback.print_exc(file=sys.stderr)
    timings = {name: round(statistics.median(t), 3) if len(t) == repeat else None for name, t in runs.items()}
    # Of the flagship's time, how much is building and planning the query
    # (Python DataFrame calls + Catalyst analysis/optimisation/planning).
    planning = None
    try:
        best = float("inf")
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES["feature_mart"](spark, sf_dir)._jdf.queryExecution().executedPlan()
            best = min(best, time.perf_counter() - t0)
        planning = round(best, 3)
    except Exception:
        traceback.print_exc(file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "feature_mart",
        "value": timings["feature_mart"],
        "unit": "sec",
        "queries": timings,
        "total": round(sum(t for t in timings.values() if t is not None), 3),
        "feature_mart_planning": planning,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
