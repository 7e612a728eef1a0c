"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query runs to completion through the ``noop`` sink (the whole plan executes,
nothing is collected); one untimed warm-up pass over all queries runs first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "growth_daily_totals",
    "growth_adset_daily",
    "marketing_fact_daily",
    "daily_acquisition",
    "marketing_fact_ad",
    "growth_ad_daily",
    "weekly_acquisition",
    "pull_dedupe",
    "cost_preserving_replace",
    "export_parity",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from marketlake import catalog
    from marketlake.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="marketlake-bench")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    failed: dict[str, str] = {}
    for n in names:  # warm-up pass: JIT, codegen, class loading, file listing cache
        try:
            run(n)
        except Exception as e:  # keep benchmarking the others; report the failure
            failed[n] = f"{type(e).__name__}: {str(e)[:200]}"
    times = {n: round(run(n), 3) for n in names if n not in failed}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    extra = {"failed": failed} if failed else {}
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        **extra,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
