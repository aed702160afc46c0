"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with per-query wall-clock seconds.

Each query is fully executed through the ``noop`` sink (no collect to the
driver).  The first run of each query warms the JVM for that plan shape and
is not counted; the reported time is the best of ``$BENCH_REPEAT`` runs.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "air01_top_airports_star",
    "air02_carriers_star",
    "air03_dests_star",
    "air04_carriers_on_route_star",
    "air06_itinerary",
    "air08_daily_delay",
    "agg04_word_count",
    "agg09_log_stats",
    "joi01_join_inner",
    "srt04_top_k_per",
    "fea02_regex_tokenize",
    "eva04_ranking",
    "grf02_pagerank",
    "grf05_triangles",
    "str02_running_word_count",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    from skyframe.session import get_session
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                        conf={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g"),
                              "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")})
    from skyframe.plans.registry import QUERIES

    times = {}
    for name in HEADLINE:
        fn = QUERIES[name]
        best = None
        for i in range(repeat + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0 or repeat == 0:
                best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
