"""Headline queries, timed: BENCH_SF_DIR (default sf0.1) on local[BENCH_CPUS]. Prints one JSON line.

Each query is run once to warm up and then BENCH_RUNS times (default 3); the median counts.
Results go to the noop sink, so every column of every row is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trackline.plans.catalogue import catalogue  # noqa: E402
from trackline.session import build_session  # noqa: E402

HEADLINE = ("cycle_enrich", "incomplete_tracks", "completed_cycles", "limit_breach", "limit_breach_as_of",
            "spc_violations", "spc_lathes", "alerts", "encoded_row", "decoded_readings", "dead_letters",
            "metric_log", "control_changes", "family_union")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", f"local[{cpus}]", 8 if cpus == "*" else int(cpus), **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    known = catalogue()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        timings = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            known[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(timings[1:]), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                      "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
