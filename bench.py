"""Benchmark: run the headline queries end to end on $BENCH_SF_DIR with
local[$BENCH_CPUS] and print one JSON line.

Each query is forced with a no-op sink (full evaluation, nothing collected) and
starts cold: intermediate tables of the queries before it are removed first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "award_board", "average_board", "team_board", "qualification_board", "championship_board",
    "pct_of_best", "events_in_period", "supplement_union", "weakest_discipline", "weakness_nested",
    "sorted_board", "json_records", "table_round_trip", "schedule_scan", "page_links", "scalable_place",
    "clean_text_docs",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from podium.session import clean_scratch, get_session
    from podium.plans import registry
    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * cpus)))
    spark = get_session("podium-bench", f"local[{cpus}]", shuffle_partitions=shuffle)
    names = sys.argv[1:] or HEADLINE
    # untimed warm-up on the smallest data set: JVM start, class loading, JIT
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in ("award_board", "table_round_trip"):
            registry.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        q = registry.QUERIES[name]
        clean_scratch(spark)
        t0 = time.time()
        q(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else None, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
