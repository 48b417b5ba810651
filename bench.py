"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from jobloom.plans import load_queries  # noqa: E402
from jobloom.session import local_session  # noqa: E402

#: label -> registered query
HEADLINE = {
    "b1_flagship_dedupe": "flagship_portal_facet",
    "b2_upsert": "jon_01_upsert",
    "b2_prune": "flt_07_retention_prune",
    "b3_snapshot": "snk_01_snapshot_rows",
    "b4_search": "flt_09_faceted_search",
    "b4_facets": "agg_04_facet_counts",
    "b5_area_scoring": "cls_02_area_scoring",
    "b6_text_join": "jon_09_text_theta_join",
    "b6_confidence": "fit_06_confidence",
    "b7_rank": "fit_10_rank",
    "b8_snapshot_rules": "val_01_snapshot_rules",
    "b8_index_rules": "val_02_index_rules",
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    queries = load_queries()[0]
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    seconds: dict[str, float] = {}
    for label, name in HEADLINE.items():
        times = []
        for attempt in range(runs + 1):
            started = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            if attempt:  # the first run warms up
                times.append(time.perf_counter() - started)
        seconds[label] = round(statistics.median(times), 3)
        print(f"{label}: {seconds[label]}", file=sys.stderr)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
