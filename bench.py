"""Wall seconds of the registered queries at one scale; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_QUERIES (comma list, default all).
Shared layers are written before and timed on their own, as ``layer_<name>``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickloom import catalog
from clickloom.catalog import GAP, RUN_TIMESTAMP, WIDE_GAP
from clickloom.session import local_session
from clickloom.sources.layers import Layers


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    spark = local_session("clickloom-bench", cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    registered = catalog.queries()
    names = chosen.split(",") if chosen else list(registered)

    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor before timing
    seconds: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    layers = Layers(spark, sf_dir)
    for name, make in {
        "raw": layers.raw,
        "raw_events": layers.valid,
        "pipeline_logs": lambda: layers.log(RUN_TIMESTAMP),
        "stg_events": layers.stg,
        "dim_user_map": layers.user_map,
        "dim_sessions": lambda: layers.sessions(GAP),
        "dim_sessions_gap240": lambda: layers.sessions(WIDE_GAP),
        "purchases": layers.purchases,
        "fct_attribution": lambda: layers.attribution(GAP),
        "fct_attribution_gap240": lambda: layers.attribution(WIDE_GAP),
        "fct_order_items": layers.order_items,
        "session_minutes": lambda: layers.session_minutes(GAP),
        "session_minutes_gap240": lambda: layers.session_minutes(WIDE_GAP),
    }.items():
        timed(f"layer_{name}", make)
    for name in names:
        timed(name, lambda: registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save())

    print(json.dumps({
        "metric": "clickstream_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
