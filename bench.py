"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR  input folder (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores  (default 8)

Each query runs once to warm up and then twice; the faster run counts. Results are written to a
``noop`` sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINES = (
    "flagship",
    "cost_burden",
    "spending_by_quintile",
    "balance_by_decile",
    "calendar_year_mean",
    "linearized_means",
    "weighted_quantiles",
    "midpoint_deciles",
    "midpoint_deciles_ranged",
    "replicate_decile_means",
    "replicate_decile_means_ranged",
    "median_by_group",
    "baseline_index",
    "latest_per_user",
    "attach_child_totals",
    "table_contract",
    "benchmark_gates",
    "sdmx_series",
    "jsonstat_cells",
    "page_links",
    "main_texts",
    "document_search",
    "release_fingerprints",
    "promoted_releases",
)


def replicates_160(spark, sf_dir):
    """The survey's probe: 160 replicate ratio estimates in three groups."""
    from tallyloom.operators import estimators as E
    from tallyloom.workload.statistics import design, high_discount

    return design("sdr", count=160).estimate(
        high_discount(spark, sf_dir), lambda w: E.weighted_mean("hit", w), ["l_returnflag"], ["hit"]
    )


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    # Spark and the JVM write to stdout at times; keep it for the result line.
    out = os.dup(1)
    os.dup2(2, 1)
    from tallyloom.session import local_session
    from tallyloom.workload import load_all

    queries = load_all()
    spark = local_session("bench", CPUS, **{"spark.ui.showConsoleProgress": "false"})
    jobs = {"replicates_160": replicates_160, **{name: queries[name].run for name in HEADLINES}}
    seconds = {}
    for name, run in jobs.items():
        timed(lambda: run(spark, SF_DIR))
        seconds[name] = round(min(timed(lambda: run(spark, SF_DIR)) for _ in range(2)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    line = {
        "metric": "headline query seconds, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }
    os.write(out, (json.dumps(line) + "\n").encode())


if __name__ == "__main__":
    main()
