"""Benchmark the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

The adapters' three inputs (customer feed, sales feed, dimension) are written once
beforehand, as a day's inputs would lie there, so that the times are the engine's;
what writing them took is reported beside (``prepare``) and not part of the total.

Each query is built and then fully executed with a ``noop`` write (no driver
collect). Plan-time work (size checks, key base, checkpoints) counts. One
untimed warm-up run of the flagship comes first. ``full_run_publish`` is the
whole daily run: dimension, fact and error log written once each (to fresh
folders every time). Every query runs ``BENCH_RUNS`` times (default 3) and its
median is reported, so one slow outlier on a shared machine does not decide
the number.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from dimflow.plans import Targets, plan, publish  # noqa: E402
from dimflow.plans.queries import PARAMS, REGISTRY, fixture_inputs  # noqa: E402
from dimflow.session import local_session, scratch_path  # noqa: E402
from dimflow.sources.fixtures import prepare  # noqa: E402

HEADLINE = [
    "sales_fact_post_load",
    "sales_fact_aggregate",
    "lookup_enrich",
    "lookup_reject",
    "dq_reject",
    "change_capture",
    "surrogate_keys_distributed",
    "dim_after_load",
    "error_funnel",
    "load_audit",
]


def _run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = max(1, int(os.environ.get("BENCH_RUNS", "3")))
    spark = local_session(cpus, app="dimflow-bench", shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16)

    t0 = time.perf_counter()
    inputs = prepare(spark, sf_dir, scratch_path(spark, "bench_inputs"))
    prepared = round(time.perf_counter() - t0, 3)
    _run_noop(REGISTRY["sales_fact_post_load"](spark, inputs))  # warm-up, untimed

    def full_run() -> None:
        targets = Targets(dimension_root=scratch_path(spark, "bench_dim"),
                          fact_path=scratch_path(spark, "bench_fact"), error_dir=scratch_path(spark, "bench_err"))
        publish(plan(fixture_inputs(spark, inputs), PARAMS), targets, PARAMS)

    jobs = {name: (lambda name=name: _run_noop(REGISTRY[name](spark, inputs))) for name in HEADLINE}
    jobs["full_run_publish"] = full_run
    samples: dict[str, list[float]] = {name: [] for name in jobs}
    for _ in range(runs):
        for name, job in jobs.items():
            t0 = time.perf_counter()
            job()
            samples[name].append(time.perf_counter() - t0)
    timings = {name: round(statistics.median(ts), 3) for name, ts in samples.items()}

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "stat": "median",
        "prepare": prepared,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
