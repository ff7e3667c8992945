"""Benchmark: build the warehouse from the given tables, then run every report.

Prints one JSON line. ``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the number
of local threads. The build is timed as ``pipeline``, and its parts under ``steps``; it stages,
cleans and validates all sales, customers and products, and loads dimensions, facts and daily
aggregates. Reports read the stored warehouse, as they would in daily use, and are drained
completely.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import queries  # noqa: E402
from checks.sample import sample  # noqa: E402
from starloom.plans.pipeline import together  # noqa: E402
from starloom.session import local_session  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus, **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    built, steps = sample(spark, folder), {}
    for name, step in (
        ("staging and dimensions", lambda: together(
            spark, lambda: built.customer, lambda: built.product, lambda: built.sales)),
        ("facts", lambda: built.fact), ("aggregates", lambda: built.aggregates),
    ):
        start = time.perf_counter()
        step()
        steps[name] = round(time.perf_counter() - start, 3)
    times["pipeline"] = round(sum(steps.values()), 3)
    for name, run in queries.registered().items():
        start = time.perf_counter()
        run(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)

    print(json.dumps({
        "metric": "pipeline and reports, total", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "steps": steps, "sf": folder.rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
