"""Benchmark: time every registered query and the end-to-end monthly job.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is executed in full with the no-op sink (no driver collect), plan
construction included; after one warm-up run every query is timed twice and
the faster (warm) time is reported. The job run writes the kept table and
appends alarms below the checkpoint dir.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from zerobill.plans.job import run_month  # noqa: E402
from zerobill.plans.registry import QUERIES  # noqa: E402
from zerobill.run import FIXTURE_RUN  # noqa: E402
from zerobill.session import build_session, scratch_path  # noqa: E402
from zerobill.sources.fixture import fixture_sources  # noqa: E402


REPEATS = 2


def _execute(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        f"local[{cpus}]",
        app_name="zerobill-bench",
        shuffle_partitions=max(cpus, 1),
        extra={"spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    # warm-up: JIT, file listing and metadata caches
    _execute(QUERIES["q16_all_alarms"](spark, sf_dir))

    def job() -> None:
        run_month(
            spark,
            fixture_sources(spark, sf_dir),
            FIXTURE_RUN,
            scratch_path(spark, "bench_zero_invoices"),
            scratch_path(spark, "bench_alarm_final"),
        )

    runs = {name: (lambda q=query: _execute(q(spark, sf_dir))) for name, query in QUERIES.items()}
    runs["job_run_month"] = job
    def timed(table: dict) -> dict[str, float]:
        out: dict[str, float] = {}
        for _ in range(REPEATS):
            for name, run in table.items():
                t0 = time.perf_counter()
                run()
                sec = round(time.perf_counter() - t0, 3)
                out[name] = min(sec, out.get(name, sec))
        return out

    times = timed(runs)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_sec_all_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "flagship": "q16_all_alarms",
        "flagship_sec": times["q16_all_alarms"],
        "cpus": cpus,
        "timing": f"min of {REPEATS} warm runs, plan construction included",
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
