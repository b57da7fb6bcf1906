"""Summarise the executed physical plan of every registered query.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

Runs each query (no-op sink), then reads its final adaptive plan and counts
shuffles, broadcasts, join strategies, reused exchanges and the filters that
reached the file scans.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from zerobill.plans.registry import QUERIES  # noqa: E402
from zerobill.session import build_session  # noqa: E402


def plan_text(df, mode: str = "simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    text = buf.getvalue()
    return text.split("== Initial Plan ==")[0] if mode == "simple" else text


def summarise(text: str, formatted: str) -> dict:
    pushed = set()
    for line in formatted.splitlines():
        if line.startswith("PushedFilters: ["):
            body = line[len("PushedFilters: ["):-1]
            for f in re.split(r", (?=[A-Z][A-Za-z]+\()", body):
                if f and not f.startswith("IsNotNull"):
                    pushed.add(re.sub(r"#\d+L?", "", f))
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange SinglePartition", text)),
        "reused": text.count("ReusedExchange"),
        "broadcast_joins": text.count("BroadcastHashJoin"),
        "sort_merge_joins": text.count("SortMergeJoin"),
        "scans": len(set(re.findall(r"^\((\d+)\) Scan ", formatted, re.M))),
        "python": any(k in text for k in ("EvalPython", "InPandas", "PythonUDF")),
        "pushed": sorted(pushed),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["q16_all_alarms"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    print(f"# Executed plans ({sf_dir}, local[8], AQE on)\n")
    print("Generated by `tools/plan_report.py`. Counts are taken from the final")
    print("adaptive plan after running each query once with the no-op sink.\n")
    print("| Query | sec | shuffles | reused | BHJ | SMJ | scan nodes | Python | filters pushed to scans |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, query in QUERIES.items():
        df = query(spark, sf_dir)
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        sec = time.perf_counter() - t0
        # a second explain after execution shows the re-optimised plan
        df.collect()
        s = summarise(plan_text(df), plan_text(df, "formatted"))
        print(f"| {name} | {sec:.2f} | {s['shuffles']} | {s['reused']} | {s['broadcast_joins']} | "
              f"{s['sort_merge_joins']} | {s['scans']} | {'yes' if s['python'] else 'no'} | "
              f"{'; '.join(s['pushed'])} |")
    spark.stop()


if __name__ == "__main__":
    main()
