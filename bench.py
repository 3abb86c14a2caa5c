"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is built and fully executed (``noop`` sink, so nothing is
gathered on the driver); queries that write derived inputs include that time.
A first run of the flagship query warms the JVM up and is reported apart.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shapekit.plans.catalog import QUERIES  # noqa: E402
from shapekit.session import get_session  # noqa: E402

HEADLINE = [
    "quality_rates",       # flagship: strict + lenient validation, verdict join, per model x phase
    "validate_api",
    "json_block",
    "pair_join",           # tolerant CSV + tagged text + last-wins + blacklist + pair join + gold JSON
    "removal_report",
    "train_examples",      # chat render + tokenise + pad + label mask
    "split_hash",
    "leak_check",
    "gold_score",
    "grounding",
    "ledger_reconcile",
    "score_retry",
    "service_retry",
    "stream_quality",
    "stream_assemble",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="shapekit-bench-")}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):  # stage/task times for later reading, no UI
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]})
    spark = get_session(f"local[{cpus}]", cpus, app_name="shapekit-bench", extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    t0 = time.time()  # start of the JVM's code, told apart
    QUERIES["quality_rates"](spark, sf_dir).limit(1).collect()
    warm = round(time.time() - t0, 3)
    times = {}
    for name in names:
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "warm_up_sec": warm, "sf": float(m.group(1)) if m else None}))


if __name__ == "__main__":
    main()
