"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]: median of three runs after a warm-up.

Prints one JSON line. Next to the seconds it reports each query's input rows, output rows and
shuffled bytes, taken from Spark's event log.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "result_profile",
    "agent_profile",
    "monthly_premium_rollup",
    "motor_premium_rollup",
    "claims_distinct_rollup",
    "append_new_orders",
    "premium_loads",
    "rate_decomposition",
    "rate_band_join",
    "risk_proration",
    "person_groups",
    "daily_monthly_summary",
    "latest_event_per_user",
    "commission_control",
    "stream_rollup",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="bench-")
    logs = f"{scratch}/events"
    os.mkdir(logs)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file:{logs}")
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.eventLog.compress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    from policy_mart.catalogue import QUERIES

    seconds, windows, out_rows = {}, {}, {}
    for name in HEADLINE:
        out_rows[name] = QUERIES[name](spark, sf_dir).count()
        times = []
        for _ in range(1 + RUNS):
            begin = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            windows[name] = (begin, time.time())
            times.append(windows[name][1] - begin)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    work = task_totals(logs, windows)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of median seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
                "shuffle_partitions": int(cpus),
                "output_rows": out_rows,
                "input_rows": {n: w[0] for n, w in work.items()},
                "shuffle_bytes": {n: w[1] for n, w in work.items()},
            }
        )
    )


def task_totals(logs: str, windows: dict[str, tuple[float, float]]) -> dict[str, list[int]]:
    """Records read and bytes shuffled by the tasks of each query's last run."""
    totals = {name: [0, 0] for name in windows}
    for log in Path(logs).iterdir():
        for line in log.open():
            if '"SparkListenerTaskEnd"' not in line:
                continue
            event = json.loads(line)
            metrics, launched = event.get("Task Metrics"), event["Task Info"]["Launch Time"] / 1000
            for name, (begin, end) in windows.items():
                if metrics and begin <= launched <= end:
                    totals[name][0] += metrics["Input Metrics"]["Records Read"]
                    totals[name][1] += metrics["Shuffle Write Metrics"]["Shuffle Bytes Written"]
    return totals


if __name__ == "__main__":
    main()
