"""Time the headline queries and print one JSON line.

``queries`` are wall-clock seconds of a full run to a no-op sink at ``$BENCH_SF_DIR`` (median of three, warm
session). ``samples_per_sec`` is the detection pipeline over a hundred copies of the devices of that
table, 1000-sample windows, next to the published target of 1000 samples per second.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import functions as F

from catalog import queries as q
from tremorline.plans.detection import detect
from tremorline.session import build_session, new_folder
from tremorline.sources.samples import to_samples

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "100"))

HEADLINE = [
    "samples",
    "count_window_features",
    "dominant_frequency",
    "detect_anomalies",
    "confusion_metrics",
    "metrics_report",
    "rolling_count_window",
    "latest_n",
    "buffer_depth",
    "time_window_features",
    "device_feature_defaults",
    "fault_labels",
    "crowded_device_features",
    "crowded_rolling_window",
    "payload_json",
    "partition_keys",
    "archive_quarantine",
    "archive_scan",
    "fifo_order",
    "peek_oldest",
    "pending_batches",
    "dedupe_redelivery",
    "stream_count_window",
    "stream_detect",
]


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def copies(spark, n: int):
    """The events of the table once per copy, each copy with devices of its own, as a written table."""
    events = q.events(spark, SF_DIR).crossJoin(spark.range(n).withColumnRenamed("id", "copy"))
    device = F.concat_ws("-", "copy", F.col("user_id") % 20)
    path = new_folder(spark, "bench")
    samples = to_samples(events, device, "ts", "value", "event_id", F.col("event_type") == "error")
    samples.repartition(32).write.parquet(path)
    return spark.read.parquet(path)


def main() -> None:
    spark = build_session(
        "bench",
        spark__master=f"local[{CPUS}]",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    registry = q.all_queries()
    timed(lambda: registry["detect_anomalies"](spark, SF_DIR))
    seconds = {}
    for name in wanted:
        runs = [timed(lambda: registry[name](spark, SF_DIR)) for _ in range(3)]
        seconds[name] = round(statistics.median(runs), 3)
    result = {"metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
              "queries": seconds, "sf": SF_DIR.rsplit("sf", 1)[-1]}
    if COPIES and not sys.argv[1:]:
        rows = copies(spark, COPIES)
        n = rows.count()
        best = min(timed(lambda: detect(rows, 1000, rms_threshold=80.0, std_threshold=55.0)) for _ in range(2))
        result |= {"pipeline_samples": n, "pipeline_sec": round(best, 3), "samples_per_sec": round(n / best),
                   "target_samples_per_sec": 1000}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
