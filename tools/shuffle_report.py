"""Seconds and shuffled bytes of catalogued queries, from Spark's event log.

usage: python tools/shuffle_report.py sf_dir log_dir name [name ...]

``log_dir`` is an existing scratch folder for the event log. Every query runs
once on a small table first, so that code is compiled; rows go to the noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


def main() -> None:
    sf_dir, log_dir, names = sys.argv[1], sys.argv[2], sys.argv[3:]
    conf = {"enabled": "true", "dir": f"file:{log_dir}", "rolling.enabled": "false", "compress": "false"}
    os.environ["PYSPARK_SUBMIT_ARGS"] = " ".join(f"--conf spark.eventLog.{k}={v}" for k, v in conf.items()) + " pyspark-shell"
    from relmod.plans import catalog
    from relmod.session import local_session

    spark = local_session(cores=8, shuffle_partitions=16, app="shuffle-report")
    spans = {}
    for name in names:
        catalog.QUERIES[name](spark, SMALL).write.format("noop").mode("overwrite").save()
        spark.catalog.clearCache()
        start = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spans[name] = start, time.time()
        spark.catalog.clearCache()
    path = os.path.join(log_dir, spark.sparkContext.applicationId)
    spark.stop()
    path = path if os.path.exists(path) else path + ".inprogress"
    tasks = []
    with open(path) as log:
        for line in log:
            if line.startswith('{"Event":"SparkListenerTaskEnd"'):
                e = json.loads(line)
                m = e.get("Task Metrics") or {}
                w = m.get("Shuffle Write Metrics", {})
                tasks.append((e["Task Info"]["Finish Time"] / 1000, w.get("Shuffle Bytes Written", 0), w.get("Shuffle Records Written", 0), m.get("Executor CPU Time", 0) / 1e9))
    for name, (a, b) in spans.items():
        mine = [t for t in tasks if a <= t[0] <= b + 1]
        print(
            f"{name}: {b - a:.1f} s, {sum(t[1] for t in mine) / 1e6:.1f} MB and {sum(t[2] for t in mine)} rows shuffled,"
            f" {sum(t[3] for t in mine):.1f} s CPU in {len(mine)} tasks"
        )


if __name__ == "__main__":
    main()
