"""Skew experiment: a third of all lines moved to one distributor.

usage: python tools/skew_check.py SF_DIR SCRATCH_DIR

Writes a copy of the driver tables under SCRATCH_DIR where every line with
``l_orderkey % 3 = 0`` belongs to supplier 1, runs the main jobs with Spark's
event log in SCRATCH_DIR, and prints, per job and stage, the records read by
the largest task against the stage total.  With the roll-up-first plans no
task should carry anything near a third of the input.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from stockgap.plans.registry import QUERIES  # noqa: E402
from stockgap.session import local_session  # noqa: E402
from stockgap.sources.tables import table_path  # noqa: E402

JOBS = ["ledger", "stuffing", "leakage", "dump_day", "route", "risk_score", "dq_orphans"]


def main() -> None:
    sf_dir, scratch = sys.argv[1], sys.argv[2]
    data = os.path.join(scratch, "tables")
    logs = os.path.join(scratch, "events")
    os.makedirs(logs, exist_ok=True)
    # no partition coalescing, so a balanced shuffle spreads over all 8 tasks
    spark = local_session(8, **{"spark.eventLog.enabled": "true", "spark.eventLog.dir": logs,
                                "spark.eventLog.compress": "false",
                                "spark.eventLog.rolling.enabled": "false",
                                "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    li = spark.read.parquet(table_path(sf_dir, "lineitem"))
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("l_suppkey"))
    li.withColumn("l_suppkey", hot).write.mode("overwrite").parquet(table_path(data, "lineitem"))
    for t in ("orders", "part", "supplier", "customer", "nation", "region"):
        spark.read.parquet(table_path(sf_dir, t)).write.mode("overwrite").parquet(table_path(data, t))
    times = {}
    for k in JOBS:
        spark.sparkContext.setJobGroup(k, k)
        t0 = time.perf_counter()
        QUERIES[k](spark, data).write.format("noop").mode("overwrite").save()
        times[k] = round(time.perf_counter() - t0, 2)
    # control: raw lines partitioned by supplier (what the roll-up avoids)
    spark.sparkContext.setJobGroup("naive_control", "naive_control")
    (spark.read.parquet(table_path(data, "lineitem")).repartition(8, "l_suppkey")
     .groupBy("l_suppkey", "l_shipdate").count().write.format("noop").mode("overwrite").save())
    spark.stop()

    # stage -> per-task shuffle records read (post-exchange stages only)
    per_stage = defaultdict(list)
    stage_group = {}
    for path in glob.glob(os.path.join(logs, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    rec = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                    per_stage[ev["Stage ID"]].append(rec)
    worst = {}
    for sid, recs in per_stage.items():
        g = stage_group.get(sid)
        total = sum(recs)
        if g is None or total < 1000:
            continue
        share = max(recs) / total
        if share > worst.get(g, (0, 0, 0))[0]:
            worst[g] = (share, max(recs), total)
    print(json.dumps({"seconds": times,
                      "largest_task_share": {g: round(v[0], 3) for g, v in worst.items()},
                      "largest_task_records": {g: [v[1], v[2]] for g, v in worst.items()}},
                     indent=1))


if __name__ == "__main__":
    main()
