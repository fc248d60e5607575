"""Records read per query as a multiple of ``lineitem``, from the event log.

usage: python tools/scan_check.py sf_dir key [key ...]   -> one JSON object
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stockgap.plans.registry import QUERIES  # noqa: E402
from stockgap.session import local_session  # noqa: E402


def main(sf_dir: str, keys: list[str]) -> dict[str, float]:
    folder = tempfile.mkdtemp(prefix="stockgap-events-")
    spark = local_session(2, app="scan-check", **{
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{folder}",
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        "spark.sql.shuffle.partitions": "4"})
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    for key in keys:
        spark.sparkContext.setJobGroup(key, key)
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()
    group, read = {}, defaultdict(int)
    for name in os.listdir(folder):
        with open(os.path.join(folder, name)) as f:
            for e in map(json.loads, f):
                if e["Event"] == "SparkListenerStageSubmitted":
                    group[e["Stage Info"]["Stage ID"]] = (e.get("Properties") or {}).get("spark.jobGroup.id")
                elif e["Event"] == "SparkListenerTaskEnd":
                    m = (e.get("Task Metrics") or {}).get("Input Metrics", {})
                    read[group.get(e["Stage ID"])] += m.get("Records Read", 0)
    return {key: round(read[key] / rows, 2) for key in keys}


if __name__ == "__main__":
    print(json.dumps(main(sys.argv[1], sys.argv[2:])))
