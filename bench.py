"""Bench: the headline jobs at one scale factor, one JSON line on stdout.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (default 3; best of N after one warm-up run)

Each query is run to completion with the ``noop`` sink (every row is
produced, nothing is collected to the driver).  The ledger is also written
to parquet once (under ``spark.checkpoint.dir``), as the reference
materializes it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stockgap.plans.registry import QUERIES  # noqa: E402
from stockgap.session import local_session, scratch_path  # noqa: E402

HEADLINE = ["ledger", "stuffing", "leakage", "dump_day", "route", "risk_score",
            "spike_overlay", "dq_ledger_identity"]


def _stuffing_dense(spark, sf_dir):
    """The reference's dense plan of the stuffing detector, for comparison."""
    from stockgap.operators.stuffing import channel_stuffing  # noqa: PLC0415
    from stockgap.params import DRIVER  # noqa: PLC0415
    from stockgap.plans.registry import _wh  # noqa: PLC0415
    return channel_stuffing(_wh(spark, sf_dir), DRIVER.stuffing, method="dense")


EXTRA = {"stuffing_dense": _stuffing_dense}


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cpus, app="stockgap-bench",
                          **{"spark.driver.memory": os.environ.get("BENCH_MEM", "8g")})
    times: dict[str, float] = {}
    for key in HEADLINE + list(EXTRA):
        q = QUERIES.get(key) or EXTRA[key]
        _run(q(spark, sf_dir))  # warm-up (JIT, file listing, codegen)
        best = float("inf")
        for _ in range(repeat):
            t0 = time.perf_counter()
            _run(q(spark, sf_dir))
            best = min(best, time.perf_counter() - t0)
        times[key] = round(best, 3)

    out = scratch_path(spark, f"bench-ledger-{os.getpid()}-{int(time.time())}")
    t0 = time.perf_counter()
    QUERIES["ledger"](spark, sf_dir).write.mode("overwrite").parquet(out)
    times["ledger_write_parquet"] = round(time.perf_counter() - t0, 3)
    from stockgap.operators.ledger import ledger_runs  # noqa: PLC0415
    from stockgap.plans.registry import _wh  # noqa: PLC0415
    t0 = time.perf_counter()
    ledger_runs(_wh(spark, sf_dir)).write.mode("overwrite").parquet(out + "-runs")
    times["ledger_runs_write_parquet"] = round(time.perf_counter() - t0, 3)

    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
