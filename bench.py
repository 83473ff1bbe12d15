"""Benchmark: run every registered analysis on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and print one JSON line.

Each analysis is executed to completion with the ``noop`` sink (all stages
run, nothing is collected to the driver).  The headline value is the sum of
per-analysis wall-clock seconds after one warm-up analysis.

    BENCH_SF_DIR=/root/testdata/sf0.01 python bench.py [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.registry import load_all  # noqa: E402
from tidemark.session import get_session  # noqa: E402


def main(argv: list[str]) -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    reg = load_all()
    names = argv or sorted(reg)
    # warm-up: JVM, parquet footers, Python workers
    reg["ag36_daily_rollup"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for n in names:
        t0 = time.perf_counter()
        try:
            reg[n].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[n] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001 - reported, not hidden
            failed[n] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = Path(sf_dir).name.replace("sf", "")
    out = {"metric": "sum_of_analysis_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
           "cpus": cpus, "n_queries": len(times)}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()
    return 0 if not failed else 1


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
