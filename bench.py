"""Benchmark: build the layered warehouse, then time every registered query.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3). Each query result is fully computed through the
``noop`` sink (nothing is collected). Prints one JSON line:
  value = warehouse build seconds + sum of per-query warm medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    cpus = cpus if cpus.isdigit() else str(os.cpu_count() or 8)
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    from edustar.plans.catalog import QUERIES
    from edustar.plans.warehouse import Warehouse
    from edustar.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="edustar-bench")
    t0 = time.time()
    w = Warehouse.of(spark, sf_dir)
    layers: dict[str, float] = {}
    for layer, step in [("landing", w.bronze), ("silver", w.silver), ("dims", w.dims),
                        ("fact_base", w.fact_base), ("fact", w.fact), ("staging", w.staging), ("marts", w.build_all)]:
        t = time.time()
        step()
        layers[layer] = round(time.time() - t, 3)
    sizes = dict(w.sizes)
    build = time.time() - t0

    times: dict[str, float] = {}
    for name, fn in QUERIES.items():
        runs = []
        for _ in range(repeat):
            t = time.time()
            fn(spark, sf_dir).write.mode("overwrite").format("noop").save()
            runs.append(time.time() - t)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "warehouse_build_plus_query_medians",
        "value": round(build + sum(times.values()), 3),
        "unit": "sec",
        "build_sec": round(build, 3),
        "build_layers_sec": layers,
        "queries": times,
        "sf": sf,
        "cpus": int(cpus),
        "spark": spark.version,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
        "fact_rows": sizes.get("fact_performance"),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
