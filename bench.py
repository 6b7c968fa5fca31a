"""Headline timings: prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all cores).

Setup (timed apart, not in ``value``): the interaction documents derived from
``events`` are stored as Parquet partitioned by ``criteria_id, platform`` and
the wide-row table as Parquet sorted by key, as a deployment would hold them.
Each query then builds its networks from the stored tables and collects only
small results (counts) or writes files.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")

    from pyspark.sql import functions as F

    from weftgraph.plans.build import build_graph, graph_counts
    from weftgraph.plans.catalog import DAY_REQUESTS, SMALL_CAP, TS_REQUESTS, WINDOW
    from weftgraph.session import get_session
    from weftgraph.sinks.gexf import write_gexf
    from weftgraph.sinks.tables import write_tables
    from weftgraph.sources.fixtures import load_interactions, wide_rows

    spark = get_session(f"local[{cpus}]", int(cpus) * 2, extra={
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "12g"),
        "spark.checkpoint.dir": f"{scratch}/checkpoint",
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    })

    t0 = time.time()
    flat_path, wide_path = f"{scratch}/interactions", f"{scratch}/wide_rows"
    inter = load_interactions(spark, sf_dir)
    inter.write.partitionBy("criteria_id", "platform").parquet(flat_path)
    wide_rows(inter).sortWithinPartitions("row_key").write.parquet(wide_path)
    setup_sec = time.time() - t0

    flat = spark.read.parquet(flat_path)
    wide = spark.read.parquet(wide_path)
    single = [{"path": "out", "platform": "twitter", "criteria_id": "crit_0", "from": WINDOW[0], "to": WINDOW[1]}]

    def counts(build):
        rows = graph_counts(build).collect()
        return sum(r["nodes"] for r in rows), sum(r["edges"] for r in rows)

    def q_single():
        return counts(build_graph(spark, flat, single, selection="day_range"))

    def q_many_day_range():
        return counts(build_graph(spark, flat, DAY_REQUESTS, selection="day_range", cap=SMALL_CAP))

    def q_day_list():
        return counts(build_graph(spark, flat, DAY_REQUESTS, selection="day_list"))

    def q_timestamp_edge_complete():
        return counts(build_graph(spark, flat, TS_REQUESTS, selection="timestamp_range", cap=SMALL_CAP,
                                  cap_mode="edge_complete", require_target=False))

    def q_wide_rows():
        return counts(build_graph(spark, wide, DAY_REQUESTS, selection="day_range", source_kind="wide"))

    def q_many_ranges():
        first, step = int(WINDOW[0]), 86_400_000
        ranges = [{**single[0], "criteria_id": f"crit_{i % 3}", "platform": None, "from": str(first + i * step // 50),
                   "to": str(first + i * step // 50 + step)} for i in range(500)]
        return counts(build_graph(spark, flat, ranges, selection="timestamp_range", cap=SMALL_CAP))

    def q_export():
        b = build_graph(spark, flat, DAY_REQUESTS, selection="day_range", cap=SMALL_CAP)
        out = f"{scratch}/out"
        write_tables(b.nodes, b.out_edges, out)
        write_gexf(b.requests.select("graph_id"), b.nodes, b.out_edges, f"{out}/gexf")
        return spark.read.text(f"{out}/gexf").agg(F.count(F.lit(1))).collect()[0][0]

    queries = {"single_network": q_single, "many_networks_day_range": q_many_day_range,
               "many_networks_day_list": q_day_list, "timestamp_edge_complete": q_timestamp_edge_complete,
               "wide_row_source": q_wide_rows, "many_ranges_500": q_many_ranges, "export_tables_gexf": q_export}
    times, results = {}, {}
    for name, fn in queries.items():
        t = time.time()
        results[name] = fn()
        times[name] = round(time.time() - t, 3)
    print(json.dumps({"metric": "total_query_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                      "cpus": int(cpus), "setup_sec": round(setup_sec, 3),
                      "results": {k: list(v) if isinstance(v, tuple) else v for k, v in results.items()}}))
    spark.stop()


if __name__ == "__main__":
    main()
