"""Print the physical plans of the main stages of a build over a stored document table.

usage: python tools/show_plans.py [sf_dir]

The interaction documents derived from ``events`` are stored as Parquet
partitioned by ``criteria_id, platform`` in a fresh scratch folder, then one
build over the registered day-range requests is explained stage by stage.
"""

from __future__ import annotations

import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv):
    from weftgraph.plans.build import build_graph, graph_counts
    from weftgraph.plans.catalog import DAY_REQUESTS, SMALL_CAP
    from weftgraph.session import get_session
    from weftgraph.sources.fixtures import load_interactions

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = get_session("local[8]", 16, extra={"spark.checkpoint.dir": f"{scratch}/checkpoint"})
    load_interactions(spark, sf_dir).write.partitionBy("criteria_id", "platform").parquet(f"{scratch}/docs")
    docs = spark.read.parquet(f"{scratch}/docs")
    b = build_graph(spark, docs, DAY_REQUESTS[:1], selection="day_range", cap=SMALL_CAP)
    from weftgraph.operators import graph as graphops
    stages = {
        "R2 selection (documents of the requests)": b.documents,
        "G2 valid edges as built (before materialisation)": graphops.valid_edges(b.edges, b.losers),
        "G13 induced edges": b.out_edges,
        "G2 valid edges (anti join with the losing ids)": b.valid_edges,
        "D1-D5 vertex table": b.vertices,
        "G4-G7 degrees": b.nodes_deg,
        "G11-G13 kept nodes and induced edges, N7 counts": graph_counts(b),
    }
    for title, df in stages.items():
        print(f"\n===== {title} =====")
        df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
