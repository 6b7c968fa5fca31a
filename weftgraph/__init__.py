"""weftgraph: directed interaction networks from social-media documents, on Spark.

Public API::

    from weftgraph import build_graph, write_tables, write_gexf, run_stream
    build = build_graph(spark, interactions, requests, selection="day_range", cap=15000)
    write_tables(build.nodes, build.out_edges, "/out")
    write_gexf(build.requests.select("graph_id"), build.nodes, build.out_edges, "/out/gexf")
"""

from weftgraph.plans.build import GraphBuild, build_graph, graph_counts
from weftgraph.sinks.gexf import gexf_edges, gexf_nodes, write_gexf
from weftgraph.sinks.tables import write_tables
from weftgraph.streaming.requests_stream import process_batch, run_stream

__all__ = ["GraphBuild", "build_graph", "graph_counts", "gexf_edges", "gexf_nodes", "write_gexf",
           "write_tables", "process_batch", "run_stream"]
