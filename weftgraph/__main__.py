"""Command line: build networks from request messages.

    spark-submit -m weftgraph batch  --requests req.jsonl --documents <path> --out <dir> [--mode hbase|mongo]
    spark-submit -m weftgraph stream --requests <dir>     --documents <path> --out <dir> --checkpoint <dir>

``--mode`` picks the variant presets: ``hbase`` reads a wide-row table
(``row_key, chunk, cells``), selects whole days with the end day excluded,
requires a target and keeps the induced subgraph; ``mongo`` reads a flat
document table, selects by inclusive milliseconds on any platform, keeps
null-target documents and exports the edge-complete network.  Each preset can
be overridden by the explicit flags.
"""

from __future__ import annotations

import argparse
import json
import sys

PRESETS = {
    "hbase": dict(source_kind="wide", selection="day_range", require_target=True, cap_mode="induced"),
    "mongo": dict(source_kind="flat", selection="timestamp_range", require_target=False, cap_mode="edge_complete",
                  ignore_platform=True),
}


def parse_args(argv):
    p = argparse.ArgumentParser(prog="weftgraph")
    p.add_argument("command", choices=["batch", "stream"])
    p.add_argument("--requests", required=True, help="JSON-lines file (batch) or folder of such files (stream)")
    p.add_argument("--documents", required=True, help="Parquet documents (flat) or wide-row table")
    p.add_argument("--out", required=True)
    p.add_argument("--checkpoint", help="stream checkpoint folder (shared file system)")
    p.add_argument("--mode", choices=sorted(PRESETS), default="hbase")
    p.add_argument("--selection", choices=["day_range", "day_list", "timestamp_range"])
    p.add_argument("--cap", type=int, default=15000)
    p.add_argument("--cap-mode", choices=["induced", "edge_complete"])
    p.add_argument("--on-bad", choices=["fail", "drop"], default="fail")
    return p.parse_args(argv)


def main(argv=None, spark=None) -> int:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    from pyspark.sql import SparkSession

    from weftgraph.session import SESSION_DEFAULTS
    from weftgraph.streaming import process_batch, run_stream

    if spark is None:
        builder = SparkSession.builder.appName("weftgraph")
        for key, value in SESSION_DEFAULTS.items():
            builder = builder.config(key, value)
        spark = builder.getOrCreate()
    kw = dict(PRESETS[args.mode])
    if args.selection:
        kw["selection"] = args.selection
        kw["ignore_platform"] = kw.get("ignore_platform", False) and args.selection == "timestamp_range"
    if args.cap_mode:
        kw["cap_mode"] = args.cap_mode
    kw.update(cap=args.cap, on_bad=args.on_bad)
    documents = spark.read.parquet(args.documents)
    if args.command == "batch":
        from weftgraph.sources.requests import decode_requests
        requests = decode_requests(spark.read.text(args.requests))
        process_batch(spark, requests, documents, args.out, 0, **kw)
        from weftgraph.streaming.requests_stream import check_requests
        own = check_requests(requests, kw["selection"], kw.get("ignore_platform", False)).select("graph_id").distinct()
        for row in spark.read.json(f"{args.out}/status").join(own, "graph_id", "left_semi").collect():
            print(json.dumps(row.asDict()))
        return 0
    if not args.checkpoint:
        raise SystemExit("stream needs --checkpoint")
    run_stream(spark, args.requests, documents, args.out, args.checkpoint, available_now=False, **kw).awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
