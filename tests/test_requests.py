"""Requests, extended JSON, edge ids and replays: the cases of requests and documents that are not clean."""

import json
import os

import pytest

from test_semantics import DAY, T0, doc, frame, req
from weftgraph.operators.select import merged_ranges
from weftgraph.plans.build import build_graph
from weftgraph.sinks.gexf import ordered_lines
from weftgraph.sinks.tables import write_tables
from weftgraph.sources.requests import unique_requests
from weftgraph.streaming.requests_stream import process_batch
from weftgraph.sources.requests import decode_requests


def test_unique_requests():
    a, b = req(), {**req(), "from": T0, "to": T0 + 3 * DAY}
    assert len(unique_requests([a, b], "day_range")) == 1
    with pytest.raises(ValueError):
        unique_requests([{**req(), "graph_id": "g"}, {**req(crit="c2"), "graph_id": "g"}], "day_range")


def test_merged_ranges():
    rs = [req(0, 10), req(5, 20), req(30, 40), req(9, 3, platform=None), req(1, 2, crit="c2")]
    assert merged_ranges(rs) == {("c1", "TW"): [(0, 20), (30, 40)], ("c1", None): [(3, 9)], ("c2", "TW"): [(1, 2)]}


def test_request_days_beyond_the_broadcast_bound(spark):
    docs = frame(spark, [doc("TW_1", "TW_2", ts=T0 + i * DAY + 5) for i in range(5)])
    for mode, n in (("day_range", 3), ("day_list", 4)):
        for bound in (2_000_000, 2, 0):  # exploded days, days as a range, sort-merge
            assert build_graph(spark, docs, [req()], selection=mode, max_broadcast_rows=bound).documents.count() == n


def test_edge_ids_do_not_depend_on_partitions_or_other_networks(spark):
    docs = frame(spark, [doc("TW_1", "TW_2", ts=T0 + i // 2 + 5, post="p") for i in range(6)]
                 + [doc("TW_3", "TW_4", crit="c2")])

    def lines(requests, partitions):
        b = build_graph(spark, docs, requests)
        return sorted(r["line"] for r in ordered_lines(b.requests.select("graph_id"), b.nodes, b.out_edges, partitions)
                      .where("line like '%<edge %' and graph_id like 'c1%'").collect())

    alone = lines([req()], 3)
    assert alone == lines([req(), req(crit="c2")], 7)
    assert len(alone) == 6 and len({x.split('id="')[1].split('"')[0] for x in alone}) == 6


def test_a_network_that_became_empty_leaves_no_rows(spark, scratch):
    for docs, n in (([doc("TW_1", "TW_2"), doc("TW_3", "TW_4", crit="c2")], 2), ([doc("TW_3", "TW_4", crit="c2")], 0)):
        b = build_graph(spark, frame(spark, docs), [req(), req(crit="c2")])
        write_tables(b.nodes, b.out_edges, scratch, graph_ids=b.requests.select("graph_id"))
        assert spark.read.parquet(f"{scratch}/nodes").where("graph_id like 'c1%'").count() == n


def test_a_bad_document_fails_its_own_network_only(spark, scratch):
    docs = frame(spark, [doc("TW_1", "TW_2"), doc("TW_x", "TW_4", crit="c2")])
    lines = spark.createDataFrame([(json.dumps(r),) for r in (req(), req(crit="c2"))] + [("no json",), ("nor this",)],
                                  "value string")
    process_batch(spark, decode_requests(lines), docs, scratch)
    status = {r["raw"]: r["status"] for r in spark.read.json(f"{scratch}/status").collect()}
    assert status == {json.dumps(req()): "done", json.dumps(req(crit="c2")): "failed", "no json": "failed",
                      "nor this": "failed"}
    assert os.path.isdir(f"{scratch}/completed") and spark.read.parquet(f"{scratch}/nodes").count() == 2


ODD_DOCUMENTS = [
    ({"target": "TW_2", "text": '{"k": 5}', "timestamp": {"$numberDouble": "5.0"}}, ("TW_2", '{"k": 5}', 5, None)),
    ({"target": {"$oid": "TW_3"}, "text": "[not a list", "timestamp": {"$date": {"$numberLong": "6"}}}, ("TW_3", "[not a list", 6, None)),
    ({"target": "TW_4", "text": {"$numberDecimal": "1.50"}, "timestamp": {"$date": "1970-01-01T00:00:00.007Z"}}, ("TW_4", "1.50", 7, None)),
    ({"target": 7, "text": True, "timestamp": {"$date": "8"}}, ("7", "true", 8, None)),
    ({"target": None, "text": {"$oid": ""}}, (None, "", None, None)),
    ({"target": {"$oid": "TW_5"}, "text": {"a": 1}, "timestamp": 9}, ("TW_5", None, 9, 'unreadable text: {"a":1}')),
    ({"target": {"$oid": "TW_6"}, "timestamp": {"$numberDouble": "9.5"}},
     ("TW_6", None, None, 'unreadable timestamp: {"$numberDouble":"9.5"}')),
]


def test_a_filter_above_typed_documents_repeats_no_parser(spark):
    from pyspark.sql import functions as F

    from weftgraph.sources.widerow import parse_documents
    rows = [(i, json.dumps(doc)) for i, (doc, _) in enumerate(ODD_DOCUMENTS)]
    docs = parse_documents(spark.createDataFrame(rows, "qualifier int, value string").withColumn("i", F.col("qualifier")), "report")
    got = [tuple(r) for r in docs.orderBy("i").select("target", "text", "timestamp", "error").collect()]
    assert got == [want for _, want in ODD_DOCUMENTS]
    plan = docs.where(F.col("target").isNotNull() | F.col("error").isNotNull())._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000, len(plan)
    assert plan.lower().count("parsejson") + plan.lower().count("parse_json") <= 2
