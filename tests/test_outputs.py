"""N1–N7 outputs (GEXF parsed back with a plain XML parser, tables) and the R1/R4–R6 stream."""

import json
import os
import xml.etree.ElementTree as ET

from pyspark.sql import functions as F

from conftest import sf_dir
from test_semantics import T0, doc, frame, req
from weftgraph.plans.build import build_graph, graph_counts
from weftgraph.sinks.gexf import assemble, part_files, write_gexf
from weftgraph.sinks.tables import write_tables
from weftgraph.sources.fixtures import load_interactions
from weftgraph.streaming import process_batch, run_stream

NS = {"g": "http://www.gexf.net/1.2draft"}
WINDOW = ("1704412800000", "1706227200000")


def _parse(path):
    root = ET.parse(path).getroot()
    graph = root.find("g:graph", NS)
    return graph.findall("g:nodes/g:node", NS), graph.findall("g:edges/g:edge", NS)


def test_gexf_round_trip(spark, scratch):
    inter = load_interactions(spark, sf_dir("0.001"))
    requests = [{"path": "o", "platform": p, "criteria_id": c, "from": WINDOW[0], "to": WINDOW[1]}
                for c in ("crit_0", "crit_1") for p in ("twitter", "facebook")]
    b = build_graph(spark, inter, requests, cap=40)
    out = os.path.join(scratch, "gexf")
    write_gexf(b.requests.select("graph_id"), b.nodes, b.out_edges, out, partitions=5)
    counts = {r["graph_id"]: (r["nodes"], r["edges"]) for r in graph_counts(b).collect()}
    assert len(counts) == 4
    for gid, (n_nodes, n_edges) in counts.items():
        assert part_files(out, gid)
        target = assemble(out, gid, os.path.join(scratch, f"{gid}.gexf"))
        nodes, edges = _parse(target)
        assert (len(nodes), len(edges)) == (n_nodes, n_edges)
        node_ids = {n.get("id") for n in nodes}
        assert all(e.get("source") in node_ids and e.get("target") in node_ids for e in edges)
        assert len({e.get("id") for e in edges}) == len(edges)
        assert all(e.get("weight") == "1.0" for e in edges)
    assert counts["crit_0_TW_" + "_".join(WINDOW)] == (22, 45)


def test_gexf_escaping_and_absent_values(spark, scratch):
    docs = [doc("TW_1", "TW_2", sname='a<b&"c', text="x\x01y<z>"), doc("TW_2", "TW_1", text=None)]
    b = build_graph(spark, frame(spark, docs), [req()])
    out = os.path.join(scratch, "gexf")
    write_gexf(b.requests.select("graph_id"), b.nodes, b.out_edges, out)
    gid = b.requests.collect()[0]["graph_id"]
    nodes, edges = _parse(assemble(out, gid, os.path.join(scratch, "g.gexf")))
    labels = {n.get("id"): n.get("label") for n in nodes}
    assert labels["1"] == 'a<b&"c'
    texts = sorted(
        [a.get("value") for a in e.findall("g:attvalues/g:attvalue", NS) if a.get("for") == "text"] for e in edges)
    assert texts == [[], ["xy<z>"]]  # control character removed; a null text is an absent value


def test_tables(spark, scratch):
    b = build_graph(spark, load_interactions(spark, sf_dir("0.001")),
                    [{"path": "o", "platform": "twitter", "criteria_id": "crit_0",
                      "from": WINDOW[0], "to": WINDOW[1]}])
    out = os.path.join(scratch, "tables")
    write_tables(b.nodes, b.out_edges, out)
    nodes = spark.read.parquet(f"{out}/nodes")
    edges = spark.read.parquet(f"{out}/edges")
    assert (nodes.count(), edges.count()) == (73, 115)
    assert set(nodes.columns) == {"graph_id", "id", "label", "nodes_type"}
    assert edges.agg(F.sum("timestamp")).collect()[0][0] == 196105322284541


def _tables(spark, out):
    n = sorted(tuple(r) for r in spark.read.parquet(f"{out}/nodes").collect())
    e = sorted(tuple(r) for r in spark.read.parquet(f"{out}/edges").collect())
    return n, e


def completed_id(status):
    return next(g for g, (s, _) in status.items() if s == "done")


def test_documents_at_request_paths(spark, scratch):
    source = frame(spark, [doc("TW_1", "TW_2"), doc("TW_2", "TW_3")])
    out, far = os.path.join(scratch, "paths"), os.path.join(scratch, "far")
    rows = [dict(req(), path="a/b"), dict(req(), path=far)]
    names = ["path", "platform", "criteria_id", "from", "to"]
    lines = spark.createDataFrame([tuple(str(r[n]) for n in names) for r in rows], ", ".join(f"`{n}` string" for n in names))
    process_batch(spark, lines, source, out, selection="day_range")
    found = [os.listdir(f) for f in (f"{out}/gexf/a/b", far)]
    ids = [next(n for n in names if n.startswith("graph_id=")).removeprefix("graph_id=") for names in found]
    texts = [open(assemble(f, g, os.path.join(scratch, f"p{i}.gexf"))).read()
             for i, (f, g) in enumerate(zip((f"{out}/gexf/a/b", far), ids))]
    assert ids[0] == ids[1] and texts[0] == texts[1] and texts[0].count("<edge id") == 2


def test_stream_requests_idempotent(spark, scratch):
    docs = [doc(f"TW_{i}", f"TW_{i % 5 + 1}", ts=T0 + i * 3_600_000) for i in range(1, 40)]
    source = frame(spark, docs)
    req_dir = os.path.join(scratch, "requests")
    os.makedirs(req_dir)
    good = req(T0, T0 + 3 * 86_400_000)
    bad = dict(good, platform="myspace")
    with open(os.path.join(req_dir, "a.json"), "w") as f:
        f.write(json.dumps(good) + "\n" + json.dumps(bad) + "\n")
    out = os.path.join(scratch, "out")
    q = run_stream(spark, req_dir, source, out, os.path.join(scratch, "ckpt1"), selection="day_range", cap=10)
    q.awaitTermination()
    first = _tables(spark, out)
    status = {r["graph_id"]: (r["status"], r["error"]) for r in spark.read.json(f"{out}/status").collect()}
    assert sorted(s for s, _ in status.values()) == ["done", "failed"]
    assert any(e == "unknown platform" for _, e in status.values())
    completed = [json.loads(r["value"]) for r in spark.read.text(f"{out}/completed").collect()]
    assert len(completed) == 1 and completed[0]["step"] == "analysis_network"
    assert completed[0]["criteria_id"] == "c1"
    _, shown = _parse(assemble(f"{out}/gexf/{good['path']}", completed_id(status), os.path.join(scratch, "s.gexf")))
    assert len(shown) == len(first[1])
    # the same requests replayed (a new checkpoint) rewrite the same folders: identical tables
    q = run_stream(spark, req_dir, source, out, os.path.join(scratch, "ckpt2"), selection="day_range", cap=10)
    q.awaitTermination()
    assert _tables(spark, out) == first
    import model
    _, expected_nodes, expected_edges, _ = model.build(docs, good, cap=10)
    assert len(first[0]) == len(expected_nodes) > 0
    assert len(first[1]) == len(expected_edges)


def test_gexf_graph_id_with_special_characters(spark, scratch):
    docs = [doc("TW_1", "TW_2"), doc("TW_2", "TW_3")]
    r = dict(req(), graph_id="net/a:b=c?#1")
    b = build_graph(spark, frame(spark, docs), [r])
    out = os.path.join(scratch, "gexf")
    write_gexf(b.requests.select("graph_id"), b.nodes, b.out_edges, out)
    nodes, edges = _parse(assemble(out, "net/a:b=c?#1", os.path.join(scratch, "g.gexf")))
    assert (len(nodes), len(edges)) == (3, 2)
