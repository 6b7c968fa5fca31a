"""Batches: errors carried through one build, staged outputs published together, documents at many paths, pruning."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F

import weftgraph.streaming.requests_stream as stream
from test_semantics import DAY, T0, doc, frame, req
from weftgraph.operators import select as sel
from weftgraph.plans.build import build_graph
from weftgraph.sinks.files import Files
from weftgraph.sinks.publish import Stage, finish
from weftgraph.sources.fixtures import wide_rows
from weftgraph.sources.requests import REQUEST_SCHEMA, normalize_requests, requests_frame
from weftgraph.streaming.requests_stream import process_batch

NAMES = [f.name for f in REQUEST_SCHEMA.fields]


def messages(spark, rows):
    return spark.createDataFrame([tuple(str(r[n]) for n in NAMES) for r in rows], REQUEST_SCHEMA)


def network(i, path="out"):
    return {**req(crit=f"c{i}"), "path": path}


def status_of(spark, out):
    rows = spark.read.json(f"{out}/status").collect()
    return {r["graph_id"].split("_")[0]: (r["status"], getattr(r, "error", None) if "error" in r else None) for r in rows}


@pytest.fixture()
def builds(monkeypatch):
    seen = []

    def counted(*a, **kw):
        seen.append(1)
        return build_graph(*a, **kw)

    monkeypatch.setattr(stream, "build_graph", counted)
    return seen


def test_one_build_whatever_fails(spark, scratch, builds):
    docs = [doc("TW_1", "TW_2", crit=f"c{i}") for i in range(12)] + [doc("TW_bad", "TW_2", crit=f"c{i}") for i in range(8)] \
        + [doc("TW_1", "TW_worse", crit="c0")]
    process_batch(spark, messages(spark, [network(i) for i in range(12)]), frame(spark, docs), scratch)
    status = status_of(spark, scratch)
    assert builds == [1]
    assert all(status[f"c{i}"] == ("failed", "bad account id: TW_bad") for i in range(8))
    assert all(status[f"c{i}"][0] == "done" for i in range(8, 12))
    done = {json.loads(r["value"])["criteria_id"] for r in spark.read.text(f"{scratch}/completed").collect()}
    assert done == {f"c{i}" for i in range(8, 12)} and spark.read.parquet(f"{scratch}/nodes").count() == 8


def test_a_common_fault_costs_one_build(spark, scratch, builds):
    source = frame(spark, [doc("TW_1", "TW_2", crit=f"c{i}") for i in range(8)]).drop("text")
    process_batch(spark, messages(spark, [network(i) for i in range(8)]), source, scratch)
    assert builds == [1] and {s for s, _ in status_of(spark, scratch).values()} == {"failed"}
    assert not os.path.exists(f"{scratch}/nodes") and not os.path.exists(f"{scratch}/completed")


def test_malformed_cells_are_reported(spark):
    docs = frame(spark, [doc("TW_1", "TW_2", post="a"), doc("TW_1", "TW_3", post="b"), doc("TW_1", "TW_2", crit="c2")])
    wide = wide_rows(docs).withColumn("cells", F.transform_values(
        "cells", lambda k, v: F.when(k == "b", F.lit("{broken")).otherwise(v)))
    for selection in ("day_range", "timestamp_range"):
        b = build_graph(spark, wide, [req(), req(crit="c2")], source_kind="wide", selection=selection, on_bad="report")
        assert [(r["graph_id"][:2], r["error"]) for r in b.faults.collect()] == [("c1", "malformed document: {broken")]
        assert {r["graph_id"][:2] for r in b.nodes.collect()} == {"c2"}
    assert build_graph(spark, docs, [req()], on_bad="report").faults is None


def outputs(spark, out):
    return [sorted(map(tuple, spark.read.parquet(f"{out}/{k}").collect())) for k in ("nodes", "edges")]


def test_a_failure_between_the_writes_leaves_old_outputs(spark, scratch, monkeypatch):
    asked = messages(spark, [network(1)])
    process_batch(spark, asked, frame(spark, [doc("TW_1", "TW_2")]), scratch, 1)
    old = outputs(spark, scratch)
    text = spark.read.text(f"{scratch}/gexf/out").count()

    def fails(self, *a):
        raise OSError("disk full")
    with monkeypatch.context() as m:
        m.setattr(Stage, "write_documents", fails)
        process_batch(spark, asked, frame(spark, [doc("TW_5", "TW_6"), doc("TW_6", "TW_7")]), scratch, 2)
    assert outputs(spark, scratch) == old and spark.read.text(f"{scratch}/gexf/out").count() == text
    assert status_of(spark, scratch)["c1"] == ("failed", "OSError: disk full")
    assert os.listdir(f"{scratch}/completed") in ([], ["_SUCCESS"]) and os.listdir(f"{scratch}/_staged") == []
    process_batch(spark, asked, frame(spark, [doc("TW_5", "TW_6"), doc("TW_6", "TW_7")]), scratch, 3)
    assert len(outputs(spark, scratch)[0]) == 3 and status_of(spark, scratch)["c1"][0] == "done"


def test_a_crash_while_publishing_is_made_good(spark, scratch, monkeypatch, builds):
    asked, source = messages(spark, [network(i) for i in (1, 2)]), frame(
        spark, [doc("TW_1", "TW_2"), doc("TW_2", "TW_3"), doc("TW_3", "TW_4", crit="c2")])
    process_batch(spark, asked, source, f"{scratch}/whole", 7)
    moved = []

    def dies(self, a, b, move=Files.move):
        if "graph_id=" in a:
            moved.append(a)
            if len(moved) > 3:
                raise KeyboardInterrupt
        move(self, a, b)
    with monkeypatch.context() as m:
        m.setattr(Files, "move", dies)
        with pytest.raises(KeyboardInterrupt):
            process_batch(spark, asked, source, f"{scratch}/torn", 7)
    assert not os.path.exists(f"{scratch}/torn/status")
    process_batch(spark, asked, source, f"{scratch}/torn", 7)  # replayed: published, not built again
    assert len(builds) == 2 and outputs(spark, f"{scratch}/torn") == outputs(spark, f"{scratch}/whole")
    assert status_of(spark, f"{scratch}/torn") == status_of(spark, f"{scratch}/whole")
    assert finish(spark, f"{scratch}/torn") == []


def test_documents_of_many_paths_take_the_same_jobs(spark, scratch):
    source = frame(spark, [doc("TW_1", "TW_2", crit=f"c{i}") for i in range(6)])
    jobs = []
    for name, paths in (("one", ["p"] * 6), ("many", [f"p{i}/q" for i in range(6)])):
        spark.sparkContext.setJobGroup(f"paths-{name}", "")
        process_batch(spark, messages(spark, [network(i, p) for i, p in enumerate(paths)]), source, f"{scratch}/{name}")
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"paths-{name}")))
        for i, p in enumerate(paths):
            found = [n for n in os.listdir(f"{scratch}/{name}/gexf/{p}") if n.startswith(f"graph_id=c{i}_")]
            assert len(found) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_many_ranges_of_one_criteria(spark):
    docs = frame(spark, [doc("TW_1", "TW_2", ts=T0 + i * 600_000, post=f"p{i}") for i in range(800)])
    spans = [(T0 + (i * 977_000) % 500_000_000, [1, 60_000, 7_200_000, 90_000_000][i % 4]) for i in range(5000)]
    reqs = [{**req(a, a + n, platform=None), "graph_id": f"g{i}"} for i, (a, n) in enumerate(spans)]
    want = sorted((f"g{i}", f"p{k}") for i, (a, n) in enumerate(spans) for k in range(800) if a <= T0 + k * 600_000 <= a + n)
    norm = normalize_requests(spark.createDataFrame([(r["graph_id"], *[r[n] for n in NAMES]) for r in reqs],
                                                    "graph_id string, " + ", ".join(f"`{n}` string" for n in NAMES)), "timestamp_range")
    for bound in (2_000_000, 0):  # broadcast, shuffle
        found = sel.select_documents(docs, norm, "timestamp_range", n_requests=5000, max_rows=bound)
        assert sorted((r["graph_id"], r["post_id"]) for r in found.select("graph_id", "post_id").collect()) == want
    # what meets before the times are compared is in proportion to what is found
    levels = sel.bin_levels(norm, F.col("from_ms"), F.col("to_ms"))
    met = sel.binned_documents(docs, F.col("timestamp"), levels).join(
        sel.binned_requests(norm.select("graph_id", "from_ms", "to_ms"), F.col("from_ms"), F.col("to_ms")),
        F.expr("_level = _rlevel and _bin = _rbin")).count()
    assert len(want) <= met < 1.6 * len(want) + 800 * len(levels) < 800 * 5000 / 4
    assert norm.transform(lambda d: sel.binned_requests(d, F.col("from_ms"), F.col("to_ms"))).count() <= 10 * 5000


@pytest.mark.parametrize("n", [1, 201, 10_001])
def test_scan_filters_for_any_number_of_criteria(spark, scratch, n):
    docs = frame(spark, [doc("TW_1", "TW_2", crit=f"c{i:05d}") for i in range(50)])
    docs.orderBy("criteria_id").write.parquet(f"{scratch}/flat")
    reqs = [req(crit=f"c{i:05d}") for i in range(n)]
    asked = messages(spark, reqs)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000000")
    for requests in ([reqs] if n < 1000 else []) + [asked]:
        b = build_graph(spark, spark.read.parquet(f"{scratch}/flat"), requests, materialize_mode="none")
        plan = b.documents._jdf.queryExecution().executedPlan().toString()
        pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan, re.S).group(1)
        assert "criteria_id" in pushed and "day" in pushed
        assert 1 <= len(sel.boxes_of(reqs)) <= sel.MAX_BOXES and b.documents.count() == min(n, 50)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(sel.request_boxes(normalize_requests(asked, "day_range"))) == min(n, sel.MAX_BOXES)


def test_request_tables_prune_partitions_at_run_time(spark, scratch):
    frame(spark, [doc("TW_1", "TW_2", crit=f"c{i}") for i in range(8)]).write.partitionBy("criteria_id").parquet(f"{scratch}/parts")
    source = spark.read.parquet(f"{scratch}/parts")
    for asked in ([2, 5], [2, 5, *range(100, 400)]):
        b = build_graph(spark, source, messages(spark, [network(i) for i in asked]), materialize_mode="none")
        assert "dynamicpruning" in b.documents._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(r["criteria_id"] for r in b.documents.collect()) == ["c2", "c5"]


def test_row_keys_of_many_requests(spark):
    docs = frame(spark, [doc("TW_1", "TW_2", crit=c, post=c) for c in ("a", "a_", "a!", "b", "a|", "zz")])
    wide = wide_rows(docs)
    reqs = [req(crit=c) for c in ("a", "a!", "b", "a|")]
    want = sorted(r["post_id"] for r in build_graph(spark, wide, reqs, source_kind="wide").documents.collect())
    from weftgraph.sources.widerow import key_range_predicate
    for limit in (1, 2, 3, 200):
        kept = wide.where(key_range_predicate(sel.boxes_of(reqs, limit), "day_range"))
        assert sorted(r["post_id"] for r in build_graph(spark, kept, reqs, source_kind="wide").documents.collect()) == want
    assert want == ["a", "a!", "a|", "b"]


def test_linked_and_merged_edges(spark):
    docs = [doc("TW_1", "HT_1", dtype="TW_Hashtag", dname="#x", post=f"p{i}", ts=T0 + i) for i in range(3)] + \
        [doc("TW_2", "HT_1", dtype="TW_Hashtag", dname="#x"), doc("TW_1", "TW_2"), doc("TW_1", "HT_2", dtype="TW_Hashtag", dname="nTW_2"),
         doc("HT_9", "TW_2", stype="TW_Hashtag", sname=None), doc("TW_1", None)]
    plain = build_graph(spark, frame(spark, docs), [req()], require_target=False)
    assert plain.out_edges.count() == 1
    tag = next(r["id"] for r in plain.vertices.collect() if r["name"] == "#x")
    for bound in (2_000_000, 0):
        b = build_graph(spark, frame(spark, docs), [req()], link_non_accounts=True, max_broadcast_rows=bound)
        found = sorted((r["src"], r["dst"]) for r in b.out_edges.collect() if r["src"] > 0)
        assert found == sorted([(1, 2), (2, tag)] + 3 * [(1, tag)])
    m = build_graph(spark, frame(spark, docs), [req()], link_non_accounts=True, merge_parallel_edges=True)
    rows = {(r["src"], r["dst"]): r for r in m.out_edges.collect()}
    assert rows[(1, tag)]["weight"] == 3.0 and rows[(1, tag)]["post_id"] == "p0"
    assert sum(r["weight"] for r in rows.values()) == b.out_edges.count()


def test_messages_are_acknowledged_one_by_one(spark, scratch, builds):
    from weftgraph.streaming import run_stream
    os.makedirs(f"{scratch}/queue")
    for i in range(3):
        with open(f"{scratch}/queue/m{i}.json", "w") as f:
            f.write(json.dumps(network(i)) + "\n")
        os.utime(f"{scratch}/queue/m{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    source = frame(spark, [doc("TW_1", "TW_2", crit=f"c{i}") for i in range(4)])
    kw = dict(checkpoint=f"{scratch}/offsets", acknowledged=f"{scratch}/done")
    publish, stopped = Stage.publish, []

    def stops(self):
        batch = publish(self)
        if batch["id"] == 1 and not stopped:
            stopped.append(1)
            raise RuntimeError("stopped between publishing and acknowledging")
        return batch

    Stage.publish = stops
    try:
        with pytest.raises(Exception, match="stopped between"):
            run_stream(spark, f"{scratch}/queue", source, f"{scratch}/out", **kw).awaitTermination()
        assert len(builds) == 2  # the third message was not taken
        run_stream(spark, f"{scratch}/queue", source, f"{scratch}/out", **kw).awaitTermination()
    finally:
        Stage.publish = publish
    assert len(builds) == 3 and {s for s, _ in status_of(spark, f"{scratch}/out").values()} == {"done"}
    acknowledged = [f for _, _, names in os.walk(f"{scratch}/done") for f in names if f.endswith(".json")]
    left = [f for f in os.listdir(f"{scratch}/queue") if f.endswith(".json")]
    assert sorted(acknowledged + left) == ["m0.json", "m1.json", "m2.json"] and "m0.json" in acknowledged


def test_typed_values(spark):
    from weftgraph.sources.widerow import parse_documents
    rows = {"plain": '{"timestamp": 5, "text": 7, "post_id": "p"}', "long": '{"timestamp": {"$numberLong": "5"}, "text": "$"}',
            "double": '{"timestamp": {"$numberDouble": "5.0"}, "text": {"$numberDouble": "1.5"}}',
            "date": '{"timestamp": {"$date": {"$numberLong": "5"}}, "post_id": {"$oid": "abc"}}',
            "iso": '{"timestamp": {"$date": "1970-01-01T00:00:00.005Z"}, "text": "a \\"$date\\" b"}',
            "number": '{"timestamp": {"$date": 5}, "source": null}',
            "object": '{"timestamp": {"$date": 5}, "text": {"$binary": "x"}}', "half": '{"timestamp": {"$numberDouble": "5.5"}}',
            "broken": '{"timestamp": {"$date": 5}', "none": None}
    cells = spark.createDataFrame(list(rows.items()), "qualifier string, value string").withColumn("k", F.col("qualifier"))
    got = {r["k"]: r for r in parse_documents(cells, "report").collect()}
    for k in ("plain", "long", "double", "date", "iso", "number"):
        assert (got[k]["timestamp"], got[k]["error"]) == (5, None), k
    assert [got[k]["text"] for k in ("plain", "long", "double", "iso", "number")] == ["7", "$", "1.5", 'a "$date" b', None]
    assert got["date"]["post_id"] == "abc" and got["number"]["source"] is None
    assert got["object"]["error"] == 'unreadable text: {"$binary":"x"}'
    assert got["half"]["error"] == 'unreadable timestamp: {"$numberDouble":"5.5"}'
    assert got["broken"]["error"].startswith("malformed document: ") and got["none"]["error"] == "malformed document: null"
    assert {r["k"] for r in parse_documents(cells, "drop").collect()} == {"plain", "long", "double", "date", "iso", "number"}
    with pytest.raises(Exception, match="unreadable text"):
        parse_documents(cells.where("k = 'object'")).collect()
    assert parse_documents(cells.where("k = 'iso'")).select("timestamp").collect()[0][0] == 5
