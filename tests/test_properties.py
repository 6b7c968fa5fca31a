"""Properties of a build, and random small inputs checked against the brute-force model."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import model
from conftest import sf_dir
from test_semantics import T0, doc, frame, req
from weftgraph.plans.build import build_graph
from weftgraph.plans.catalog import DAY_REQUESTS
from weftgraph.sources.fixtures import load_interactions

NAMES = ["ann", "bob", "cat", "dup", None]


@st.composite
def endpoint(draw):
    kind = draw(st.sampled_from(["acct", "acct", "acct", "tag", "none"]))
    if kind == "none":
        return None, None, None
    if kind == "tag":
        t = draw(st.sampled_from(["x", "y", "dup"]))
        return f"HT_{t}", f"#{t}" if t != "dup" else "dup", "TW_Hashtag"
    i = draw(st.integers(1, 7))
    name = draw(st.sampled_from(NAMES[:4] + [f"u{i}"]))
    return f"TW_{i}", name, "TW_Account"


@st.composite
def documents(draw):
    n = draw(st.integers(1, 25))
    out = []
    for j in range(n):
        (s, sn, stp), (t, tn, ttp) = draw(endpoint()), draw(endpoint())
        d = doc(s, t, sname=sn, dname=tn, stype=stp or "TW_Account", dtype=ttp or "TW_Account",
                ts=T0 + draw(st.integers(0, 4 * 86_400_000)), post=f"p{j}")
        out.append(d)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(docs=documents(), cap=st.integers(0, 8), mode=st.sampled_from(["induced", "edge_complete"]),
       selection=st.sampled_from(["day_range", "day_list", "timestamp_range"]))
def test_random_networks_match_model(spark, docs, cap, mode, selection):
    r = req(T0, T0 + 2 * 86_400_000, platform=None if selection == "timestamp_range" else "twitter")
    rt = selection != "timestamp_range"
    b = build_graph(spark, frame(spark, docs), [r], selection=selection, cap=cap, cap_mode=mode,
                    require_target=rt, materialize_mode="none")
    got_nodes = {x["id"]: (x["name"], x["type"]) for x in b.nodes.collect()}
    got_edges = sorted((x["src"], x["dst"], x["post_id"]) for x in b.out_edges.collect())
    _, nodes, edges, _ = model.build(docs, r, selection=selection, cap=cap, cap_mode=mode, require_target=rt)
    assert got_nodes == nodes
    assert got_edges == sorted((e[0], e[1], e[7]) for e in edges)


@pytest.fixture(scope="module")
def build01(spark):
    return build_graph(spark, load_interactions(spark, sf_dir("0.01")), DAY_REQUESTS, cap=40)


def test_cap_respected_and_threshold_minimal(build01):
    th = {r["graph_id"]: r for r in build01.thresholds.collect()}
    hist = {}
    for r in build01.nodes_deg.groupBy("graph_id", "degree").count().collect():
        hist.setdefault(r["graph_id"], []).append((r["degree"], r["count"]))
    for gid, r in th.items():
        at_least = lambda k: sum(c for d, c in hist[gid] if d >= k)
        assert r["n_kept"] == at_least(r["k"]) <= 40
        if r["k"] > 1:
            assert at_least(r["k"] - 1) > 40


def test_edges_inside_nodes_and_degree_sums(build01):
    e = build01.out_edges.select("graph_id", "src", "dst")
    ids = build01.nodes.select("graph_id", "id")
    assert e.join(ids.withColumnRenamed("id", "src"), ["graph_id", "src"], "left_anti").count() == 0
    assert e.join(ids.withColumnRenamed("id", "dst"), ["graph_id", "dst"], "left_anti").count() == 0
    sums = build01.nodes_deg.groupBy("graph_id").agg(F.sum("in_degree").alias("i"), F.sum("out_degree").alias("o"))
    valid = build01.valid_edges.groupBy("graph_id").count()
    for r in sums.join(valid, "graph_id", "left").collect():
        assert r["i"] == r["o"] == (r["count"] or 0)


def test_partitioning_does_not_change_results(spark):
    inter = load_interactions(spark, sf_dir("0.001"))
    base = build_graph(spark, inter, DAY_REQUESTS, cap=10)
    expected = sorted(tuple(r) for r in base.nodes.collect()), sorted(tuple(r) for r in base.out_edges.collect())
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        other = build_graph(spark, inter.repartition(7), DAY_REQUESTS, cap=10)
        got = sorted(tuple(r) for r in other.nodes.collect()), sorted(tuple(r) for r in other.out_edges.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == expected


def test_hot_keys_match_model_and_combine_map_side(spark):
    """A third of the documents point at one account; one name is shared by many accounts; one hot hashtag."""
    docs = []
    for i in range(1, 301):
        if i % 3 == 0:
            docs.append(doc(f"TW_{i}", "TW_1", sname="dup" if i % 2 else f"u{i}", post=f"h{i}"))
        elif i % 3 == 1:
            docs.append(doc(f"TW_{i}", "HT_hot", sname=f"u{i}", dname="#hot", dtype="TW_Hashtag", post=f"t{i}"))
        else:
            docs.append(doc(f"TW_{i}", f"TW_{i % 17 + 2}", sname=f"u{i}", post=f"o{i}"))
    r = req()
    b = build_graph(spark, frame(spark, docs), [r], cap=20)
    _, nodes, edges, k = model.build(docs, r, cap=20)
    assert {x["id"]: (x["name"], x["type"]) for x in b.nodes.collect()} == nodes
    assert b.out_edges.count() == len(edges)
    # node-level aggregations reduce map-side before their shuffle (no single task holds the hub's rows)
    from weftgraph.operators import nodes as nodeops
    plan = nodeops.nodes_by_name(nodeops.distinct_endpoints(nodeops.endpoint_union(b.interactions))) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_without_broadcasts_same_results(spark):
    """Above every size limit the joins shuffle instead; the networks are the same."""
    inter = load_interactions(spark, sf_dir("0.001"))
    base = build_graph(spark, inter, DAY_REQUESTS, cap=10)
    expected = sorted(tuple(r) for r in base.nodes.collect()), sorted(tuple(r) for r in base.out_edges.collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        other = build_graph(spark, inter, DAY_REQUESTS, cap=10, max_broadcast_rows=0)
        got = sorted(tuple(r) for r in other.nodes.collect()), sorted(tuple(r) for r in other.out_edges.collect())
        plan = other.out_edges._jdf.queryExecution().executedPlan().toString()
        docs_plan = other.documents._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == expected
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert "BroadcastHashJoin" not in docs_plan
