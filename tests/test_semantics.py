"""
plain-Python model (tests/model.py) and by direct assertions."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

import model
from weftgraph.plans.build import build_graph
from weftgraph.sources.fixtures import INTERACTION_COLUMNS, INTERACTION_SCHEMA

T0 = 1704412800000  # 2024-01-05 00:00 UTC
DAY = 86_400_000


def doc(src=None, dst=None, *, sname=None, dname=None, stype="TW_Account", dtype="TW_Account",
        ts=T0 + 3_600_000, crit="c1", platform="TW", typ="reply", text="t", post=None):
    day = datetime.fromtimestamp(ts / 1000, tz=timezone.utc).strftime("%Y%m%d")
    return {"criteria_id": crit, "platform": platform, "day": day,
            "source": src, "source_type": stype if src is not None else None,
            "source_name": (sname if sname is not None else (f"n{src}" if src else None)) if src is not None else None,
            "target": dst, "target_type": dtype if dst is not None else None,
            "target_name": (dname if dname is not None else (f"n{dst}" if dst else None)) if dst is not None else None,
            "type": typ, "text": text, "timestamp": ts, "post_id": post or f"p{src}-{dst}-{ts}"}


def req(frm=T0, to=T0 + 3 * DAY, platform="twitter", crit="c1"):
    return {"path": "out", "platform": platform, "criteria_id": crit, "from": str(frm), "to": str(to)}


def frame(spark, docs):
    return spark.createDataFrame([tuple(d[c] for c in INTERACTION_COLUMNS) for d in docs], INTERACTION_SCHEMA)


def spark_result(b):
    nodes = {r["id"]: (r["name"], r["type"]) for r in b.nodes.collect()}
    edges = sorted((r["src"], r["dst"], r["typeedges"], r["text"], r["sourcename"], r["targetname"],
                    r["timestamp"], r["post_id"], r["sourcetype"], r["targettype"]) for r in b.out_edges.collect())
    return nodes, edges


def check_against_model(spark, docs, request, **kw):
    b = build_graph(spark, frame(spark, docs), [request], **kw)
    got_nodes, got_edges = spark_result(b)
    gid, nodes, edges, k = model.build(docs, request, **kw)
    assert got_nodes == nodes
    assert got_edges == sorted(edges)
    ths = b.thresholds.collect()
    if ths:
        assert ths[0]["k"] == k
    return b


def test_c1_day_bounds(spark):
    docs = [doc("TW_1", "TW_2", ts=T0 + i * DAY + 5) for i in range(4)]
    r = req(T0, T0 + 2 * DAY)  # days 05..07
    assert build_graph(spark, frame(spark, docs), [r], selection="day_range").documents.count() == 2
    assert build_graph(spark, frame(spark, docs), [r], selection="day_list").documents.count() == 3
    same_day = req(T0, T0 + 5)
    assert build_graph(spark, frame(spark, docs), [same_day], selection="day_range").documents.count() == 0
    assert build_graph(spark, frame(spark, docs), [same_day], selection="day_list").documents.count() == 1
    reversed_range = req(T0 + 2 * DAY, T0)
    assert build_graph(spark, frame(spark, docs), [reversed_range], selection="day_list").documents.count() == 0


def test_c2_timestamp_range_platform_optional(spark):
    docs = [doc("TW_1", "TW_2", platform="TW"), doc("TW_1", "TW_3", platform="FB"),
            doc("TW_1", "TW_3", platform="IG", ts=T0 + 10 * DAY)]
    r_all = req(T0, T0 + 3_600_000, platform=None)
    b = build_graph(spark, frame(spark, docs), [r_all], selection="timestamp_range", require_target=False)
    assert b.documents.count() == 2
    r_fb = req(T0, T0 + 3_600_000, platform="facebook")
    b = build_graph(spark, frame(spark, docs), [r_fb], selection="timestamp_range", require_target=False)
    assert b.documents.count() == 1
    # both ends inclusive
    r_exact = req(T0 + 3_600_000, T0 + 3_600_000, platform=None)
    assert build_graph(spark, frame(spark, docs), [r_exact], selection="timestamp_range").documents.count() == 2


def test_c3_name_dedup(spark):
    docs = [
        doc("TW_5", "TW_1", sname="bob"),     # 5 loses "bob" to 3: its edges are dropped
        doc("TW_3", "TW_1", sname="bob"),
        doc("TW_1", "HT_x", dname="alice", dtype="TW_Hashtag"),  # non-account named like account 1
        doc("TW_2", "TW_1", sname="carol", dname="alice"),
    ]
    b = check_against_model(spark, docs, req())
    nodes, edges = spark_result(b)
    assert 5 not in nodes and 3 in nodes
    assert all(e[0] != 5 for e in edges)
    assert nodes[1] == ("alice", "TW_Account")  # account before non-account


def test_c4_surrogates(spark):
    docs = [doc("TW_1", "HT_a", dname="#a", dtype="TW_Hashtag"), doc("TW_1", "HT_b", dname="#b", dtype="TW_Hashtag"),
            doc("TW_1", "TW_2")]
    b = check_against_model(spark, docs, req())
    numbered = {r["name"]: r["id"] for r in b.numbered.collect()}
    assert numbered["#a"] < 0 and numbered["#b"] < 0 and numbered["#a"] != numbered["#b"]
    assert sorted(r["id"] for r in b.nodes.collect()) == [1, 2]  # non-accounts never gain an edge


def test_c5_other_prefix(spark):
    docs = [doc("FB_7", "FB_8", stype="FB_Account", dtype="FB_Account", platform="FB")]
    r = req(platform="facebook")
    assert build_graph(spark, frame(spark, docs), [r]).nodes.count() == 0  # TW defaults: empty network
    b = build_graph(spark, frame(spark, docs), [r], account_type="FB_Account", id_prefix="FB_")
    assert sorted(x["id"] for x in b.nodes.collect()) == [7, 8]


def test_c6_require_target(spark):
    docs = [doc("TW_1", None), doc("TW_1", "TW_2"), doc("TW_4", None)]
    with_t = check_against_model(spark, docs, req(), require_target=True)
    without = check_against_model(spark, docs, req(), require_target=False)
    assert with_t.vertices.count() == 2 and without.vertices.count() == 3  # TW_4 only as a candidate
    assert without.valid_edges.count() == 1


def test_c7_cap_modes(spark):
    docs = [doc("TW_1", "TW_2"), doc("TW_1", "TW_3"), doc("TW_1", "TW_4"), doc("TW_2", "TW_3"), doc("TW_5", "TW_1")]
    ind = check_against_model(spark, docs, req(), cap=2)
    ec = check_against_model(spark, docs, req(), cap=2, cap_mode="edge_complete")
    assert ind.nodes.count() <= 2
    assert ec.out_edges.count() == 5 and ec.nodes.count() == 5


def test_c8_parallel_edges_and_self_loops(spark):
    docs = [doc("TW_1", "TW_2", post="a"), doc("TW_1", "TW_2", post="b"), doc("TW_3", "TW_3", post="c")]
    b = check_against_model(spark, docs, req())
    assert b.out_edges.count() == 3
    deg = {r["id"]: (r["in_degree"], r["out_degree"], r["degree"]) for r in b.nodes_deg.collect()}
    assert deg[1] == (0, 2, 2) and deg[3] == (1, 1, 2)


def test_c9_nulls_do_not_fail(spark):
    docs = [doc("TW_1", "TW_2", dtype=None), doc("TW_1", "TW_3", dname=None), doc(None, "TW_3"),
            doc("TW_4", "TW_3", text=None)]
    docs[0]["target_type"] = None  # a present endpoint with a null type
    docs[1]["target_name"] = None
    b = check_against_model(spark, docs, req())
    nodes, edges = spark_result(b)
    assert 2 not in nodes  # null type -> non-account with type "" -> not a node candidate
    assert any(e[3] is None for e in edges)


def test_c10_cap_zero_and_dense(spark):
    docs = [doc("TW_1", "TW_2", post=f"p{i}") for i in range(6)] + [doc("TW_3", "TW_1")]
    b = check_against_model(spark, docs, req(), cap=0)
    assert b.nodes.count() == 0 and b.out_edges.count() == 0
    check_against_model(spark, docs, req(), cap=1)


def test_e2_bad_account_id(spark):
    docs = [doc("TW_x1", "TW_2"), doc("TW_3", "TW_2")]
    with pytest.raises(Exception, match="bad account id"):
        build_graph(spark, frame(spark, docs), [req()], on_bad="fail").nodes.count()
    b = build_graph(spark, frame(spark, docs), [req()], on_bad="drop")
    assert sorted(r["id"] for r in b.nodes.collect()) == [2, 3]


def test_e1_every_prefix_removed(spark):
    docs = [doc("TW_1TW_2", "TW_3")]
    b = build_graph(spark, frame(spark, docs), [req()])
    assert sorted(r["id"] for r in b.nodes.collect()) == [3, 12]


def test_s3_unknown_platform_fails(spark):
    docs = [doc("TW_1", "TW_2")]
    with pytest.raises(Exception, match="unknown platform"):
        build_graph(spark, frame(spark, docs), [req(platform="myspace")]).nodes.count()


def test_many_requests_equal_single_runs(spark):
    docs = ([doc(f"TW_{i}", f"TW_{(i * 3) % 7 + 1}", crit=c, platform=p, ts=T0 + i * 7_200_000)
             for i in range(1, 30) for c in ("c1", "c2") for p in ("TW", "FB")])
    requests = [req(crit=c, platform=p) for c in ("c1", "c2") for p in ("twitter", "facebook")]
    requests.append(req(T0, T0 + DAY, crit="c1"))
    together = build_graph(spark, frame(spark, docs), requests, cap=4)
    by_graph = {}
    for r in together.nodes.collect():
        by_graph.setdefault(r["graph_id"], set()).add(r["id"])
    for r in requests:
        gid, nodes, _, _ = model.build(docs, r, cap=4)
        assert by_graph.get(gid, set()) == set(nodes)


def test_c11_wide_rows_bad_json(spark):
    from weftgraph.sources.fixtures import wide_rows
    from weftgraph.sources.requests import normalize_requests, requests_frame
    from weftgraph.sources.widerow import select_from_wide_rows
    docs = [doc("TW_1", "TW_2", post="a"), doc("TW_2", "TW_3", post="b"), doc("TW_3", "TW_1", post="c")]
    wide = wide_rows(frame(spark, docs))
    # corrupt one cell: a timestamp that is not a number
    bad = wide.withColumn("cells", F.transform_values(
        "cells", lambda k, v: F.when(k == "b", F.regexp_replace(v, '"timestamp":[0-9]+', '"timestamp":"x"'))
        .otherwise(v)))
    norm = normalize_requests(requests_frame(spark, [req()]), "day_range")
    assert select_from_wide_rows(wide, norm, "day_range").count() == 3
    with pytest.raises(Exception):
        select_from_wide_rows(bad, norm, "day_range", on_bad="fail").collect()
    kept = select_from_wide_rows(bad, norm, "day_range", on_bad="drop")
    assert sorted(r["post_id"] for r in kept.collect()) == ["a", "c"]
    # the wide rows give the same documents as the flat table
    flat = build_graph(spark, frame(spark, docs), [req()]).documents.select("post_id", "timestamp", "source")
    from_wide = select_from_wide_rows(wide, norm, "day_range").select("post_id", "timestamp", "source")
    assert sorted(flat.collect()) == sorted(from_wide.collect())


@pytest.mark.parametrize("selection", ["day_range", "day_list", "timestamp_range"])
def test_pushdown_predicates_are_supersets(spark, selection):
    from conftest import sf_dir
    from weftgraph.operators import select as sel
    from weftgraph.sources.fixtures import load_interactions
    from weftgraph.sources.requests import normalize_requests, requests_frame
    docs = load_interactions(spark, sf_dir("0.001"))
    ts = selection == "timestamp_range"
    reqs = [req(T0, T0 + 2 * DAY, crit="crit_0", platform=None if ts else "twitter"),
            req(T0 + 20 * DAY, T0 + 22 * DAY, crit="crit_2", platform="facebook")]
    norm = normalize_requests(requests_frame(spark, reqs), selection)
    exact = sorted(r["post_id"] + r["graph_id"] for r in
                   sel.select_documents(docs, norm, selection, require_target=False).collect())
    for boxes in (sel.boxes_of(reqs), sel.boxes_of(reqs, 1), sel.request_boxes(norm), sel.request_boxes(norm, 1)):
        for day_key in (False, True):
            pushed = docs.where(sel.pushdown_predicate(boxes, selection, day_key))
            got = sorted(r["post_id"] + r["graph_id"] for r in
                         sel.select_documents(pushed, norm, selection, require_target=False).collect())
            assert got == exact and len(exact) > 0
    # requests as a DataFrame; bounds beyond the days of a calendar stay plain
    far = [*reqs, req(-5 * 10 ** 14, 5 * 10 ** 14, crit="crit_1", platform=None)] if ts else reqs
    for some in (reqs, far):
        norm = normalize_requests(requests_frame(spark, some), selection)
        exact = sorted(r["post_id"] + r["graph_id"] for r in
                       sel.select_documents(docs, norm, selection, require_target=False).collect())
        b = build_graph(spark, docs, requests_frame(spark, some), selection=selection, require_target=False,
                        materialize_mode="none")
        assert sorted(r["post_id"] + r["graph_id"] for r in b.documents.collect()) == exact
