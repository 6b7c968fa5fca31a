"""Golden counts of FIXTURES.md on the events-derived fixture (criteria crit_0)."""

import pytest
from pyspark.sql import functions as F

from conftest import sf_dir
from weftgraph.plans.build import build_graph
from weftgraph.sources.fixtures import load_interactions

WINDOW = ("1704412800000", "1706227200000")


def _request(platform="twitter"):
    return {"path": "out", "platform": platform, "criteria_id": "crit_0", "from": WINDOW[0], "to": WINDOW[1]}


# sf, cap, documents, named, accounts, valid, k, nodes, edges, sum of edge timestamps
SELECTION_1 = [
    ("0.001", 15000, 163, 107, 74, 115, 1, 73, 115, 196105322284541),
    ("0.001", 40, 163, 107, 74, 115, 3, 22, 45, 76741705653152),
    ("0.001", 10, 163, 107, 74, 115, 9, 9, 11, 18757874657792),
    ("0.01", 15000, 1467, 242, 143, 971, 1, 143, 971, 1655874113167237),
    ("0.01", 40, 1467, 242, 143, 971, 18, 40, 198, 337652857942618),
    ("0.01", 10, 1467, 242, 143, 971, 24, 10, 12, 20461725901656),
    ("0.1", 40, 15028, 1513, 1413, 9912, 114, 39, 124, 211465795317142),
    ("0.1", 10, 15028, 1513, 1413, 9912, 124, 10, 11, 18760223045090),
]

# sf, selection, cap, documents, named, accounts, valid, k, nodes, edges, edge_complete nodes
SELECTIONS_2_3 = [
    ("0.001", "day_list", 15000, 168, 109, 75, 119, 1, 74, 119, 74),
    ("0.001", "day_list", 40, 168, 109, 75, 119, 3, 22, 46, 74),
    ("0.001", "timestamp_range", 15000, 241, 114, 78, 144, 1, 77, 144, 77),
    ("0.001", "timestamp_range", 40, 241, 114, 78, 144, 3, 26, 67, 77),
    ("0.01", "day_list", 40, 1536, 242, 143, 1018, 19, 39, 181, 143),
    ("0.01", "timestamp_range", 40, 2326, 243, 143, 1205, 22, 40, 213, 143),
]


@pytest.fixture(scope="module")
def interactions(spark):
    return {sf: load_interactions(spark, sf_dir(sf)) for sf in ("0.001", "0.01", "0.1")}


def _stage_counts(build):
    return (build.documents.count(), build.by_name.count(), build.vertices.where("id > 0").count(),
            build.valid_edges.count(), build.thresholds.collect()[0]["k"])


@pytest.mark.parametrize("row", SELECTION_1, ids=lambda r: f"sf{r[0]}-cap{r[1]}")
def test_selection_1_day_range(spark, interactions, row):
    sf, cap, docs, named, accounts, valid, k, nodes, edges, ts_sum = row
    b = build_graph(spark, interactions[sf], [_request()], selection="day_range", cap=cap)
    assert _stage_counts(b) == (docs, named, accounts, valid, k)
    assert b.nodes.count() == nodes
    e = b.out_edges.agg(F.count(F.lit(1)).alias("n"), F.sum("timestamp").alias("s")).collect()[0]
    assert (e["n"], e["s"]) == (edges, ts_sum)


def test_self_loops(spark, interactions):
    expected = {"0.001": 1, "0.01": 10}
    for sf, loops in expected.items():
        b = build_graph(spark, interactions[sf], [_request()], selection="day_range")
        assert b.valid_edges.where("src = dst").count() == loops


@pytest.mark.parametrize("row", SELECTIONS_2_3, ids=lambda r: f"sf{r[0]}-{r[1]}-cap{r[2]}")
def test_selections_2_and_3(spark, interactions, row):
    sf, selection, cap, docs, named, accounts, valid, k, nodes, edges, ec_nodes = row
    ts = selection == "timestamp_range"
    req = _request(None if ts else "twitter")
    b = build_graph(spark, interactions[sf], [req], selection=selection, cap=cap, require_target=not ts)
    assert _stage_counts(b) == (docs, named, accounts, valid, k)
    assert (b.nodes.count(), b.out_edges.count()) == (nodes, edges)
    ec = build_graph(spark, interactions[sf], [req], selection=selection, cap=cap, require_target=not ts,
                     cap_mode="edge_complete")
    assert ec.nodes.count() == ec_nodes
    assert ec.out_edges.count() == valid


def test_documents_without_day_column(spark, interactions):
    """A document store has no day keys: they are derived from the timestamp."""
    b = build_graph(spark, interactions["0.001"].drop("day"), [_request()], selection="day_range")
    assert (b.documents.count(), b.nodes.count(), b.out_edges.count()) == (163, 73, 115)


def test_rebalanced_interactions_same_result(spark, interactions):
    b = build_graph(spark, interactions["0.001"], [_request()], selection="day_range", rebalance=True)
    assert (b.documents.count(), b.nodes.count(), b.out_edges.count()) == (163, 73, 115)
