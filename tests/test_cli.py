"""The command line presets, end to end on sf0.001 (golden counts of FIXTURES.md)."""

import json
import os

from conftest import sf_dir
from weftgraph.__main__ import main
from weftgraph.sources.fixtures import load_interactions, wide_rows

WINDOW = ("1704412800000", "1706227200000")


def test_cli_batch_presets(spark, scratch):
    inter = load_interactions(spark, sf_dir("0.001"))
    inter.write.parquet(os.path.join(scratch, "flat"))
    wide_rows(inter).write.parquet(os.path.join(scratch, "wide"))
    reqs = os.path.join(scratch, "req.jsonl")
    with open(reqs, "w") as f:
        f.write(json.dumps({"path": "o", "platform": "twitter", "criteria_id": "crit_0",
                            "from": WINDOW[0], "to": WINDOW[1]}) + "\n")
    out_h = os.path.join(scratch, "out_hbase")
    assert main(["batch", "--requests", reqs, "--documents", os.path.join(scratch, "wide"),
                 "--out", out_h, "--mode", "hbase"], spark=spark) == 0
    assert spark.read.parquet(f"{out_h}/nodes").count() == 73   # selection 1, cap 15000
    assert spark.read.parquet(f"{out_h}/edges").count() == 115
    with open(reqs, "w") as f:
        f.write(json.dumps({"path": "o", "platform": None, "criteria_id": "crit_0",
                            "from": WINDOW[0], "to": WINDOW[1]}) + "\n")
    out_m = os.path.join(scratch, "out_mongo")
    assert main(["batch", "--requests", reqs, "--documents", os.path.join(scratch, "flat"),
                 "--out", out_m, "--mode", "mongo"], spark=spark) == 0
    assert spark.read.parquet(f"{out_m}/nodes").count() == 77   # selection 3, edge-complete nodes
    assert spark.read.parquet(f"{out_m}/edges").count() == 144  # every valid edge
    status = spark.read.json(f"{out_m}/status").collect()
    assert [r["status"] for r in status] == ["done"]
