"""Pure helpers: shuffle sizing, partition folder names, request de-duplication, day counts."""

from weftgraph.session import scale_settings
from weftgraph.sinks.gexf import partition_dir
from weftgraph.sources.requests import day_count, unique_requests


def test_scale_settings_clamped_to_core_waves():
    big = scale_settings(100 * 1024 ** 4, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 8000 * 8
    small = scale_settings(10 * 1024 ** 2, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    mid = scale_settings(40 * 256 * 1024 ** 2, 8)
    assert int(mid["spark.sql.shuffle.partitions"]) == 40


def test_partition_dir_escapes_like_spark():
    assert partition_dir("crit_0_TW_1_2") == "graph_id=crit_0_TW_1_2"
    assert partition_dir("a/b:c=d?e#f%") == "graph_id=a%2Fb%3Ac%3Dd%3Fe%23f%25"


def test_unique_requests_and_day_counts():
    r = {"path": "o", "platform": "", "criteria_id": "c", "from": "0", "to": "1"}
    assert len(unique_requests([r, dict(r, platform=None), dict(r, path="p")], "timestamp_range")) == 1
    assert len(unique_requests([r, dict(r, platform="twitter")], "day_range")) == 2
    day = 86_400_000
    assert day_count("day_range", 0, 2 * day) == 2
    assert day_count("day_list", 0, 2 * day) == 3
    assert day_count("day_list", 2 * day, 0) == 0
