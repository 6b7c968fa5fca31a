"""Staged outputs of a batch, published together.

A batch writes everything under ``<out>/_staged/batch-<id>/`` first: node and
edge tables, documents, completion records and status rows, each in a folder
per network.  ``commit`` lists them in a manifest, one small file that is there
or not: the point from which on the batch counts as done.  ``publish`` then puts
the folders in the place of the old ones and removes the stage.

* A failure before the commit leaves all earlier outputs as they were.
* A failure after it is made good by ``finish``, which the next batch calls
  first: what is still staged goes where the manifest says; moves already made are skipped.

Folder names starting with ``_`` are not seen by Spark's readers.  Between the
removal of an old folder and the move of the new one a reader may miss a network;
its status row is the last to move.  A store without an atomic rename
(an object store) copies on a move.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.sinks.files import Files
from weftgraph.sinks.gexf import gexf_edges, gexf_nodes, partition_dir, read_back_edges, read_back_nodes, write_gexf
from weftgraph.sinks.tables import write_table

STAGED = "_staged"
MANIFEST = "manifest.jsonl"
PUBLISHED = "_published"
#: What a network may have, in the order of publishing; all but the documents lie under ``<out>/<name>``.
TABLES, RECORDS = ("nodes", "edges"), ("completed", "status")


class Stage:
    """The staged outputs of one batch of requests under ``out``."""

    def __init__(self, spark: SparkSession, out: str, batch_id: int | str):
        self.spark, self.out, self.files = spark, out.rstrip("/"), Files(spark)
        self.root = f"{self.out}/{STAGED}/batch-{batch_id}"
        self.elsewhere: dict[str, str] = {}  # another store -> its stage

    def clear(self) -> None:
        for root in (self.root, *self.elsewhere.values()):
            self.files.delete(root)

    def write_graphs(self, nodes: DataFrame, edges: DataFrame) -> None:
        """N6, staged."""
        write_table(gexf_nodes(nodes), f"{self.root}/nodes")
        write_table(gexf_edges(edges), f"{self.root}/edges")

    def write_documents(self, networks: DataFrame, paths: Iterable[tuple[str, str]]) -> None:
        """N5, staged: the documents of all networks (graph_id, route) from the staged tables, in one write per store.

        ``paths``: (route, folder) of every route, the short name of a folder.  A
        network with several routes is written for each of them.
        """
        nodes = read_back_nodes(self.spark, f"{self.root}/nodes")
        edges = read_back_edges(self.spark, f"{self.root}/edges")
        home, by_store = self.files.store(self.out), {}
        for route, folder in paths:
            by_store.setdefault(self.files.store(folder), {})[route] = folder
        for store, folders in by_store.items():
            root = self.root
            if store != home:
                root = self.elsewhere[store] = f"{next(iter(folders.values()))}/{STAGED}/{self.root.rsplit('/', 1)[1]}"
            here = networks if len(by_store) == 1 else networks.where(F.col("route").isin(sorted(folders)))
            write_gexf(here.select("graph_id").distinct(), nodes, edges, f"{root}/gexf", routes=here)

    def write_records(self, completed: DataFrame | None, status: DataFrame) -> None:
        """R5 and R6, staged."""
        if completed is not None:
            write_table(completed, f"{self.root}/completed", "text")
        write_table(status, f"{self.root}/status", "json")

    def commit(self, batch: dict, built: Iterable[str], failed: Iterable[str], folders: dict[str, str]) -> None:
        """Write the manifest: ``built`` networks get what is staged and lose what is not, ``failed`` ones lose their completion.

        ``folders``: where the documents of a route go.
        """
        files, lines = self.files, [json.dumps({"batch": batch})]

        def staged(name, target):
            found = [n for n in files.names(f"{self.root}/{name}") if n.startswith("graph_id=")]
            lines.extend(json.dumps({"move": f"{self.root}/{name}/{n}", "to": f"{target}/{n}"}) for n in found)
            return set(found)

        have = {name: staged(name, f"{self.out}/{name}") for name in TABLES}
        for root in (self.root, *self.elsewhere.values()):
            for route in files.names(f"{root}/gexf"):
                if route.startswith("route="):
                    to = folders[route.removeprefix("route=")]
                    lines.extend(json.dumps({"move": f"{root}/gexf/{route}/{n}", "to": f"{to}/{n}"})
                                 for n in files.names(f"{root}/gexf/{route}") if n.startswith("graph_id="))
        for graph_id in built:  # an empty network keeps no old rows
            folder = partition_dir(graph_id)
            lines.extend(json.dumps({"delete": f"{self.out}/{name}/{folder}"}) for name in TABLES if folder not in have[name])
        lines.extend(json.dumps({"delete": f"{self.out}/completed/{partition_dir(g)}"}) for g in failed)
        for name in RECORDS:
            staged(name, f"{self.out}/{name}")
        lines.extend(json.dumps({"stage": root}) for root in self.elsewhere.values())
        files.write_text(f"{self.root}/{MANIFEST}", "\n".join(lines))

    def publish(self) -> dict:
        """Do what the manifest says and is not done yet; returns the batch it names."""
        files, batch = self.files, {}
        for line in files.read_text(f"{self.root}/{MANIFEST}").split("\n"):
            step = json.loads(line)
            if "batch" in step:
                batch = step["batch"]
            elif "stage" in step:
                files.delete(step["stage"])
            elif "delete" in step:
                files.delete(step["delete"])
            elif files.exists(step["move"]):
                files.move(step["move"], step["to"])
        if batch.get("stream") is not None:
            files.write_text(_last(self.out, batch["stream"]), json.dumps(batch))
        files.delete(self.root)
        return batch


def _last(out: str, stream_id: str) -> str:
    return f"{out.rstrip('/')}/{PUBLISHED}/{stream_id}.json"


def last_published(spark: SparkSession, out: str, stream_id: str) -> dict | None:
    """The batch of a stream that was published last; a stream's batches come in order, so one is enough to know."""
    files, path = Files(spark), _last(out, stream_id)
    return json.loads(files.read_text(path)) if files.exists(path) else None


def finish(spark: SparkSession, out: str) -> list[dict]:
    """Publish the batches under ``out`` that were committed but not published; returns them."""
    files, root = Files(spark), f"{out.rstrip('/')}/{STAGED}"
    pending = [n for n in files.names(root) if files.exists(f"{root}/{n}/{MANIFEST}")]
    return [Stage(spark, out, n.removeprefix("batch-")).publish() for n in pending]
