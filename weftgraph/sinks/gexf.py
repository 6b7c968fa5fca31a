"""Network output as GEXF.

Each network is written as an ordered set of text parts under
``<path>/graph_id=<id>/``; read in part-number order they form one GEXF
document (header, nodes, separator, edges, footer).  The lines are produced
by ``to_xml`` (Spark escapes the attribute values), range-partitioned by
``(graph_id, section, sort key)`` so a large network spans many tasks, and
sorted inside each task, so no task or driver ever holds a whole network.
``assemble`` joins the parts of one network into a single file on a local
file system, as a convenience for small outputs.
"""

from __future__ import annotations

import glob
import os
import shutil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftgraph.functions.expressions import xml_safe
from weftgraph.plans.broadcast import size_checked_broadcast

# Fixed GEXF text around the node and edge lines.
GEXF_NAMESPACE = "http://www.gexf.net/1.2draft"
NODE_ATTRIBUTES = [("nodes_type", "string")]
EDGE_ATTRIBUTES = [("edges_kind", "string"), ("post_id", "string"), ("text", "string"), ("timestamp", "long"),
                   ("source_name", "string"), ("target_name", "string"), ("source_id", "long"),
                   ("target_id", "long")]
EDGE_WEIGHT = 1.0
EDGE_TYPE = "directed"

SECTION_HEADER, SECTION_NODES, SECTION_MIDDLE, SECTION_EDGES, SECTION_FOOTER = range(5)


def gexf_nodes(nodes: DataFrame) -> DataFrame:
    """Output node rows ``(graph_id, id, label, nodes_type)``; ids as text."""
    return nodes.select("graph_id", F.col("id").cast("string").alias("id"),
                        F.col("name").alias("label"), F.col("type").alias("nodes_type"))


def gexf_edges(edges: DataFrame) -> DataFrame:
    """Output edge rows: the eight attributes, directed; weight 1.0 each, or that of merged edges."""
    weight = F.col("weight") if "weight" in edges.columns else F.lit(EDGE_WEIGHT)
    return edges.select(
        "graph_id", F.col("src").cast("string").alias("source"), F.col("dst").cast("string").alias("target"),
        F.col("typeedges").alias("edges_kind"), "post_id", "text", "timestamp",
        F.col("sourcename").alias("source_name"), F.col("targetname").alias("target_name"),
        F.col("src").alias("source_id"), F.col("dst").alias("target_id"),
        weight.alias("weight"), F.lit(EDGE_TYPE).alias("edge_type"))


def _escape(text: Column) -> Column:
    out = xml_safe(text)
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(raw), F.lit(entity))
    return out


def _attribute_block(kind: str, attrs) -> str:
    decl = "".join(f'      <attribute id="{a}" title="{a}" type="{t}"/>\n' for a, t in attrs)
    return f'    <attributes class="{kind}" mode="static">\n{decl}    </attributes>\n'


def _header(graph_id: Column) -> Column:
    head = ('<?xml version="1.0" encoding="UTF-8"?>\n'
            f'<gexf xmlns="{GEXF_NAMESPACE}" version="1.2">\n  <meta>\n    <creator>weftgraph</creator>\n'
            '    <description>')
    tail = ('</description>\n  </meta>\n'
            f'  <graph defaultedgetype="{EDGE_TYPE}" mode="static">\n'
            + _attribute_block("node", NODE_ATTRIBUTES) + _attribute_block("edge", EDGE_ATTRIBUTES)
            + "    <nodes>")
    return F.concat(F.lit(head), _escape(graph_id), F.lit(tail))


def _attvalues(pairs) -> Column:
    entries = F.array(*[F.struct(F.lit(name).alias("_for"), value.cast("string").alias("_value"))
                        for name, value in pairs])
    return F.struct(F.filter(entries, lambda e: e["_value"].isNotNull()).alias("attvalue"))


EDGE_STRUCT_FIELDS = ["typeedges", "text", "sourcename", "targetname", "timestamp", "post_id", "src", "dst"]


def gexf_lines(graph_ids: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """All lines of every network with their order keys; edge lines are rendered later."""
    edge_struct = F.struct(*[F.col(c) for c in EDGE_STRUCT_FIELDS + [c for c in ("weight",) if c in edges.columns]])
    no_edge = F.lit(None).cast(edges.select(edge_struct.alias("e")).schema["e"].dataType)
    null_l, null_s = F.lit(None).cast("bigint"), F.lit(None).cast("string")

    def row(frame: DataFrame, section: int, k1, k2, k3, k4, line, e) -> DataFrame:
        return frame.select("graph_id", F.lit(section).alias("section"), k1.alias("k1"), k2.alias("k2"),
                            k3.alias("k3"), k4.alias("k4"), line.alias("line"), e.alias("e"))

    node_xml = F.to_xml(F.struct(
        F.col("id").cast("string").alias("_id"), xml_safe(F.col("name")).alias("_label"),
        _attvalues([("nodes_type", xml_safe(F.col("type")))]).alias("attvalues")), {"rowTag": "node"})
    parts = [
        row(graph_ids, SECTION_HEADER, null_l, null_l, null_l, null_s, _header(F.col("graph_id")), no_edge),
        row(nodes, SECTION_NODES, F.col("id"), null_l, null_l, null_s, node_xml, no_edge),
        row(graph_ids, SECTION_MIDDLE, null_l, null_l, null_l, null_s, F.lit("    </nodes>\n    <edges>"), no_edge),
        row(edges, SECTION_EDGES, F.col("src"), F.col("dst"), F.col("timestamp"), F.col("post_id"), null_s,
            edge_struct),
        row(graph_ids, SECTION_FOOTER, null_l, null_l, null_l, null_s,
            F.lit("    </edges>\n  </graph>\n</gexf>"), no_edge),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _edge_xml(edge_id: Column, weighted: bool) -> Column:
    e = F.col("e")
    weight = e["weight"] if weighted else F.lit(EDGE_WEIGHT)
    return F.to_xml(F.struct(
        edge_id.cast("string").alias("_id"), e["src"].cast("string").alias("_source"),
        e["dst"].cast("string").alias("_target"), weight.alias("_weight"),
        _attvalues([("edges_kind", xml_safe(e["typeedges"])), ("post_id", xml_safe(e["post_id"])),
                    ("text", xml_safe(e["text"])), ("timestamp", e["timestamp"]),
                    ("source_name", xml_safe(e["sourcename"])), ("target_name", xml_safe(e["targetname"])),
                    ("source_id", e["src"]), ("target_id", e["dst"])]).alias("attvalues")),
        {"rowTag": "edge"})


def read_back_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Written node rows (N6) as ``(graph_id, id, name, type)``."""
    rows = spark.read.schema("id string, label string, nodes_type string, graph_id string").parquet(path)
    return rows.select("graph_id", F.col("id").cast("bigint").alias("id"), F.col("label").alias("name"),
                       F.col("nodes_type").alias("type"))


def read_back_edges(spark: SparkSession, path: str) -> DataFrame:
    """Written edge rows (N6) with the columns that GEXF lines need."""
    rows = spark.read.schema("edges_kind string, post_id string, text string, timestamp long, source_name string, "
                             "target_name string, source_id long, target_id long, weight double, graph_id string").parquet(path)
    return rows.select("graph_id", F.col("source_id").alias("src"), F.col("target_id").alias("dst"),
                       F.col("edges_kind").alias("typeedges"), "post_id", "text", "timestamp",
                       F.col("source_name").alias("sourcename"), F.col("target_name").alias("targetname"), "weight")


def ordered_lines(graph_ids: DataFrame, nodes: DataFrame, edges: DataFrame, partitions: int | None = None,
                  routes: DataFrame | None = None) -> DataFrame:
    """Lines range-partitioned and sorted by ``(graph_id, section, keys)``, edges numbered.

    ``routes`` (graph_id, route) gives each network its lines once per route, with the route as a column.

    An edge's id is a digest of its ends, time and post, and its number among
    the edges that have the same: it depends on the network alone, not on the
    partitions or on other networks.  Such edges lie in one range partition,
    already sorted, so the numbering needs no further shuffle.
    """
    lines, keys = gexf_lines(graph_ids, nodes, edges), ["graph_id"]
    if routes is not None:
        lines, keys = lines.join(size_checked_broadcast(routes, count_if_unknown=True), "graph_id"), ["route", "graph_id"]
    order = [*keys, "section", "k1", "k2", "k3", "k4"]
    spark = nodes.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = lines.repartitionByRange(n, *order).sortWithinPartitions(*order, "e", "line")
    nth = F.row_number().over(Window.partitionBy(*order).orderBy("e", "line"))
    digest = F.md5(F.to_json(F.struct("k1", "k2", "k3", "k4")))
    numbered = ranged.withColumn("n", nth).withColumn(
        "line", F.when(F.col("section") == SECTION_EDGES, _edge_xml(F.concat_ws("-", digest, "n"), "weight" in edges.columns))
        .otherwise(F.col("line")))
    return numbered.select(*keys, "line")


def write_gexf(graph_ids: DataFrame, nodes: DataFrame, edges: DataFrame, path: str,
               partitions: int | None = None, routes: DataFrame | None = None) -> None:
    """Write every network as ordered GEXF parts under ``path/graph_id=<id>/``.

    With ``routes`` under ``path/route=<route>/graph_id=<id>/``, all of them by one write.

    Written with dynamic partition overwrite, so rewriting a network (a replayed
    request) replaces only its own folder.
    """
    (ordered_lines(graph_ids, nodes, edges, partitions, routes)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*(["route"] if routes is not None else []), "graph_id").text(path))


# Characters Spark escapes as %XX in partition directory names.
_PATH_ESCAPED = set(chr(c) for c in range(1, 32)) | set('"#%\'*/:=?\\\x7f{[]^')


def partition_dir(value: str) -> str:
    """The directory name Spark gives the partition ``graph_id=<value>``."""
    return "graph_id=" + "".join(f"%{ord(c):02X}" if c in _PATH_ESCAPED else c for c in value)


def part_files(path: str, graph_id: str) -> list[str]:
    """The text parts of one network, in document order."""
    found = glob.glob(os.path.join(glob.escape(path), glob.escape(partition_dir(graph_id)), "part-*"))
    return sorted(found, key=lambda p: (int(os.path.basename(p).split("-")[1]), p))


def assemble(path: str, graph_id: str, target: str) -> str:
    """Join the parts of one network into ``target`` (local file systems; a byte copy)."""
    with open(target, "wb") as out:
        for part in part_files(path, graph_id):
            with open(part, "rb") as src:
                shutil.copyfileobj(src, out)
    return target
