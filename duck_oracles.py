"""DuckDB oracle SQL for every registered query.

Written independently of the Spark plans, in plain SQL over the pre-registered
views (``events`` …): the vertex test is a pair of semi joins with the vertex
table, the degree threshold is the smallest candidate that fits the cap
(a correlated count), surrogate ids are one global ``row_number`` per network.
"""

from __future__ import annotations

import hashlib
import json

from weftgraph.plans.catalog import (BAD_REQUESTS, BINNED_REQUESTS, DAY_REQUESTS, FAULTY, MESSY_MESSAGES, PATH_REQUESTS,
                                     SMALL_CAP, TS_REQUESTS, WINDOW)

INTERACTIONS = """
ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
interactions AS (
  SELECT 'crit_' || CAST(event_id % 3 AS VARCHAR) AS criteria_id,
         CASE event_id % 10 WHEN 8 THEN 'FB' WHEN 9 THEN 'IG' ELSE 'TW' END AS platform,
         strftime(ts, '%Y%m%d') AS day,
         CASE WHEN event_id % 53 = 0 THEN NULL ELSE 'TW_' || CAST(user_id + 1 AS VARCHAR) END AS source,
         CASE WHEN event_id % 53 = 0 THEN NULL ELSE 'TW_Account' END AS source_type,
         CASE WHEN event_id % 53 = 0 THEN NULL WHEN user_id % 17 = 16 THEN 'user_dup'
              ELSE 'user_' || CAST(user_id + 1 AS VARCHAR) END AS source_name,
         CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'signup' THEN 'HT_' || CAST(k AS VARCHAR)
              ELSE 'TW_' || CAST(k + 1 AS VARCHAR) END AS target,
         CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'signup' THEN 'TW_Hashtag'
              ELSE 'TW_Account' END AS target_type,
         CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'signup' THEN '#tag_' || CAST(k AS VARCHAR)
              WHEN k % 17 = 16 THEN 'user_dup' ELSE 'user_' || CAST(k + 1 AS VARCHAR) END AS target_name,
         event_type AS type, props AS text,
         epoch_us(ts) // 1000 AS timestamp,
         md5(CAST(event_id AS VARCHAR)) AS post_id
  FROM ev)"""

DOC_COLS = ("criteria_id, platform, day, source, source_type, source_name, target, target_type, target_name, "
            "type, text, timestamp, post_id")


def _values(requests) -> str:
    def lit(v):
        return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"
    rows = ",\n    ".join(f"({lit(r['path'])}, {lit(r['platform'])}, {lit(r['criteria_id'])}, "
                          f"{lit(r['from'])}, {lit(r['to'])})" for r in requests)
    return rows


def _requests_cte(requests) -> str:
    return f"""
raw_req(path, platform, criteria_id, "from", "to") AS (VALUES
    {_values(requests)}),
req AS (
  SELECT *, criteria_id || '_' || coalesce(code, 'ALL') || '_' || "from" || '_' || "to" AS graph_id,
         strftime(epoch_ms(from_ms), '%Y%m%d') AS start_day, strftime(epoch_ms(to_ms), '%Y%m%d') AS end_day
  FROM (SELECT *, CASE platform WHEN 'twitter' THEN 'TW' WHEN 'facebook' THEN 'FB' WHEN 'instagram' THEN 'IG'
                  END AS code,
               CAST("from" AS BIGINT) AS from_ms, CAST("to" AS BIGINT) AS to_ms FROM raw_req))"""


def _selection(selection: str) -> str:
    if selection == "day_range":
        cond = "i.platform = r.code AND i.day >= r.start_day AND i.day < r.end_day AND i.target IS NOT NULL"
    elif selection == "day_list":
        cond = "i.platform = r.code AND i.day >= r.start_day AND i.day <= r.end_day AND i.target IS NOT NULL"
    else:
        cond = "(r.code IS NULL OR i.platform = r.code) AND i.timestamp BETWEEN r.from_ms AND r.to_ms"
    return f"""
selected AS (SELECT r.graph_id, i.* FROM interactions i JOIN req r ON i.criteria_id = r.criteria_id AND {cond})"""


PIPELINE = """
resolved AS (
  SELECT graph_id,
    CASE WHEN source IS NOT NULL AND source_type = 'TW_Account' THEN CAST(replace(source, 'TW_', '') AS BIGINT)
         ELSE 0 END AS sourceid,
    CASE WHEN target IS NOT NULL AND target_type = 'TW_Account' THEN CAST(replace(target, 'TW_', '') AS BIGINT)
         ELSE 0 END AS targetid,
    CASE WHEN source IS NOT NULL THEN source_name ELSE '' END AS sourcename,
    CASE WHEN target IS NOT NULL THEN target_name ELSE '' END AS targetname,
    CASE WHEN source IS NOT NULL THEN coalesce(source_type, '') ELSE '' END AS sourcetype,
    CASE WHEN target IS NOT NULL THEN coalesce(target_type, '') ELSE '' END AS targettype,
    type AS typeedges, text, timestamp, post_id
  FROM selected),
endpoints AS (
  SELECT graph_id, sourceid AS id, sourcename AS name, sourcetype AS type FROM resolved WHERE sourcetype <> ''
  UNION ALL
  SELECT graph_id, targetid, targetname, targettype FROM resolved WHERE targettype <> ''),
by_name AS (
  SELECT graph_id, id, name, type FROM (
    SELECT *, row_number() OVER (PARTITION BY graph_id, name ORDER BY (id = 0), id, type) AS rn FROM endpoints)
  WHERE rn = 1),
numbered AS (
  SELECT graph_id, id, name, type FROM by_name WHERE id <> 0
  UNION ALL
  SELECT graph_id,
         -row_number() OVER (PARTITION BY graph_id ORDER BY md5(coalesce(name, '')), name NULLS FIRST) AS id,
         name, type
  FROM by_name WHERE id = 0),
vertices AS (
  SELECT graph_id, id, name, type FROM (
    SELECT *, row_number() OVER (PARTITION BY graph_id, id ORDER BY name NULLS FIRST, type NULLS FIRST) AS rn
    FROM numbered) WHERE rn = 1),
edges AS (
  SELECT graph_id, sourceid AS src, targetid AS dst, typeedges, text, sourcename, targetname, timestamp, post_id,
         sourcetype, targettype FROM resolved),
valid AS (
  SELECT e.* FROM edges e
  WHERE EXISTS (SELECT 1 FROM vertices v WHERE v.graph_id = e.graph_id AND v.id = e.src)
    AND EXISTS (SELECT 1 FROM vertices v WHERE v.graph_id = e.graph_id AND v.id = e.dst)),
deg AS (
  SELECT graph_id, id, sum(i) AS in_degree, sum(o) AS out_degree FROM (
    SELECT graph_id, src AS id, 0 AS i, 1 AS o FROM valid
    UNION ALL SELECT graph_id, dst AS id, 1 AS i, 0 AS o FROM valid)
  GROUP BY graph_id, id),
nodes_deg AS (
  SELECT v.graph_id, v.id, v.name, v.type,
         CAST(coalesce(d.in_degree, 0) AS BIGINT) AS in_degree,
         CAST(coalesce(d.out_degree, 0) AS BIGINT) AS out_degree,
         CAST(coalesce(d.in_degree + d.out_degree, 0) AS BIGINT) AS degree
  FROM vertices v LEFT JOIN deg d ON v.graph_id = d.graph_id AND v.id = d.id),
totals AS (SELECT graph_id, count(*) AS n_vertices FROM nodes_deg GROUP BY graph_id),
candidates AS (SELECT DISTINCT graph_id, degree + 1 AS i FROM nodes_deg),
thresholds AS (
  SELECT t.graph_id, t.n_vertices,
    CAST(CASE WHEN t.n_vertices <= {cap} THEN 1 ELSE (
      SELECT min(c.i) FROM candidates c WHERE c.graph_id = t.graph_id
        AND (SELECT count(*) FROM nodes_deg x WHERE x.graph_id = c.graph_id AND x.degree >= c.i) <= {cap})
    END AS BIGINT) AS k
  FROM totals t),
kept AS (SELECT n.* FROM nodes_deg n JOIN thresholds t ON n.graph_id = t.graph_id WHERE n.degree >= t.k),
induced AS (
  SELECT e.* FROM valid e
  WHERE EXISTS (SELECT 1 FROM kept v WHERE v.graph_id = e.graph_id AND v.id = e.src)
    AND EXISTS (SELECT 1 FROM kept v WHERE v.graph_id = e.graph_id AND v.id = e.dst)),
edge_complete AS (
  SELECT graph_id, id, name, type FROM (
    SELECT *, row_number() OVER (PARTITION BY graph_id, id ORDER BY priority, name NULLS FIRST, type NULLS FIRST)
      AS rn
    FROM (SELECT graph_id, id, name, type, 0 AS priority FROM kept
          UNION ALL SELECT graph_id, dst, targetname, targettype, 1 FROM valid
          UNION ALL SELECT graph_id, src, sourcename, sourcetype, 1 FROM valid))
  WHERE rn = 1)"""

EDGE_COLS = "graph_id, src, dst, typeedges, text, sourcename, targetname, timestamp, post_id, sourcetype, targettype"


def _with(selection: str, cap: int = 15000) -> str:
    requests = TS_REQUESTS if selection == "timestamp_range" else DAY_REQUESTS
    return ("WITH" + INTERACTIONS + "," + _requests_cte(requests) + "," + _selection(selection) + ","
            + PIPELINE.replace("{cap}", str(cap)) + "\n")


def _counts_sql(selection: str, cap: int, mode: str) -> str:
    nodes, edges = ("kept", "induced") if mode == "induced" else ("edge_complete", "valid")
    return _with(selection, cap) + f"""
SELECT r.graph_id, CAST(coalesce(n.nodes, 0) AS BIGINT) AS nodes, CAST(coalesce(e.edges, 0) AS BIGINT) AS edges
FROM req r
LEFT JOIN (SELECT graph_id, count(*) AS nodes FROM {nodes} GROUP BY graph_id) n ON r.graph_id = n.graph_id
LEFT JOIN (SELECT graph_id, count(*) AS edges FROM {edges} GROUP BY graph_id) e ON r.graph_id = e.graph_id"""


def _thresholds_sql(cap: int) -> str:
    return _with("day_range", cap) + """
SELECT t.graph_id, t.n_vertices, t.k,
       CAST((SELECT count(*) FROM nodes_deg n WHERE n.graph_id = t.graph_id AND n.degree >= t.k) AS BIGINT) AS n_kept
FROM thresholds t"""


def oracle_sql() -> dict[str, str]:
    dr = _with("day_range")
    c40 = _with("day_range", SMALL_CAP)
    sample_sql = ("WITH" + INTERACTIONS + f"\nSELECT {DOC_COLS} FROM interactions WHERE criteria_id = 'crit_0' "
                  "ORDER BY timestamp, post_id LIMIT 10")
    completed = dr + """
SELECT r.graph_id,
  '{"path":"' || r.path || '","platform":"' || r.platform || '","criteria_id":"' || r.criteria_id
    || '","from":"' || r."from" || '","to":"' || r."to" || '","step":"analysis_network"}' AS message,
  CAST(coalesce(n.nodes, 0) AS BIGINT) AS nodes, CAST(coalesce(e.edges, 0) AS BIGINT) AS edges
FROM req r
LEFT JOIN (SELECT graph_id, count(*) AS nodes FROM kept GROUP BY graph_id) n ON r.graph_id = n.graph_id
LEFT JOIN (SELECT graph_id, count(*) AS edges FROM induced GROUP BY graph_id) e ON r.graph_id = e.graph_id"""
    status_sql = ("WITH" + INTERACTIONS + "," + _requests_cte(DAY_REQUESTS + BAD_REQUESTS).replace(
        'CAST("from" AS BIGINT) AS from_ms, CAST("to" AS BIGINT) AS to_ms',
        'TRY_CAST("from" AS BIGINT) AS from_ms, TRY_CAST("to" AS BIGINT) AS to_ms')
        + ",\nchecked AS (SELECT *, CASE WHEN code IS NULL THEN 'unknown platform' "
        "WHEN from_ms IS NULL OR to_ms IS NULL THEN 'bad time range' END AS error FROM req),"
        + _selection("day_range").replace("JOIN req r", "JOIN (SELECT * FROM checked WHERE error IS NULL) r")
        + """
SELECT c.graph_id, CASE WHEN c.error IS NULL THEN 'done' ELSE 'failed' END AS status, c.error,
       CAST(count(s.graph_id) AS BIGINT) AS documents
FROM checked c LEFT JOIN selected s ON c.graph_id = s.graph_id
GROUP BY c.graph_id, c.error""")
    requests_docs = _with("day_list") + """
SELECT r.graph_id, CAST(count(s.graph_id) AS BIGINT) AS documents
FROM req r LEFT JOIN selected s ON r.graph_id = s.graph_id GROUP BY r.graph_id"""
    store_cols = DOC_COLS.replace("platform, day, ", "")
    store_reqs = _requests_cte([{**r, "platform": None} for r in DAY_REQUESTS])
    store_sql = ("WITH" + INTERACTIONS + "," + store_reqs + "," + _selection("timestamp_range")
                 + f"\nSELECT DISTINCT graph_id, {store_cols} FROM selected")
    # every third account number is negative: the sign goes in where the text becomes a number
    signed = "(CASE WHEN CAST(replace({c}, 'TW_', '') AS BIGINT) % 3 = 0 THEN -1 ELSE 1 END * CAST(replace({c}, 'TW_', '') AS BIGINT))"
    signed_sql = dr.replace("numbered AS (", """
lowest AS (SELECT graph_id, least(min(id), 0) AS low FROM endpoints GROUP BY graph_id),
numbered AS (""").replace("         -row_number() OVER", "         (SELECT low FROM lowest l WHERE l.graph_id = by_name.graph_id) - row_number() OVER")
    for c in ("source", "target"):
        signed_sql = signed_sql.replace(f"CAST(replace({c}, 'TW_', '') AS BIGINT)", signed.replace("{c}", c))
    messages = ",\n    ".join("('" + m.replace("'", "''") + "')" for m in MESSY_MESSAGES)
    messy_sql = "WITH" + INTERACTIONS + f""",
message(raw) AS (VALUES {messages}),
field AS (SELECT raw, CASE WHEN json_valid(raw) THEN raw END AS j FROM message),
parsed AS (SELECT raw, json_extract_string(j, '$.path') AS path, json_extract_string(j, '$.platform') AS platform,
                  json_extract_string(j, '$.criteria_id') AS criteria_id, json_extract_string(j, '$.from') AS f,
                  json_extract_string(j, '$.to') AS t FROM field),
coded AS (SELECT *, CASE platform WHEN 'twitter' THEN 'TW' WHEN 'facebook' THEN 'FB' WHEN 'instagram' THEN 'IG' END
                    AS code FROM parsed),
judged AS (SELECT *, CASE WHEN coalesce(platform, '') <> '' AND code IS NULL THEN 'unknown platform'
                          WHEN criteria_id IS NULL THEN 'missing criteria_id' WHEN path IS NULL THEN 'missing path'
                          WHEN TRY_CAST(f AS BIGINT) IS NULL OR TRY_CAST(t AS BIGINT) IS NULL THEN 'bad time range'
                     END AS error FROM coded)
SELECT CASE WHEN error IS NULL THEN criteria_id || '_' || coalesce(code, 'ALL') || '_' || f || '_' || t
            ELSE 'failed_' || md5(raw) END AS graph_id, raw, error,
       CASE WHEN error IS NULL THEN (SELECT count(*) FROM interactions i WHERE i.criteria_id = r.criteria_id
         AND (r.code IS NULL OR i.platform = r.code)
         AND i.timestamp BETWEEN CAST(r.f AS BIGINT) AND CAST(r.t AS BIGINT)) ELSE 0 END AS documents
FROM judged r"""
    gexf_text = dr + """
SELECT graph_id, '' AS source, '' AS target, CAST(id AS VARCHAR) AS node FROM kept
UNION ALL SELECT graph_id, CAST(src AS VARCHAR), CAST(dst AS VARCHAR), '' FROM induced"""
    # networks with an unreadable account id fail with the first of their errors, the others are whole
    sizes = """
n AS (SELECT graph_id, count(*) AS nodes FROM kept GROUP BY graph_id),
e AS (SELECT graph_id, count(*) AS edges FROM induced GROUP BY graph_id)"""
    bad_id = " OR ".join(f"(criteria_id = '{c}' AND platform = '{p}' AND {side} LIKE 'TW\\_%' ESCAPE '\\')" for c, p, side in FAULTY)
    refused = ", ".join("('failed_{}', '{}')".format(hashlib.md5(json.dumps(r, separators=(",", ":")).encode()).hexdigest(), error)
                        for r, error in zip(BAD_REQUESTS, ("unknown platform", "bad time range")))
    isolated_sql = dr.rstrip() + "," + sizes + f""",
faults AS (SELECT graph_id, min('bad account id: TW_x' || post_id[1:8]) AS error FROM selected WHERE {bad_id} GROUP BY graph_id),
refused(graph_id, error) AS (VALUES {refused})
SELECT r.graph_id, CASE WHEN f.error IS NULL THEN 'done' ELSE 'failed' END AS status, f.error,
       CASE WHEN f.error IS NULL THEN coalesce(n.nodes, 0) ELSE 0 END AS nodes,
       CASE WHEN f.error IS NULL THEN coalesce(e.edges, 0) ELSE 0 END AS edges
FROM req r LEFT JOIN faults f ON f.graph_id = r.graph_id LEFT JOIN n ON n.graph_id = r.graph_id
LEFT JOIN e ON e.graph_id = r.graph_id
UNION ALL SELECT graph_id, 'failed', error, 0, 0 FROM refused"""
    paths_sql = ("WITH" + INTERACTIONS + "," + _requests_cte(DAY_REQUESTS) + "," + _selection("day_range") + ","
                 + PIPELINE.replace("{cap}", "15000") + "," + sizes + ",\nasked(path, i) AS (VALUES "
                 + ", ".join(f"('{p['path']}', '{p['criteria_id']}_' || '{dict(twitter='TW', facebook='FB', instagram='IG')[p['platform']]}"
                             f"_{p['from']}_{p['to']}')" for p in PATH_REQUESTS) + """)
SELECT a.path, CAST(coalesce(n.nodes, 0) AS BIGINT) AS nodes, CAST(coalesce(e.edges, 0) AS BIGINT) AS edges
FROM asked a LEFT JOIN n ON n.graph_id = a.i LEFT JOIN e ON e.graph_id = a.i""")
    binned_sql = "WITH" + INTERACTIONS + "," + _requests_cte(BINNED_REQUESTS) + "," + _selection("timestamp_range").replace(
        "JOIN req r", "JOIN (SELECT DISTINCT * FROM req) r") + """
SELECT graph_id, count(*) AS documents, min(post_id) AS first_post FROM selected GROUP BY graph_id"""
    # non-accounts end at the vertex of their name, if a non-account won it
    linked = dr
    for side, end in (("source", "src"), ("target", "dst")):
        linked = linked.replace(f"{side}id AS {end}", f"""CASE WHEN {side}id <> 0 OR {side}type = '' THEN {side}id ELSE coalesce((
    SELECT v.id FROM vertices v WHERE v.graph_id = resolved.graph_id AND v.id < 0
      AND v.name IS NOT DISTINCT FROM resolved.{side}name), 0) END AS {end}""")
    attributes = EDGE_COLS.replace("graph_id, src, dst, ", "")
    merged_sql = dr + f"""
SELECT graph_id, src, dst, {attributes}, weight FROM (
  SELECT *, CAST(count(*) OVER (PARTITION BY graph_id, src, dst) AS DOUBLE) AS weight,
         row_number() OVER (PARTITION BY graph_id, src, dst ORDER BY timestamp, post_id, typeedges, text, sourcename,
                            targetname, sourcetype, targettype) AS rn FROM induced) WHERE rn = 1"""
    out = {
        "sel_day_range": dr + f"SELECT graph_id, {DOC_COLS} FROM selected",
        "sel_day_list": _with("day_list") + f"SELECT graph_id, {DOC_COLS} FROM selected",
        "sel_timestamp_range": _with("timestamp_range") + f"SELECT graph_id, {DOC_COLS} FROM selected",
        "cells_explode": dr + f"SELECT graph_id, {DOC_COLS} FROM selected",
        "cells_day_list": _with("day_list") + f"SELECT graph_id, {DOC_COLS} FROM selected",
        "docs_sample": sample_sql,
        "resolve_endpoints": dr + "SELECT * FROM resolved",
        "endpoint_union": dr + "SELECT * FROM endpoints",
        "nodes_by_name": dr + "SELECT * FROM by_name",
        "nodes_numbered": dr + "SELECT * FROM numbered",
        "nodes_final": dr + "SELECT * FROM vertices",
        "graph_vertices_default": dr + """
SELECT graph_id, id, name, type FROM vertices
UNION ALL
SELECT DISTINCT e.graph_id, e.id, 'name' AS name, 'Missing' AS type
FROM (SELECT graph_id, src AS id FROM edges UNION ALL SELECT graph_id, dst FROM edges) e
WHERE NOT EXISTS (SELECT 1 FROM vertices v WHERE v.graph_id = e.graph_id AND v.id = e.id)""",
        "edges_valid": dr + f"SELECT {EDGE_COLS} FROM valid",
        "deg_total": dr + "SELECT graph_id, id, CAST(in_degree + out_degree AS BIGINT) AS degree FROM deg",
        "deg_in": dr + "SELECT graph_id, id, CAST(in_degree AS BIGINT) AS in_degree FROM deg WHERE in_degree > 0",
        "deg_out": dr + "SELECT graph_id, id, CAST(out_degree AS BIGINT) AS out_degree FROM deg WHERE out_degree > 0",
        "nodes_with_degree": dr + "SELECT * FROM nodes_deg",
        "name_counts": dr + """
SELECT graph_id, CAST(sum(n) AS BIGINT) AS n_vertices, count(*) AS n_names
FROM (SELECT graph_id, name, count(*) AS n FROM vertices GROUP BY graph_id, name) GROUP BY graph_id""",
        "degree_threshold": _thresholds_sql(15000),
        "degree_threshold_cap40": _thresholds_sql(SMALL_CAP),
        "nodes_capped": dr + "SELECT * FROM kept",
        "nodes_capped_cap40": c40 + "SELECT * FROM kept",
        "edges_induced": dr + f"SELECT {EDGE_COLS} FROM induced",
        "edges_induced_cap40": c40 + f"SELECT {EDGE_COLS} FROM induced",
        "nodes_edge_complete_cap40": c40 + "SELECT * FROM edge_complete",
        "max_degree_vertex": dr + """
SELECT graph_id, id, degree FROM (
  SELECT graph_id, id, degree, row_number() OVER (PARTITION BY graph_id ORDER BY degree DESC, id) AS rn
  FROM nodes_deg) WHERE rn = 1""",
        "gexf_nodes": dr + """
SELECT graph_id, CAST(id AS VARCHAR) AS id, name AS label, type AS nodes_type FROM kept""",
        "gexf_edges": dr + """
SELECT graph_id, CAST(src AS VARCHAR) AS source, CAST(dst AS VARCHAR) AS target, typeedges AS edges_kind,
       post_id, text, timestamp, sourcename AS source_name, targetname AS target_name,
       src AS source_id, dst AS target_id, 1.0::DOUBLE AS weight, 'directed' AS edge_type
FROM induced""",
        "graph_counts": _counts_sql("day_range", 15000, "induced"),
        "graph_counts_cap40": _counts_sql("day_range", SMALL_CAP, "induced"),
        "graph_counts_day_list": _counts_sql("day_list", 15000, "induced"),
        "graph_counts_timestamp_edge_complete": _counts_sql("timestamp_range", SMALL_CAP, "edge_complete"),
        "graph_counts_wide_rows": _counts_sql("day_range", 15000, "induced"),
        "requests_interactions": requests_docs,
        "requests_completed": completed,
        "requests_status": status_sql,
        "docs_filtered": "WITH" + INTERACTIONS + f"""
SELECT {DOC_COLS} FROM interactions
WHERE criteria_id = 'crit_1' AND timestamp BETWEEN {WINDOW[0]} AND {WINDOW[1]}""",
        "degree_filter_k3": dr + "SELECT * FROM nodes_deg WHERE degree >= 3",
        "gexf_sections": dr + """
SELECT graph_id, 0 AS section, CAST(1 AS BIGINT) AS lines FROM req
UNION ALL SELECT graph_id, 1, count(*) FROM kept GROUP BY graph_id
UNION ALL SELECT graph_id, 2, CAST(1 AS BIGINT) FROM req
UNION ALL SELECT graph_id, 3, count(*) FROM induced GROUP BY graph_id
UNION ALL SELECT graph_id, 4, CAST(1 AS BIGINT) FROM req""",
    }
    out.update({
        "cells_timestamp_range": out["sel_timestamp_range"], "cells_extended_json": out["cells_explode"],
        "cells_variant": out["cells_explode"],
        "sel_document_store": store_sql, "resolve_signed_ids": signed_sql + "SELECT * FROM vertices",
        "written_nodes": out["gexf_nodes"], "written_edges": out["gexf_edges"], "written_gexf": gexf_text,
        "requests_messy": messy_sql, "requests_status_isolated": isolated_sql, "written_paths": paths_sql,
        "stream_completed": completed, "sel_binned_ranges": binned_sql,
        "edges_linked": linked + f"SELECT {EDGE_COLS} FROM valid", "edges_merged": merged_sql,
    })
    return out
