"""A plain-Python model of one network build, for brute-force checks on small inputs.

It follows the reference's steps literally, including the degree loop
``for i in 0..n: if count(deg >= i) <= cap: keep deg >= i``, so it checks the
one-pass histogram of the Spark plan independently.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from datetime import datetime, timezone

CODES = {"twitter": "TW", "facebook": "FB", "instagram": "IG"}


def day_of(ms: int) -> str:
    return datetime.fromtimestamp(ms / 1000, tz=timezone.utc).strftime("%Y%m%d")


def graph_id(req, code):
    return "_".join([req["criteria_id"], code or "ALL", req["from"], req["to"]])


def select(docs, req, selection, require_target):
    lo, hi = int(req["from"]), int(req["to"])
    code = CODES.get(req.get("platform") or "")
    out = []
    for d in docs:
        if d["criteria_id"] != req["criteria_id"]:
            continue
        if require_target and d.get("target") is None:
            continue
        if selection == "day_range":
            ok = d["platform"] == code and day_of(lo) <= d["day"] < day_of(hi)
        elif selection == "day_list":
            ok = d["platform"] == code and day_of(lo) <= d["day"] <= day_of(hi)
        else:
            ok = (code is None or d["platform"] == code) and lo <= d["timestamp"] <= hi
        if ok:
            out.append(d)
    return out


def resolve(d, side, account_type="TW_Account", prefix="TW_"):
    key = d.get(side)
    if key is None:
        return 0, "", ""
    typ = d.get(f"{side}_type")
    if typ == account_type:
        return int(key.replace(prefix, "")), d.get(f"{side}_name"), typ
    return 0, d.get(f"{side}_name"), typ or ""


def _key_nulls_first(v):
    return (v is not None, v if v is not None else "")


def build(docs, req, selection="day_range", cap=15000, cap_mode="induced", require_target=True,
          account_type="TW_Account", prefix="TW_"):
    """-> (graph_id, nodes {id: (name, type)}, edges [(src, dst, attrs...)])"""
    code = CODES.get(req.get("platform") or "")
    gid = graph_id(req, code)
    rows = []
    for d in select(docs, req, selection, require_target):
        sid, sname, stype = resolve(d, "source", account_type, prefix)
        tid, tname, ttype = resolve(d, "target", account_type, prefix)
        rows.append((sid, tid, sname, tname, stype, ttype, d["type"], d["text"], d["timestamp"], d["post_id"]))
    # D1 + D2: one endpoint per name; account first, lowest id, lowest type
    best = {}
    for r in rows:
        for ident, name, typ in ((r[0], r[2], r[4]), (r[1], r[3], r[5])):
            if typ == "":
                continue
            cand = (ident == 0, ident, typ)
            if name not in best or cand < best[name]:
                best[name] = cand
    # D3 + D4: surrogates for non-accounts, numbered by (md5(name), name)
    non = sorted((n for n, c in best.items() if c[1] == 0),
                 key=lambda n: (hashlib.md5((n or "").encode()).hexdigest(), _key_nulls_first(n)))
    numbered = [(-(i + 1), n, best[n][2]) for i, n in enumerate(non)]
    numbered += [(c[1], n, c[2]) for n, c in best.items() if c[1] != 0]
    # One vertex per id, lowest name
    verts = {}
    for ident, name, typ in numbered:
        if ident not in verts or _key_nulls_first(name) < _key_nulls_first(verts[ident][0]):
            verts[ident] = (name, typ)
    # Valid edges
    edges = [(r[0], r[1], r[6], r[7], r[2], r[3], r[8], r[9], r[4], r[5]) for r in rows]
    valid = [e for e in edges if e[0] in verts and e[1] in verts]
    deg = defaultdict(int)
    for e in valid:
        deg[e[0]] += 1
        deg[e[1]] += 1
    # The literal loop
    n = len(verts)
    if n > cap:
        k = None  # the reference may find none (C10); the loop here runs to max degree + 1
        for i in range(0, max(deg.values(), default=0) + 2):
            if sum(1 for v in verts if deg[v] >= i) <= cap:
                k = i
                break
    else:
        k = 1
    kept = {v: verts[v] for v in verts if deg[v] >= k}
    if cap_mode == "induced":
        out_edges = [e for e in valid if e[0] in kept and e[1] in kept]
        return gid, kept, out_edges, k
    nodes = dict(kept)
    extra = defaultdict(list)
    for e in valid:
        extra[e[1]].append((e[5], e[9]))
        extra[e[0]].append((e[4], e[8]))
    for ident, labels in extra.items():
        if ident not in nodes:
            nodes[ident] = min(labels, key=lambda t: (_key_nulls_first(t[0]), t[1]))
    return gid, nodes, valid, k
