"""The compatibility rules on two schema texts, in plain Python, to compare the plan with."""

from __future__ import annotations

import json

SAFE = {
    ("INT", "LONG"), ("INT", "FLOAT"), ("INT", "DOUBLE"), ("LONG", "FLOAT"), ("LONG", "DOUBLE"), ("FLOAT", "DOUBLE"),
    ("STRING", "BYTES"), ("BYTES", "STRING"),
}


def _tag(kind):
    if isinstance(kind, dict):
        return _tag(kind["type"])
    if isinstance(kind, list):
        solid = [b for b in kind if _tag(b) != "NULL"]
        return _tag(solid[0]) if len(solid) == 1 else "UNION"
    return kind.upper()


def _nullable(f):
    return isinstance(f["type"], list) and any(_tag(b) == "NULL" for b in f["type"])


def _full(doc, name):
    return name if "." in name or not doc.get("namespace") else f"{doc['namespace']}.{name}"


def _names(fields):
    return [f["name"] for f in fields]


def _listed(fields):
    return {a for f in fields for a in f.get("aliases", [])}


def one_way(writer, reader):
    out = []
    w_full, r_full = _full(writer, writer["name"]), _full(reader, reader["name"])
    if w_full != r_full and w_full not in [_full(reader, a) for a in reader.get("aliases", [])]:
        out.append(("RecordNameMismatch", "<root>", w_full, r_full))
    ws, rs = writer["fields"], reader["fields"]
    for r in rs:
        hits = [w for w in ws if w["name"] == r["name"]] or [w for w in ws if w["name"] in r.get("aliases", [])]
        if not hits:
            if "default" not in r and not _nullable(r):
                out.append(("MissingDefault", r["name"], None, None))
            continue
        a, b = _tag(hits[0]["type"]), _tag(r["type"])
        if a != b and (a, b) not in SAFE:
            out.append(("TypeIncompatible", r["name"], a, b))
        if not _nullable(hits[0]) and _nullable(r) and "default" not in r:
            out.append(("NonNullableMadeNullable", r["name"], None, None))
    r_only = [r for r in rs if r["name"] not in _names(ws) and not set(r.get("aliases", [])) & set(_names(ws))]
    for w in ws:
        if w["name"] in _names(rs) or w["name"] in _listed(rs):
            continue
        heir = next((r for r in r_only if _tag(r["type"]) == _tag(w["type"])), None)
        if heir:
            out.append(("RenamedWithoutAlias", w["name"], w["name"], heir["name"]))
    return out


def removed(old, new):
    added = {_tag(f["type"]) for f in new["fields"] if f["name"] not in _names(old["fields"])}
    gone = [f for f in old["fields"] if f["name"] not in _names(new["fields"]) and f["name"] not in _listed(new["fields"])]
    return [
        ("RemovedRequiredField", f["name"], None, None)
        for f in gone
        if "default" not in f and _tag(f["type"]) not in added
    ]


def expanded(doc):
    """The record with every reference to a named type replaced by its kind."""
    known = {}

    def walk(node, space):
        if isinstance(node, list):
            return [walk(n, space) for n in node]
        if isinstance(node, str):
            full = node if "." in node or not space else f"{space}.{node}"
            return {"type": known[full]} if full in known else node
        if isinstance(node.get("type"), str) and node["type"] in ("record", "enum", "fixed"):
            own = node.get("namespace", space)
            full = node["name"] if "." in node["name"] or not own else f"{own}.{node['name']}"
            known[full] = node["type"]
            inner = full.rpartition(".")[0]
            return {**node, "fields": [{**f, "type": walk(f["type"], inner)} for f in node.get("fields", [])]}
        return {**node, "type": walk(node["type"], space)}

    return walk(doc, "") if isinstance(doc, dict) else doc


def check(old_text, new_text, level):
    old, new = expanded(json.loads(old_text)), expanded(json.loads(new_text))
    if level == "none" or not all(isinstance(d, dict) and d["type"] == "record" for d in (old, new)):
        return []
    out = one_way(old, new) if level in ("backward", "full") else []
    out += one_way(new, old) if level in ("forward", "full") else []
    out += removed(old, new) if level in ("backward", "full") else []
    return list(dict.fromkeys(out))
