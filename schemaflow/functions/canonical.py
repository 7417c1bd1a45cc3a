"""Canonical form and fingerprint of schema texts.

Two writers with one canonical form write the same bytes for the same record: it keeps names, order, types, symbols and sizes, with
every name in full, and leaves out documentation, aliases, defaults and logical types.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from schemaflow.functions.schema_docs import PRIMITIVES, RECORDS, Invalid, full_name, qualified


def canonical_text(text: str) -> str | None:
    """The canonical form of a valid schema; None for a text that has none."""
    known: set[str] = set()

    def form(node, space: str):
        if isinstance(node, str):
            full = qualified(node, space)
            return node if node in PRIMITIVES or full not in known else full
        if isinstance(node, list):
            return [form(branch, space) for branch in node]
        kind = node["type"]
        if kind in ("array", "map"):
            part = "items" if kind == "array" else "values"
            return {"type": kind, part: form(node[part], space)}
        if kind not in (*RECORDS, "enum", "fixed"):
            return form(kind, space)
        full, space = full_name(node, space)
        known.add(full)
        if kind == "enum":
            return {"name": full, "type": kind, "symbols": node["symbols"]}
        if kind == "fixed":
            return {"name": full, "type": kind, "size": node["size"]}
        fields = [{"name": f["name"], "type": form(f["type"], space)} for f in node["fields"]]
        return {"name": full, "type": "record", "fields": fields}

    try:
        return json.dumps(form(json.loads(text), ""), separators=(",", ":"), ensure_ascii=False)
    except (Invalid, ValueError, KeyError, TypeError, RecursionError):
        return None


def _canonical(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else canonical_text(t) for t in texts.to_pylist()], pa.string())


def canonical(schema: Column) -> Column:
    """Canonical form of a schema text, null for null and for what is no schema."""
    return F.arrow_udf(_canonical, "string")(schema)


def fingerprint(form: Column) -> Column:
    """sha256 of a canonical form, in hex."""
    return F.sha2(form, 256)
