"""Avro payload encoding of flat records over whole Arrow batches, for use inside one Arrow UDF.

Sizes of all fields are computed first, then every field is written into one buffer for the batch; there is no loop over
rows. Built-in expressions can express the same bytes, but as one generated method too large for the JIT, which made
them several times slower.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

ARROW_TYPES = {
    "string": pa.string(),
    "bytes": pa.binary(),
    "int": pa.int64(),
    "long": pa.int64(),
    "boolean": pa.bool_(),
    "float": pa.float32(),
    "double": pa.float64(),
}
SPARK_TYPES = {
    "string": "string",
    "bytes": "binary",
    "int": "bigint",
    "long": "bigint",
    "boolean": "boolean",
    "float": "float",
    "double": "double",
}


def flat_fields(schema_json: str) -> list[tuple[str, str, int | None]]:
    """Name, primitive type and, for a union with null, the place of null in it."""
    fields = []
    for field in json.loads(schema_json)["fields"]:
        kind, null_at = field["type"], None
        if isinstance(kind, list) and len(kind) == 2 and "null" in kind:
            null_at = kind.index("null")
            kind = kind[1 - null_at]
        if isinstance(kind, dict):
            kind = kind["type"]
        if not isinstance(kind, str) or kind not in ARROW_TYPES:
            raise ValueError(f"cannot encode field {field['name']} of type {field['type']}")
        fields.append((field["name"], kind, null_at))
    return fields


class Varint:
    """Zig-zag numbers, one per row."""

    def __init__(self, value: np.ndarray):
        self.bits = (value.astype(np.uint64) << np.uint64(1)) ^ (value >> 63).astype(np.uint64)
        self.size = np.ones(len(value), dtype=np.int64)
        for k in range(1, 10):
            self.size += self.bits >> np.uint64(7 * k) != 0

    def write(self, out, at, rows):
        bits, size, k = self.bits[rows], self.size[rows], 0
        while len(bits):
            last = size == k + 1
            out[at + k] = (bits & np.uint64(0x7F)).astype(np.uint8) | np.where(last, 0, 0x80).astype(np.uint8)
            bits, size, at, k = (bits >> np.uint64(7))[~last], size[~last], at[~last], k + 1


class Fixed:
    """The same number of bytes for every row."""

    def __init__(self, raw: np.ndarray):
        self.raw = raw
        self.size = np.full(len(raw), raw.shape[1], dtype=np.int64)

    def write(self, out, at, rows):
        out[at[:, None] + np.arange(self.raw.shape[1])] = self.raw[rows]


class Bytes:
    """Spans of a data buffer."""

    def __init__(self, values: pa.Array):
        raw = values.cast(pa.binary())
        _, offsets, data = raw.buffers()
        bounds = np.frombuffer(offsets, dtype=np.int32)[raw.offset : raw.offset + len(raw) + 1].astype(np.int64)
        self.start, self.size = bounds[:-1], np.diff(bounds)
        self.data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)

    def write(self, out, at, rows):
        start, size = self.start[rows], self.size[rows]
        before = np.cumsum(size) - size
        steps = np.arange(size.sum())
        out[np.repeat(at - before, size) + steps] = self.data[np.repeat(start - before, size) + steps]


def _pieces(kind: str, values: pa.Array) -> list:
    if kind in ("string", "bytes"):
        span = Bytes(values.fill_null(b"" if kind == "bytes" else ""))
        return [Varint(span.size), span]
    flat = values.fill_null(False if kind == "boolean" else 0).to_numpy(zero_copy_only=False)
    if kind in ("int", "long"):
        return [Varint(flat)]
    if kind == "boolean":
        return [Fixed(flat.astype(np.uint8)[:, None])]
    return [Fixed(np.frombuffer(flat.tobytes(), dtype=np.uint8).reshape(len(flat), flat.itemsize))]


def encode_batch(rows: pa.StructArray, fields: list[tuple[str, str, int | None]]) -> pa.Array:
    """One payload per row; a null in a field that is not a union with null gives a null payload."""
    n = len(rows)
    usable = np.ones(n, dtype=bool)
    plan = []
    for name, kind, null_at in fields:
        values = rows.field(name).cast(ARROW_TYPES[kind])
        present = values.is_valid().to_numpy(zero_copy_only=False)
        if null_at is None:
            usable &= present
        else:
            branch = np.where(present, 1 - null_at, null_at).astype(np.int64)
            plan.append((Varint(branch), np.ones(n, dtype=bool)))
        plan.extend((piece, present) for piece in _pieces(kind, values))
    sizes = [np.where(present & usable, piece.size, 0) for piece, present in plan]
    bounds = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(sum(sizes, np.zeros(n, dtype=np.int64)), out=bounds[1:])
    out = np.zeros(bounds[-1], dtype=np.uint8)
    at = bounds[:-1].copy()
    for (piece, present), size in zip(plan, sizes):
        picked = np.flatnonzero(present & usable)
        piece.write(out, at[picked], picked)
        at += size
    mask = pa.py_buffer(np.packbits(usable, bitorder="little").tobytes())
    buffers = [mask, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(out)]
    return pa.Array.from_buffers(pa.binary(), n, buffers)


def encode_batches(batches: Iterator[pa.Array], schema_json: str) -> Iterator[pa.Array]:
    fields = flat_fields(schema_json)
    for rows in batches:
        yield encode_batch(rows, fields)
