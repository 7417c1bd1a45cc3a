"""The decoder on its own: known payloads, resolution rules, garbage."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pytest
from fixtures import P1, P2, V4
from hypothesis import given, settings
from hypothesis import strategies as st

from schemaflow.functions.avro_decode import OrderDecoder, check_reader
from schemaflow.functions.avro_encode import encode_batch, flat_fields
from schemaflow.operators.validate import validate
from schemaflow.schemas import ORDER_V1, ORDER_V2, ORDER_V3


def decode(payloads, reader, *writers):
    return OrderDecoder(reader, list(writers)).decode(pa.array(payloads, pa.binary())).to_pylist()


def one(payload, reader, *writers):
    return decode([payload], reader, *writers)[0]


def field(schema, name, **changes):
    """``schema`` with one field changed."""
    doc = json.loads(schema)
    doc["fields"] = [{**f, **changes} if f["name"] == name else f for f in doc["fields"]]
    return json.dumps(doc)


@pytest.mark.parametrize(
    "payload, reader, writers, discount",
    [
        (P2, ORDER_V2, [], 50),
        (P1, ORDER_V2, [], None),
        (P1, ORDER_V2, [ORDER_V1], 0),
        (P2, ORDER_V1, [], 0),
        (P2, V4, [ORDER_V1, ORDER_V2], 0),
        (P2, V4, [ORDER_V2], 50),
        (b"\x00" * 16, ORDER_V2, [], 0),
        (b"\xff" * 16, ORDER_V2, [], None),
        (b"\xfe" * 24, ORDER_V2, [], None),
        (bytes([0, 1, 2, 3]), ORDER_V2, [ORDER_V1], None),
        (bytes([1, 2, 3, 4, 5, 6]), ORDER_V2, [], None),
        (b"ccc", ORDER_V2, [], None),
        (b"not_avro_at_all", ORDER_V2, [], None),
        (b"", ORDER_V2, [ORDER_V1], None),
        (None, ORDER_V2, [ORDER_V1], None),
    ],
)
def test_known_payloads(payload, reader, writers, discount):
    row = one(payload, reader, *writers)
    assert row["valid"] is (discount is not None)
    assert row["discount_cents"] == discount


def test_values_and_failures():
    row = one(P2, ORDER_V2)
    assert (row["order_id"], row["customer_id"], row["customer_segment"]) == ("o1", "c1", "S")
    assert (row["total_cents"], row["event_millis"], row["failure"]) == (1000, 0, None)
    assert one(b"", ORDER_V2)["failure"] == "empty payload"
    assert one(P1, ORDER_V2)["failure"] == "end of input"
    assert one(b"\xff" * 16, ORDER_V2)["failure"] == "number too long"


def test_malformed_text_is_replaced():
    row = one(bytes.fromhex("04fffe0463310253d00f00"), ORDER_V1)
    assert row["valid"] and row["order_id"] == "��"


def test_rows_fall_back_one_by_one():
    rows = decode([P1, P2, b"", P1 + b"\x02", b"\x00\x01"], ORDER_V2, ORDER_V1)
    assert [r["valid"] for r in rows] == [True, True, False, True, False]
    assert [r["discount_cents"] for r in rows] == [0, 50, None, 1, None]


def test_sliced_input():
    rows = OrderDecoder(ORDER_V2, []).decode(pa.array([b"x", P2, None, P2], pa.binary()).slice(1, 3)).to_pylist()
    assert [r["valid"] for r in rows] == [True, False, True]


def test_reader_must_provide_the_columns():
    with pytest.raises(ValueError, match="total_cents"):
        check_reader(ORDER_V3)
    with pytest.raises(ValueError, match="type"):
        check_reader(field(ORDER_V2, "order_id", type={"type": "array", "items": "long"}))
    check_reader(field(ORDER_V2, "order_id", type="long"))
    check_reader(ORDER_V1)


FIXED = {"type": "fixed", "name": "F", "size": 3}
TEXTS = [
    ("long", "01", "-1"),
    ("int", "00", "0"),
    ("boolean", "01", "true"),
    ("boolean", "00", "false"),
    ("boolean", "02", "false"),
    ("double", np.float64(1e10).tobytes().hex(), "1.0E10"),
    ("double", np.float64(-0.0).tobytes().hex(), "-0.0"),
    ("double", np.float64("nan").tobytes().hex(), "NaN"),
    ("double", np.float64("-inf").tobytes().hex(), "-Infinity"),
    ("double", np.float64(1234567.25).tobytes().hex(), "1234567.25"),
    ("double", np.float64(0.0005).tobytes().hex(), "5.0E-4"),
    ("float", np.float32(0.1).tobytes().hex(), "0.1"),
    ("float", np.float32(16777216).tobytes().hex(), "1.6777216E7"),
    (FIXED, "0080ff", "[0, -128, -1]"),
    ({"type": "fixed", "name": "F", "size": 0}, "", "[]"),
    ("bytes", "06616263", "java.nio.HeapByteBuffer[pos=0 lim=3 cap=3]"),
    (["null", "long"], "0204", "2"),
    (["null", FIXED], "00", None),
]


def test_text_of_other_types(spark):
    """Each value as the customer of an order, with a payload that ends too early beside it."""
    for kind, raw, want in TEXTS:
        reader = field(ORDER_V1, "customer_id", type=kind)
        good = bytes.fromhex("046f31" + raw + "0253d00f00")
        rows = [("t", 0, 0, None, good), ("t", 0, 1, None, bytes.fromhex("046f31")), ("t", 0, 2, None, None)]
        frame = spark.createDataFrame(rows, "topic string, partition int, offset long, timestamp timestamp, value binary")
        split = validate(frame, reader)
        assert [r["customer_id"] for r in split.valid.collect()] == [want], (kind, raw)
        assert split.bad.count() == 2


def test_text_defaults_and_promotions():
    """A column that the writer lacks, and an int that the reader wants as a double."""
    lacking = json.loads(ORDER_V1)
    lacking["fields"] = [f for f in lacking["fields"] if f["name"] != "customer_id"]
    short = bytes.fromhex("046f310253d00f00")
    for kind, default, want in (("long", 5, 5), ("double", 2.5, 2.5), ("boolean", True, True), (FIXED, "a\u00ff\u0000", b"a\xff\0")):
        reader = field(ORDER_V1, "customer_id", type=kind, default=default)
        assert one(short, reader, json.dumps(lacking))["customer_id"] == want
    reader = field(ORDER_V1, "customer_id", type="double")
    assert one(bytes.fromhex("046f31060253d00f00"), reader, field(ORDER_V1, "customer_id", type="int"))["customer_id"] == 3.0


def test_int_is_promoted_to_long():
    writer = field(ORDER_V1, "total_cents", type="int")
    assert one(P1, ORDER_V1, writer)["total_cents"] == 1000
    assert not one(P1 + b"\x00", field(ORDER_V2, "total_cents", type="string"), ORDER_V1)["valid"]


def test_float_values_lose_their_fraction():
    reader = field(ORDER_V1, "total_cents", type="double")
    body = bytes.fromhex("046f310463310253") + np.float64(12.75).tobytes() + b"\x00"
    assert one(body, reader)["total_cents"] == 12


@pytest.mark.parametrize("null_first", [True, False])
def test_nullable_fields(null_first):
    kind = ["null", "string"] if null_first else ["string", "null"]
    reader = field(ORDER_V1, "customer_segment", type=kind)
    tags = {None: b"\x00", "S": b"\x02"} if null_first else {None: b"\x02", "S": b"\x00"}
    absent = bytes.fromhex("046f31046331") + tags[None] + bytes.fromhex("d00f00")
    present = bytes.fromhex("046f31046331") + tags["S"] + bytes.fromhex("0253d00f00")
    rows = decode([absent, present, absent[:6] + b"\x04", absent[:6] + b"\x01"], reader)
    assert [r["valid"] for r in rows] == [True, True, False, False]
    assert [r["customer_segment"] for r in rows[:2]] == [None, "S"]


def test_null_number_reads_as_zero():
    reader = field(ORDER_V1, "total_cents", type=["null", "long"])
    row = one(bytes.fromhex("046f31046331025300") + b"\x00", reader)
    assert row["valid"] and row["total_cents"] == 0


def test_new_nullable_field_without_default_does_not_resolve():
    doc = json.loads(ORDER_V1)
    doc["fields"].append({"name": "note", "type": ["null", "string"]})
    assert not one(P1, json.dumps(doc), ORDER_V1)["valid"]
    doc["fields"][-1]["default"] = None
    assert one(P1, json.dumps(doc), ORDER_V1)["valid"]


def test_field_of_type_null_needs_a_default():
    doc = json.loads(ORDER_V1)
    doc["fields"].append({"name": "note", "type": "null"})
    assert not one(P1, json.dumps(doc))["valid"]


def test_alias_renames_a_writer_field():
    reader = json.loads(ORDER_V1)
    writer = json.loads(ORDER_V1)
    writer["fields"][3]["name"] = "amount"
    reader["fields"][3]["aliases"] = ["amount"]
    reader["fields"].append({"name": "discount_cents", "type": "long", "default": 7})
    row = one(P1, json.dumps(reader), json.dumps(writer))
    assert (row["total_cents"], row["discount_cents"]) == (1000, 7)
    # Field aliases count only between records of the same name.
    writer["name"] = "Other"
    assert not one(P1, json.dumps(reader), json.dumps(writer))["valid"]
    reader["aliases"] = ["Other"]
    assert one(P1, json.dumps(reader), json.dumps(writer))["valid"]


def test_default_text():
    reader = json.loads(ORDER_V2)
    reader["fields"][2]["default"] = "wäre"
    writer = json.loads(ORDER_V1)
    del writer["fields"][2]
    row = one(bytes.fromhex("046f31046331d00f00"), json.dumps(reader), json.dumps(writer))
    assert (row["customer_segment"], row["discount_cents"]) == ("wäre", 0)


NESTED = [
    {"name": "kind", "type": {"type": "enum", "name": "Kind", "symbols": ["A", "B"]}},
    {"name": "mark", "type": {"type": "fixed", "name": "Mark", "size": 2}},
    {"name": "tags", "type": {"type": "array", "items": "string"}},
    {"name": "counts", "type": {"type": "map", "values": "int"}},
    {"name": "place", "type": {"type": "record", "name": "Place", "fields": [
        {"name": "lat", "type": "double"}, {"name": "ok", "type": "boolean"}, {"name": "again", "type": ["null", "Place"]},
    ]}},
    {"name": "other", "type": "Kind"},
]


def nested_payload(kind=b"\x02", tags=b"\x04\x02a\x02b\x00", other=b"\x00"):
    place = b"\x00" * 8 + b"\x01"
    counts = b"\x01\x08\x02k\x06\x00"  # one item, given as a block with its size
    return kind + b"zz" + tags + counts + place + b"\x02" + place + b"\x00" + other


def test_nested_fields_are_stepped_over():
    doc = json.loads(ORDER_V1)
    doc["fields"] = NESTED + doc["fields"]
    reader = json.dumps(doc)
    good = nested_payload() + P1
    sized = nested_payload(tags=b"\x03\x08\x02a\x02b\x00") + P1
    unknown = nested_payload(kind=b"\x04") + P1
    cut = nested_payload()[:-3]
    rows = decode([good, sized, unknown, cut, P1], reader)
    assert [r["valid"] for r in rows] == [True, True, False, False, False]
    assert {r["total_cents"] for r in rows[:2]} == {1000}


def test_huge_block_of_empty_items_ends():
    doc = json.loads(ORDER_V1)
    doc["fields"].insert(0, {"name": "voids", "type": {"type": "array", "items": "null"}})
    huge = b"\xfe\xff\xff\xff\xff\xff\xff\xff\x7f\x00" + P1
    assert one(huge, json.dumps(doc))["valid"] in (True, False)


def test_time_beyond_range_is_bad():
    text = bytes.fromhex("046f310463310253d00f")
    far = text + b"\xfe" + b"\xff" * 8 + b"\x01"
    row = one(far, ORDER_V1)
    assert (row["valid"], row["failure"]) == (False, "event time out of range")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.binary(max_size=64), st.binary(max_size=512)), max_size=20))
def test_garbage_never_raises(payloads):
    for reader, writers in ((ORDER_V2, []), (ORDER_V2, [ORDER_V1]), (V4, [ORDER_V1, ORDER_V2])):
        rows = decode(payloads, reader, *writers)
        assert len(rows) == len(payloads)
        # A row decodes the same alone as in company.
        assert rows == [one(p, reader, *writers) for p in payloads]


text = st.text(st.characters(codec="utf-8"), max_size=80)
longs = st.integers(-(2**63), 2**63 - 1)
records = st.tuples(text, text, text, longs, st.integers(-(2**52), 2**52), longs)


@settings(max_examples=200, deadline=None)
@given(st.lists(records, min_size=1, max_size=20))
def test_round_trip(rows):
    names = ["order_id", "customer_id", "customer_segment", "total_cents", "event_time", "discount_cents"]
    kinds = [pa.string()] * 3 + [pa.int64()] * 3
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    payloads = encode_batch(pa.StructArray.from_arrays(columns, names=names), flat_fields(ORDER_V2))
    got = OrderDecoder(ORDER_V2, [ORDER_V1]).decode(payloads).to_pylist()
    assert all(r["valid"] for r in got)
    back = [tuple(r[n if n != "event_time" else "event_millis"] for n in names) for r in got]
    assert back == rows


def test_encoder_matches_known_payload():
    names = ["order_id", "customer_id", "customer_segment", "total_cents", "event_time", "discount_cents"]
    columns = [pa.array(["o1", None]), pa.array(["c1"] * 2), pa.array(["S"] * 2)]
    columns += [pa.array([v] * 2, pa.int64()) for v in (1000, 0, 50)]
    rows = pa.StructArray.from_arrays(columns, names=names)
    assert encode_batch(rows, flat_fields(ORDER_V2)).to_pylist() == [P2, None]
    nullable = field(ORDER_V2, "order_id", type=["null", "string"])
    assert encode_batch(rows, flat_fields(nullable)).to_pylist() == [b"\x02" + P2, b"\x00" + P2[3:]]
