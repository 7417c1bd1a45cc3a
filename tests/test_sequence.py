"""Ordered candidates, published versions, layouts."""

from __future__ import annotations

import json
import os
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from rules_oracle import check as plain_check

from schemaflow.functions.canonical import canonical_text
from schemaflow.operators import compat
from schemaflow.operators import registration as reg
from schemaflow.schemas import ORDER_V1, ORDER_V2, ORDER_V3
from schemaflow.sources.registry import read_registry

SHAPE = "subject string, version int, schema string"
OFFERED = "subject string, ord int, schema string"
NOTHING = "subject string, version int, schema string"


def record(*fields):
    return json.dumps({"type": "record", "name": "x.R", "fields": [{"name": n, "type": t, **more} for n, t, more in fields]})


def drawn(r):
    names = r.sample(["a", "b", "c"], r.randint(1, 3))
    return record(*((n, r.choice(["int", "long", "string"]), r.choice([{}, {"default": 0}])) for n in names if n != "c" or True))


def valid(text):
    return all(f["type"] != "string" or "default" not in f for f in json.loads(text)["fields"])


def plain_sequence(known, offered, level):
    """One candidate at a time, as a registry does it."""
    out = []
    for subject, ord_, text in offered:
        mine = known.setdefault(subject, [])
        broken = not valid(text)
        found = [] if broken or not mine else plain_check(mine[-1], text, level)
        if broken or found:
            out.append((subject, ord_, False, None))
        else:
            mine.append(text)
            out.append((subject, ord_, True, len(mine)))
    return sorted(out)


def decided(frame):
    return sorted((r["subject"], r["ord"], r["accepted"], r["version"]) for r in frame.collect())


@pytest.mark.parametrize("level,block", [("backward", 256), ("full", 3), ("none", 1)])
def test_each_against_the_last_accepted(spark, monkeypatch, level, block):
    monkeypatch.setattr(reg, "SEQUENCE_BLOCK", block)
    r = random.Random(level)
    known = {f"s{i}": [t for t in (drawn(r) for _ in range(4)) if valid(t)][:2] for i in range(5)}
    rows = [(s, v + 1, t) for s, texts in known.items() for v, t in enumerate(texts)]
    offered = [(f"s{i % 8}", i, drawn(r)) for i in range(60)]
    registry = spark.createDataFrame(rows, SHAPE)
    got = reg.register_sequence(registry, spark.createDataFrame(r.sample(offered, 60), OFFERED), level)
    want = plain_sequence({s: list(t) for s, t in known.items()}, offered, level)
    assert decided(got) == want
    assert {w[2] for w in want} == ({True} if level == "none" and all(valid(t) for *_, t in offered) else {True, False})


def test_sequence_edges(spark):
    nothing = spark.createDataFrame([], NOTHING)
    assert reg.register_sequence(nothing, spark.createDataFrame([], OFFERED)).collect() == []
    rows = [("a", None, ORDER_V1), ("a", 1, None), ("a", 2, "no schema"), ("a", 3, ORDER_V1), ("a", 3, ORDER_V1), ("b", 1, ORDER_V3)]
    got = reg.register_sequence(nothing, spark.createDataFrame(rows, OFFERED).withColumn("doc", F.lit(1)))
    assert sorted((r["subject"], r["ord"] or 0, r["version"] or 0) for r in got.collect()) == [
        ("a", 0, 1), ("a", 1, 0), ("a", 2, 0), ("a", 3, 2), ("a", 3, 3), ("b", 1, 1)
    ]
    reports = {(r["subject"], r["ord"]): r["report"] for r in got.collect()}
    assert reports["a", 1] == "- **InvalidSchema** (<root>): there is no schema text"
    assert reports["a", 2] == "- **InvalidSchema** (<root>): the text is not JSON"


def published(root):
    return {f"{s}/{v}": json.loads(open(f"{root}/{s}/{v}").read()) for s in os.listdir(root) for v in os.listdir(f"{root}/{s}")}


def test_publish_in_turn(spark, tmp_path):
    root = str(tmp_path / "registry")
    rows = [("orders", 1, ORDER_V1), ("orders", 2, ORDER_V2), ("orders", 3, ORDER_V3), ("sp ace+%", 1, ORDER_V3)]
    got = reg.publish(spark, root, spark.createDataFrame(rows, OFFERED))
    assert decided(got) == [("orders", 1, True, 1), ("orders", 2, True, 2), ("orders", 3, False, None), ("sp ace+%", 1, True, 1)]
    assert published(root) == {
        "orders/v1.avsc": json.loads(ORDER_V1), "orders/v2.avsc": json.loads(ORDER_V2), "sp ace+%/v1.avsc": json.loads(ORDER_V3)
    }
    back = read_registry(spark, root)
    assert sorted((r["subject"], r["version"]) for r in back.collect()) == [("orders", 1), ("orders", 2), ("sp ace+%", 1)]
    for name in ("a/b", ".a", "_a", "", None):
        with pytest.raises(Exception, match="no directory name"):
            reg.publish(spark, root, spark.createDataFrame([(name, 1, ORDER_V1)], OFFERED))


NARROW = record(("a", "long", {}))
WIDER = record(("a", "long", {}), ("b", "int", {"default": 0}))
OTHER = record(("a", "long", {}), ("c", "string", {}))


@pytest.mark.parametrize("mine,expected", [([WIDER], [(1, True, 3)]), ([OTHER], [(1, False, None)]), ([WIDER, NARROW, OTHER], [(1, True, 3), (2, True, 4), (3, False, None)])])
def test_the_slower_writer_is_checked_against_the_faster(spark, tmp_path, monkeypatch, mine, expected):
    """Another writer takes version 2 between this one's decision and its first file."""
    root = str(tmp_path / "registry")
    reg.publish(spark, root, spark.createDataFrame([("s", 1, record(("a", "int", {})))], OFFERED))
    put = reg.put_if_absent

    def late(session, path, text):
        monkeypatch.setattr(reg, "put_if_absent", put)
        reg.publish(spark, root, spark.createDataFrame([("s", 1, NARROW)], OFFERED))
        return put(session, path, text)

    monkeypatch.setattr(reg, "put_if_absent", late)
    offered = spark.createDataFrame([("s", i + 1, t) for i, t in enumerate(mine)] + [("t", 1, NARROW)], OFFERED)
    got = reg.publish(spark, root, offered)
    assert decided(got) == sorted([("s", *e) for e in expected] + [("t", 1, True, 1)])
    assert published(root)["s/v2.avsc"] == json.loads(NARROW)
    assert len(published(root)) == 3 + sum(e[1] for e in expected)


def test_a_gap_raises(spark, tmp_path):
    root = tmp_path / "registry" / "s"
    root.mkdir(parents=True)
    for n in (1, 3):
        (root / f"v{n}.avsc").write_text(NARROW)
    with pytest.raises(ValueError, match="already in use"):
        reg.publish(spark, str(tmp_path / "registry"), spark.createDataFrame([("s", 1, NARROW)], OFFERED))


def test_layouts_stand_for_all_their_versions(spark):
    """Ten thousand versions of three layouts give three candidates, in the order of their first versions."""
    texts = F.array(*(F.lit(t) for t in (ORDER_V2, ORDER_V1, ORDER_V3)))
    version = (F.col("id") + 1).cast("int")
    noted = F.concat(F.lit('{"doc":"version '), version.cast("string"), F.lit('",'), F.substring(F.element_at(texts, (F.col("id") % 3 + 1).cast("int")), 2, 10_000))
    registry = spark.range(10_000).select(F.lit("orders").alias("subject"), version.alias("version"), noted.alias("schema"))
    reader, writers = reg.reader_and_writers(registry, "orders")
    fields = [[f["name"] for f in json.loads(t)["fields"]] for t in (reader, *writers)]
    assert json.loads(reader)["doc"] == "version 10000"
    assert fields == [[f["name"] for f in json.loads(t)["fields"]] for t in (ORDER_V2, ORDER_V1, ORDER_V3)]
    newest = reg.reader_and_writers(registry.filter("version <> 9998"), "orders", newest=True)[1]
    assert [json.loads(w)["doc"] for w in newest] == ["version 9998", "version 9999"] or len(newest) == 2


def test_canonical_form():
    text = json.dumps({
        "namespace": "n.s", "doc": "x", "name": "R", "type": "record", "aliases": ["Q"], "fields": [
            {"doc": "y", "type": {"type": "enum", "symbols": ["A"], "name": "E"}, "name": "e", "default": "A"},
            {"name": "f", "type": ["null", {"type": "fixed", "size": 2, "name": "o.F"}, "E", "o.F"]},
            {"name": "g", "type": {"type": {"type": "long", "logicalType": "timestamp-millis"}}},
            {"name": "h", "type": {"type": "array", "items": {"type": "map", "values": "R"}}},
        ]})
    assert json.loads(canonical_text(text)) == {
        "name": "n.s.R", "type": "record", "fields": [
            {"name": "e", "type": {"name": "n.s.E", "type": "enum", "symbols": ["A"]}},
            {"name": "f", "type": ["null", {"name": "o.F", "type": "fixed", "size": 2}, "n.s.E", "o.F"]},
            {"name": "g", "type": "long"},
            {"name": "h", "type": {"type": "array", "items": {"type": "map", "values": "n.s.R"}}},
        ]}
    assert canonical_text('"int"') == '"int"' and canonical_text("{") is None and canonical_text("{}") is None


def test_a_file_registry_is_parsed_once(spark, tmp_path):
    root = str(tmp_path / "registry")
    reg.publish(spark, root, spark.createDataFrame([("orders", 1, ORDER_V1), ("orders", 2, ORDER_V2)], OFFERED))
    checked = compat.check_consecutive(read_registry(spark, root))
    assert [r["violations"] for r in checked.collect()] == [[]]
    # One reader; the second use is of its exchange.
    assert plan_of(checked).split("== Initial Plan ==")[0].count("ArrowEvalPython") == 1


def test_no_join_brings_the_candidates_back(spark):
    """Decisions carry their candidates: stored texts compress so well that a join would broadcast them whole."""
    rows = [(f"s{i % 4}", i, ORDER_V1) for i in range(40)]
    got = reg.register_sequence(spark.createDataFrame([], NOTHING), spark.createDataFrame(rows, OFFERED))
    assert "Join" not in plan_of(got) and "Broadcast" not in plan_of(got)
    assert sorted((r["subject"], r["ord"], r["schema"]) for r in got.collect()) == sorted(rows)


def test_latest_versions_are_not_broadcast(spark):
    known = spark.createDataFrame([("a", 1, ORDER_V1)], SHAPE)
    plan = plan_of(reg.register(known, spark.createDataFrame([("a", ORDER_V2)], "subject string, schema string")))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
