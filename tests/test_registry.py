from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from schemaflow.operators import registration as reg
from schemaflow.schemas import ORDER_V1, ORDER_V2, ORDER_V3
from schemaflow.sources.registry import read_registry, store_registry

SHAPE = "subject string, version int, schema string"


def put(root, subject, name, text):
    (root / subject).mkdir(parents=True, exist_ok=True)
    (root / subject / name).write_text(text)


def listed(df):
    return sorted((r["subject"], r["version"]) for r in df.collect())


def test_scan_of_hand_kept_files(spark, tmp_path):
    for n, text in ((1, ORDER_V1), (2, ORDER_V2), (10, ORDER_V3)):
        put(tmp_path, "orders", f"v{n}.avsc", json.dumps(json.loads(text), indent=2))
    put(tmp_path, "orders", "notes.txt", "no schema")
    put(tmp_path / "orders", "deeper", "v1.avsc", "{")
    put(tmp_path, ".", "v1.avsc", "{")
    put(tmp_path, "orders", "vx.avsc", "{")
    put(tmp_path, "orders", "v99999999999.avsc", "{")
    put(tmp_path, "empty one", "draft.avsc", "{")
    put(tmp_path, "sp ace+%", "v1.avsc", ORDER_V1)
    frame = read_registry(spark, str(tmp_path))
    assert listed(frame) == [("orders", 1), ("orders", 2), ("orders", 10), ("sp ace+%", 1)]
    assert [r["version"] for r in reg.versions(frame, "orders").collect()] == [1, 2, 10]
    reader, writers = reg.reader_and_writers(frame, "orders")
    assert json.loads(reader) == json.loads(ORDER_V3)
    assert [json.loads(w) for w in writers] == [json.loads(ORDER_V1), json.loads(ORDER_V2)]
    newest = {r["subject"]: (r["version"], r["versions"]) for r in reg.latest(frame).collect()}
    assert newest == {"orders": (10, 3), "sp ace+%": (1, 1)}
    assert {r["subject"] for r in reg.subjects(frame).collect()} == {"orders", "sp ace+%"}


def test_unknown_subject_and_missing_root(spark, tmp_path):
    put(tmp_path, "orders", "v1.avsc", ORDER_V1)
    frame = read_registry(spark, str(tmp_path))
    assert reg.versions(frame, "other").count() == 0
    with pytest.raises(ValueError, match="no schemas registered for subject other"):
        reg.reader_and_writers(frame, "other")
    with pytest.raises(ValueError, match="not a directory"):
        read_registry(spark, str(tmp_path / "absent"))
    with pytest.raises(ValueError, match="not a directory"):
        read_registry(spark, str(tmp_path / "orders" / "v1.avsc"))


def test_stored_registry_reads_back(spark, tmp_path):
    root = str(tmp_path / "registry")
    rows = [("orders", 1, ORDER_V1), ("a/b c+%", 7, ORDER_V2)]
    store_registry(spark.createDataFrame(rows, SHAPE), root)
    back = read_registry(spark, root)
    assert listed(back) == [("a/b c+%", 7), ("orders", 1)]
    assert {json.loads(r["schema"])["name"] for r in back.collect()} == {"Order"}


def test_register_and_store(spark, tmp_path):
    root = str(tmp_path / "registry")
    nothing = spark.createDataFrame([], SHAPE)

    def offer(known, **schemas):
        return reg.register(known, spark.createDataFrame(list(schemas.items()), "subject string, schema string"))

    first = offer(nothing, orders=ORDER_V1)
    assert [(r["accepted"], r["version"], r["report"]) for r in first.collect()] == [(True, 1, "compatible")]
    reg.store_accepted(first, root)
    bad = json.dumps({**json.loads(ORDER_V1), "fields": [{"name": "order_id", "type": "long"}]})
    second = offer(read_registry(spark, root), orders=bad, users=ORDER_V2)
    rows = {r["subject"]: r for r in second.collect()}
    assert (rows["orders"]["accepted"], rows["orders"]["version"]) == (False, None)
    assert rows["orders"]["violations"][0]["kind"] == "TypeIncompatible"
    assert (rows["users"]["accepted"], rows["users"]["version"]) == (True, 1)
    reg.store_accepted(second, root)
    third = offer(read_registry(spark, root), orders=ORDER_V2)
    reg.store_accepted(third, root)
    assert listed(read_registry(spark, root)) == [("orders", 1), ("orders", 2), ("users", 1)]
    # Only the latest version counts.
    assert [r["accepted"] for r in offer(read_registry(spark, root), orders=ORDER_V3).collect()] == [False]


def test_invalid_candidates_are_refused_with_a_report(spark):
    known = spark.createDataFrame([("old", 1, ORDER_V1)], SHAPE)
    texts = ["hello, not a schema", json.dumps({"type": "record", "name": "R"}), ORDER_V1.replace('"string"', '"strnig"'), None]
    rows = [(f"{age}", t) for t in texts for age in ("old", "new")]
    for subject, text in rows:
        candidate = spark.createDataFrame([(subject, text)], "subject string, schema string")
        row = reg.register(known, candidate, "backward").first()
        assert (row["accepted"], row["version"]) == (False, None)
        assert [v["kind"] for v in row["violations"]] == ["InvalidSchema"] and "InvalidSchema" in row["report"]


def test_an_invalid_text_fails_the_scan(spark, tmp_path):
    put(tmp_path, "orders", "v1.avsc", ORDER_V1)
    put(tmp_path, "orders", "v2.avsc", "hello, not a schema")
    with pytest.raises(Exception, match="malformed schema of orders version 2"):
        read_registry(spark, str(tmp_path)).collect()
    with pytest.raises(Exception, match="malformed schema"):
        reg.check_files(spark, str(tmp_path / "orders/v1.avsc"), str(tmp_path / "orders/v2.avsc")).collect()


def test_two_candidates_for_one_subject_raise(spark):
    rows = [("orders", ORDER_V1), ("orders", ORDER_V2)]
    candidates = spark.createDataFrame(rows, "subject string, schema string")
    with pytest.raises(Exception, match="more than one candidate for subject orders"):
        reg.register(spark.createDataFrame([], SHAPE), candidates).collect()


def test_gap_in_numbers_is_not_overwritten(spark, tmp_path):
    known = spark.createDataFrame([("orders", 3, ORDER_V1)], SHAPE)
    decided = reg.register(known, spark.createDataFrame([("orders", ORDER_V2)], "subject string, schema string"))
    assert decided.first()["version"] == 2
    with pytest.raises(Exception, match="already in use"):
        reg.store_accepted(decided, str(tmp_path / "registry"))


def test_check_of_two_files(spark, tmp_path):
    for n, text in ((1, ORDER_V1), (2, ORDER_V2), (3, ORDER_V3)):
        put(tmp_path, "orders", f"v{n}.avsc", text)
    path = [str(tmp_path / "orders" / f"v{n}.avsc") for n in (1, 2, 3)]
    assert reg.check_files(spark, path[0], path[1]).first().asDict() == {
        "compatible": True,
        "report": "compatible",
        "status": 0,
    }
    assert reg.check_files(spark, path[1], path[2], "FULL").first()["status"] == 1
    assert reg.check_files(spark, path[1], path[2], "none").first()["status"] == 0
    with pytest.raises(ValueError, match="unknown compatibility level"):
        reg.check_files(spark, path[0], path[1], "upward")


def test_latest_takes_the_greatest_number(spark):
    frame = spark.range(20).select(
        F.lit("s").alias("subject"), F.col("id").cast("int").alias("version"), F.col("id").cast("string").alias("schema")
    )
    assert reg.latest(frame).first()["schema"] == "19"


def test_storing_is_dealt_over_the_cores(spark, tmp_path):
    """Versions that one task holds are written by several, each still in a file of its own."""
    root = str(tmp_path / "many")
    rows = [(f"s{i % 3}", i, ORDER_V1) for i in range(60)]
    store_registry(spark.createDataFrame(rows, SHAPE).coalesce(1), root)
    parts = [p.name for p in (tmp_path / "many").rglob("part-*")]
    assert len(parts) == 60
    assert len({name[: len("part-00000")] for name in parts}) > 1
    assert listed(read_registry(spark, root)) == sorted((f"s{i % 3}", i) for i in range(60))
