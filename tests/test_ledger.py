"""Micro-batch tables and their closed days."""

from __future__ import annotations

import datetime
import os
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schemaflow import storage
from schemaflow.streaming import ledger

SCHEMA = T.StructType([T.StructField("n", T.LongType())])
DAY = datetime.date(2024, 1, 5)


def batch(spark, path, number, rows, day=DAY, query="q1"):
    frame = spark.createDataFrame([(n, day, query, number) for n in rows], "n long, dt date, query string, batch long")
    ledger.replace_batch(frame.coalesce(1), path)


def seen(spark, path, *days):
    return sorted(r["n"] for r in ledger.read_batches(spark, path, SCHEMA, *days).collect())


def files(path):
    return [f for place, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def test_closed_days_read_the_same(spark, tmp_path):
    path = str(tmp_path / "t")
    other = DAY + datetime.timedelta(1)
    for i in range(4):
        batch(spark, path, i, [10 * i, 10 * i + 1], query=f"q{i % 2}")
        batch(spark, path, i, [1000 + i], other)
    before = seen(spark, path)
    assert ledger.close_days(spark, path, SCHEMA, DAY, DAY) == [DAY]
    assert seen(spark, path) == before and seen(spark, path, DAY, DAY) == before[:8]
    assert ledger.close_days(spark, path, SCHEMA, DAY, DAY) == []
    batch(spark, path, 7, [77])
    batch(spark, path, 2, [20, 21], query="q0")  # run again after it was closed
    assert seen(spark, path) == sorted([*before, 77])
    assert ledger.close_days(spark, path, SCHEMA) == [DAY, other]
    assert seen(spark, path) == sorted([*before, 77])
    assert ledger.closed_days(spark, path)[DAY].folded == {"q0": [[0, 0], [2, 2]], "q1": [[1, 1], [3, 3], [7, 7]]}
    assert ledger.clean(spark, path, grace_seconds=3600) == 0
    assert ledger.clean(spark, path, grace_seconds=0) == 10
    assert seen(spark, path) == sorted([*before, 77]) and len(files(path)) == 2
    batch(spark, path, 8, [88])
    assert seen(spark, path, DAY, DAY) == sorted([*before[:8], 77, 88])


def test_many_batches_become_few_files_while_others_arrive(spark, tmp_path):
    path = str(tmp_path / "t")
    many = spark.range(2000).select(
        F.col("id").alias("n"), F.lit(DAY).alias("dt"), F.lit("q1").alias("query"), F.col("id").alias("batch")
    )
    ledger.replace_batch(many.repartition(8, "batch"), path)
    assert len(files(path)) == 2000
    stop, counts = threading.Event(), []

    def write():
        number = 2000
        while not stop.is_set():
            batch(spark, path, number, [number])
            number += 1
        counts.append(number)

    writer = threading.Thread(target=write)
    writer.start()
    try:
        assert ledger.close_days(spark, path, SCHEMA) == [DAY]
        rows = seen(spark, path)
        assert rows == list(range(len(rows))) and len(rows) >= 2000
    finally:
        stop.set()
        writer.join()
    assert seen(spark, path) == list(range(counts[0]))
    assert ledger.clean(spark, path, grace_seconds=0) >= 2000
    assert seen(spark, path) == list(range(counts[0]))
    folder = ledger.closed_days(spark, path)[DAY].place
    assert len(files(f"{path}/_closed/{folder}")) == 1


def test_only_one_of_two_closings_counts(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    batch(spark, path, 1, [1, 2])
    put = ledger.put_if_absent

    def slower(session, name, text):
        monkeypatch.setattr(ledger, "put_if_absent", put)
        assert ledger.close_days(spark, path, SCHEMA) == [DAY]
        return put(session, name, text)

    monkeypatch.setattr(ledger, "put_if_absent", slower)
    assert ledger.close_days(spark, path, SCHEMA) == []
    assert seen(spark, path) == [1, 2] and len(files(f"{path}/_closed")) == 1


def test_rows_without_a_day_stay_open(spark, tmp_path):
    path = str(tmp_path / "t")
    batch(spark, path, 1, [1], None)
    assert ledger.close_days(spark, path, SCHEMA) == [] and seen(spark, path) == [1]


def test_create_if_absent(spark, tmp_path):
    path = str(tmp_path / "deep" / "er" / "x.json")
    assert storage.put_if_absent(spark, path, "erst é") and not storage.put_if_absent(spark, path, "second")
    assert open(path, encoding="utf-8").read() == "erst é"
    assert [n for n, _ in storage.listed(spark, os.path.dirname(path))] == ["x.json"]
    assert storage.listed(spark, str(tmp_path / "absent")) == []
    won = []
    racers = [
        threading.Thread(target=lambda i=i: won.append(storage.put_if_absent(spark, f"{path}.2", str(i)))) for i in range(8)
    ]
    for r in racers:
        r.start()
    for r in racers:
        r.join()
    assert sorted(won) == [False] * 7 + [True]
