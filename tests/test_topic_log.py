from __future__ import annotations

import json
import os
import threading

import pytest
from fixtures import P2, payload_rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from schemaflow.sources import topic_log
from schemaflow.sources.topic_log import append_topic, expire, read_stored_topic, stream_stored_topic
from schemaflow.sources.topics import read_envelopes


def numbered(spark, first, last, partition=0, topic="orders"):
    """Envelopes with offsets from ``first`` to before ``last``."""
    rows = payload_rows(spark, [P2]).drop("offset", "partition", "topic")
    ids = spark.range(first, last).select(
        F.lit(topic).alias("topic"), F.lit(partition).alias("partition"), F.col("id").alias("offset")
    )
    return ids.crossJoin(rows)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "log")


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """The same as ``filled``, for tests that only read."""
    return fill(spark, str(tmp_path_factory.mktemp("topic") / "log"))


@pytest.fixture
def filled(spark, root):
    return fill(spark, root)


def fill(spark, root):
    """Two appends to each of two partitions, and another topic."""
    for first, last in ((0, 10), (10, 25)):
        two = numbered(spark, first, last).unionByName(numbered(spark, first, last, 1))
        append_topic(two.unionByName(numbered(spark, first, last, 0, "other")), root)
    return root


def spec(offsets):
    return offsets if isinstance(offsets, str) else json.dumps({"orders": offsets})


def offsets_of(frame):
    return sorted((r["partition"], r["offset"]) for r in frame.select("partition", "offset").collect())


@pytest.mark.parametrize(
    "starting, ending",
    [
        ("earliest", "latest"),
        ("latest", "latest"),
        ("earliest", "earliest"),
        ({"0": 2, "1": -2}, "latest"),
        ({"0": 2}, "latest"),
        ("earliest", {"0": 3, "1": -1}),
        ({"0": 9, "1": 5}, {"0": 12, "1": 5}),
        ({"0": -1}, "latest"),
    ],
)
@pytest.mark.parametrize("range_rows", [4, 1000])
def test_same_rows_as_a_filter(spark, kept, starting, ending, range_rows):
    both = numbered(spark, 0, 25).unionByName(numbered(spark, 0, 25, 1))
    wanted = offsets_of(read_envelopes(both, "orders", spec(starting), spec(ending)))
    got = read_stored_topic(spark, kept, "orders", spec(starting), spec(ending), True, range_rows)
    assert offsets_of(got) == wanted


def test_rows_come_back_whole(spark, kept):
    got = read_stored_topic(spark, kept, "orders", spec({"0": 3}), spec({"0": 5}))
    wanted = numbered(spark, 3, 5).select(got.columns)
    assert got.schema.simpleString() == wanted.schema.simpleString()
    assert got.exceptAll(wanted).count() == 0 and got.count() == 2


def test_one_task_for_each_range(spark, kept):
    def tasks(starting, ending, rows):
        return read_stored_topic(spark, kept, "orders", spec(starting), spec(ending), range_rows=rows).rdd.getNumPartitions()

    assert tasks({"0": 12}, {"0": 20}, 1000) == 1
    assert tasks({"0": 0}, {"0": 25}, 1000) == 2
    assert tasks({"0": 0}, {"0": 25}, 5) == 5
    assert tasks("earliest", "latest", 1000) == 4


def test_ranges_name_only_their_folders(kept):
    log = topic_log.TopicLog(kept, "orders", 1000, True)
    held = log.held()
    planned = log.ranges({"0": 11}, {"0": 13}, held)
    assert [(t.partition, t.piece) for t in planned] == [(0, topic_log.Piece(held["0"].pieces[1].folder, 11, 13))]


def test_nothing_stored(spark, root):
    assert read_stored_topic(spark, root, "orders").count() == 0
    assert append_topic(numbered(spark, 0, 0), root) is None
    append_topic(numbered(spark, 0, 3), root)
    assert read_stored_topic(spark, root, "unknown").count() == 0


def test_offsets_only_grow(spark, filled):
    before = os.listdir(f"{filled}/appends")
    with pytest.raises(ValueError, match="before the end 25"):
        append_topic(numbered(spark, 24, 30), filled)
    with pytest.raises(ValueError, match="no topic"):
        append_topic(numbered(spark, 30, 33).withColumn("topic", F.lit(None).cast("string")), filled)
    with pytest.raises(ValueError, match="topic names"):
        append_topic(numbered(spark, 30, 33, 0, "a:b"), filled)
    with pytest.raises(ValueError, match="no topic"):
        append_topic(numbered(spark, 30, 33).withColumn("offset", F.lit(None).cast("long")), filled)
    assert sorted(os.listdir(f"{filled}/appends")) == sorted(before)
    assert append_topic(numbered(spark, 40, 42), filled) == 2
    got = read_stored_topic(spark, filled, "orders", spec({"0": 24}), "latest", True)
    assert offsets_of(got) == [(0, 24), (0, 40), (0, 41)]


def test_rows_without_an_entry_are_not_seen(spark, filled):
    """What a writer left that died before its entry."""
    numbered(spark, 25, 30).write.partitionBy("topic", "partition").parquet(f"{filled}/appends/left")
    assert read_stored_topic(spark, filled, "orders").count() == 50


def test_two_writers_at_once(spark, root):
    """Both take their turn if their offsets allow it; with the same offsets one of them is refused."""
    refused = []

    def write(first, partition):
        try:
            append_topic(numbered(spark, first, first + 5, partition), root)
        except ValueError:
            refused.append(partition)

    for turns, lost in (([(0, 0), (0, 1), (0, 2)], 0), ([(5, 0), (5, 0)], 1)):
        writers = [threading.Thread(target=write, args=turn) for turn in turns]
        for writer in writers:
            writer.start()
        for writer in writers:
            writer.join()
        assert len(refused) == lost
    assert offsets_of(read_stored_topic(spark, root, "orders")) == [(0, i) for i in range(10)] + [
        (p, i) for p in (1, 2) for i in range(5)
    ]


def test_expired_offsets(spark, filled):
    expire(spark, filled, 1)
    assert offsets_of(read_stored_topic(spark, filled, "orders", spec({"0": 4}), "latest")) == [(0, i) for i in range(10, 25)]
    assert read_stored_topic(spark, filled, "orders", fail_on_loss=True).count() == 30
    for starting, ending in (({"0": 4}, "latest"), ("earliest", {"0": 26}), ({"1": 30}, "latest")):
        with pytest.raises(Exception, match="asked for"):
            read_stored_topic(spark, filled, "orders", spec(starting), spec(ending), True).count()
    expire(spark, filled, 99)
    assert read_stored_topic(spark, filled, "orders").count() == 30


def test_an_expired_partition_keeps_its_place(spark, filled):
    append_topic(numbered(spark, 25, 30), filled)
    expire(spark, filled, 99)
    assert offsets_of(read_stored_topic(spark, filled, "orders", fail_on_loss=True)) == [(0, i) for i in range(25, 30)]
    with pytest.raises(ValueError, match="before the end 25"):
        append_topic(numbered(spark, 0, 5, 1), filled)
    append_topic(numbered(spark, 25, 27, 1), filled)
    assert offsets_of(read_stored_topic(spark, filled, "orders", spec({"1": -2}), "latest", True)) == [(1, 25), (1, 26)]


def drained(spark, stream, tmp_path, name="out"):
    writer = stream.writeStream.format("parquet").option("path", str(tmp_path / name))
    query = writer.option("checkpointLocation", str(tmp_path / f"{name}-checkpoint")).trigger(availableNow=True).start()
    query.awaitTermination()
    return offsets_of(spark.read.parquet(str(tmp_path / name)))


def test_restart_resumes_by_offset(spark, filled, tmp_path):
    def tail(starting=spec({"0": 8, "1": -1}), fail=True):
        return stream_stored_topic(spark, filled, "orders", starting, fail, 6)

    first = [(0, i) for i in range(8, 25)]
    assert drained(spark, tail(), tmp_path) == first
    assert drained(spark, tail(), tmp_path) == first
    more = numbered(spark, 25, 30).unionByName(numbered(spark, 25, 27, 1)).unionByName(numbered(spark, 0, 2, 2))
    append_topic(more, filled)
    wanted = sorted(first + [(0, i) for i in range(25, 30)] + [(1, 25), (1, 26), (2, 0), (2, 1)])
    assert drained(spark, tail("earliest"), tmp_path) == wanted
    assert drained(spark, tail("earliest"), tmp_path, "all") == sorted(
        [(0, i) for i in range(30)] + [(1, i) for i in range(27)] + [(2, 0), (2, 1)]
    )


def test_stream_after_loss(spark, filled, tmp_path):
    def tail(fail):
        return stream_stored_topic(spark, filled, "orders", "latest", fail)

    assert drained(spark, tail(True).filter("partition = 0"), tmp_path) == []
    append_topic(numbered(spark, 25, 30), filled)
    append_topic(numbered(spark, 30, 33), filled)
    expire(spark, filled, 3)
    with pytest.raises(StreamingQueryException, match="asked for"):
        drained(spark, tail(True).filter("partition = 0"), tmp_path)
    assert drained(spark, tail(False).filter("partition = 0"), tmp_path) == [(0, 30), (0, 31), (0, 32)]
