"""Stored topics with offsets: appended on Spark, read as a snapshot or a stream of offset ranges.

An append writes envelopes below ``appends/<id>/topic=…/partition=…`` and then creates the next numbered entry below ``index``,
which names that folder and the offsets it covers, from the end of the append before to one past its greatest offset. Readers see
an append only by its entry, so never a part of it. Whoever creates a number first has appended; the other one is checked again
against the new end and takes the next number. :func:`expire` removes the oldest entries, as a topic's retention does.

The source reads one task per range of offsets of one append, opens the directory of that partition only, and skips row groups by
their offsets. Its stream keeps offsets per partition in Spark's own checkpoint, so a restart resumes where the last batch ended.
Folders are read by Python on driver and executors: a local or shared folder, HDFS, or an object store that pyarrow knows.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow.fs import FileSelector, FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from schemaflow.schemas import ENVELOPE, ENVELOPE_COLUMNS
from schemaflow.storage import listed, located, put_if_absent, remove

FORMAT = "schemaflow_topic"
RANGE_ROWS = 1_000_000
EARLIEST, LATEST = -2, -1
ENTRY = "{:012d}.json"
# Fixed value: what a topic's name may hold; such names are directory names as they are.
NAME = "[A-Za-z0-9._-]+"


class Piece(NamedTuple):
    """Offsets from ``start`` to before ``end`` of one partition, all held by one folder."""

    folder: str
    start: int
    end: int


class Held(NamedTuple):
    """What is stored of one partition: offsets from ``start`` to before ``end``, ascending pieces; none if all have expired."""

    pieces: list[Piece]
    start: int
    end: int


class OffsetRange(InputPartition):
    """What one task reads."""

    def __init__(self, partition: int, piece: Piece):
        super().__init__((partition, *piece))
        self.partition, self.piece = partition, piece


# ---- writing -----------------------------------------------------------------------------------------------------


def _numbers(spark: SparkSession, root: str) -> list[int]:
    names = [name for name, _ in listed(spark, f"{root}/index")]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def _entry(spark: SparkSession, root: str, number: int) -> dict:
    place, fs = located(spark, f"{root}/index/{ENTRY.format(number)}")
    stream = fs.open(place)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def append_topic(envelopes: DataFrame, root: str, range_rows: int = RANGE_ROWS) -> int | None:
    """Append envelopes of any topics and partitions; returns the number of the append, None if there were no rows.

    Offsets of a partition must lie at or beyond its end, as a topic only grows; gaps are allowed, and repeated offsets within
    one append stay as they are. Anything else raises ValueError and leaves the topic as it was, as do names with other characters
    than a topic's, and null topics, partitions and offsets. Other columns are not stored. The rows are shuffled once, by partition
    and range of offsets, so a partition that holds most rows is still written by many tasks. The driver holds one pair of
    offsets for each partition.
    """
    spark = envelopes.sparkSession
    root = root.rstrip("/")
    folder = f"appends/{uuid.uuid4().hex}"
    bucket = F.floor(F.col("offset") / range_rows)
    rows = envelopes.select(ENVELOPE_COLUMNS).repartition("topic", "partition", bucket)
    rows = rows.sortWithinPartitions("topic", "partition", "offset")
    rows.write.partitionBy("topic", "partition").parquet(f"{root}/{folder}")
    try:
        written = spark.read.schema(ENVELOPE).parquet(f"{root}/{folder}")
        found = written.groupBy("topic", "partition").agg(
            F.min("offset").alias("first"), F.max("offset").alias("last"), F.count_if(F.col("offset").isNull()).alias("nulls")
        )
        found = found.collect()
        if any(r["topic"] is None or r["partition"] is None or r["nulls"] or r["first"] < 0 for r in found):
            raise ValueError("an envelope has no topic, partition or offset")
        if any(not re.fullmatch(NAME, r["topic"]) for r in found):
            raise ValueError(f"topic names hold other characters than {NAME}")
        number = _publish(spark, root, folder, found) if found else None
    except ValueError:
        remove(spark, f"{root}/{folder}")
        raise
    if number is None:
        remove(spark, f"{root}/{folder}")
    return number


def _publish(spark: SparkSession, root: str, folder: str, found: list) -> int:
    """Create the next entry, which also carries the ends of all partitions: nobody has to read more than the last one."""
    while True:
        last = max(_numbers(spark, root), default=None)
        ends = {} if last is None else _entry(spark, root, last)["ends"]
        topics: dict[str, dict] = {}
        for r in found:
            own = ends.setdefault(r["topic"], {})
            end = own.get(str(r["partition"]), 0)
            if r["first"] < end:
                raise ValueError(f"{r['topic']} {r['partition']}: offset {r['first']} lies before the end {end}")
            topics.setdefault(r["topic"], {})[str(r["partition"])] = [end, r["last"] + 1]
            own[str(r["partition"])] = r["last"] + 1
        number = 0 if last is None else last + 1
        text = json.dumps({"folder": folder, "topics": topics, "ends": ends}, sort_keys=True)
        if put_if_absent(spark, f"{root}/index/{ENTRY.format(number)}", text):
            return number


def expire(spark: SparkSession, root: str, before: int) -> None:
    """Remove the appends numbered below ``before``; the last one always stays, since it holds the ends of all partitions.

    Entries go before their rows, oldest first, so that no reader plans rows that are gone.
    """
    root = root.rstrip("/")
    for number in _numbers(spark, root)[:-1]:
        if number < before:
            folder = _entry(spark, root, number)["folder"]
            remove(spark, f"{root}/index/{ENTRY.format(number)}")
            remove(spark, f"{root}/{folder}")


# ---- reading -----------------------------------------------------------------------------------------------------


class TopicLog:
    """The index of one topic as Python sees it. Entries never change, so each is read once by one reader."""

    def __init__(self, path: str, topic: str, range_rows: int, fail_on_loss: bool):
        self.fs, root = FileSystem.from_uri(path if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) else f"file://{path}")
        self.root, self.topic = root.rstrip("/"), topic
        self.range_rows, self.fail_on_loss = range_rows, fail_on_loss
        self.known: dict[str, dict] = {}

    def held(self) -> dict[str, Held]:
        """What is stored of each partition that the topic has or had."""
        selector = FileSelector(f"{self.root}/index", allow_not_found=True)
        names = sorted(i.base_name for i in self.fs.get_file_info(selector))
        names = [n for n in names if n.endswith(".json") and not n.startswith(".")]
        for name in names:
            if name not in self.known:
                with self.fs.open_input_stream(f"{self.root}/index/{name}") as stream:
                    self.known[name] = json.loads(stream.read())
        entries = [self.known[name] for name in names]
        out = {}
        for partition, end in (entries[-1]["ends"].get(self.topic, {}) if entries else {}).items():
            own = [(e["folder"], e["topics"].get(self.topic, {}).get(partition)) for e in entries]
            pieces = [Piece(folder, *offsets) for folder, offsets in own if offsets]
            out[partition] = Held(pieces, pieces[0].start if pieces else end, end)
        return out

    def bounds(self, spec: str, held: dict[str, Held]) -> dict[str, int]:
        """Offsets that a spec stands for: ``earliest``, ``latest``, or JSON by partition, where -2 and -1 are the two words."""
        first, last = ({p: h.start for p, h in held.items()}, {p: h.end for p, h in held.items()})
        if spec in ("earliest", "latest"):
            return first if spec == "earliest" else last
        named = {str(p): int(o) for p, o in json.loads(spec).get(self.topic, {}).items()}
        if any(o < EARLIEST for o in named.values()):
            raise ValueError(f"offsets below {EARLIEST} mean nothing: {spec}")
        return {p: first.get(p, 0) if o == EARLIEST else last.get(p, 0) if o == LATEST else o for p, o in named.items()}

    def ranges(self, start: dict[str, int], end: dict[str, int], held: dict[str, Held]) -> list[OffsetRange]:
        """Tasks for the offsets from ``start`` to before ``end`` of the partitions that both name.

        Offsets that were asked for and are not stored any more, or not yet, are lost data: they raise, or are left out.
        """
        out = []
        for partition in sorted(start.keys() & end.keys(), key=int):
            at, until = start[partition], end[partition]
            own = held.get(partition, Held([], 0, 0))
            if self.fail_on_loss and at != until and (at > until or at < own.start or until > own.end):
                raise ValueError(
                    f"{self.topic} {partition}: offsets {at} to {until} were asked for, {own.start} to {own.end} are stored"
                )
            for piece in own.pieces:
                low, high = max(at, piece.start), min(until, piece.end)
                for cut in range(low, high, self.range_rows):
                    out.append(OffsetRange(int(partition), Piece(piece.folder, cut, min(cut + self.range_rows, high))))
        return out

    def batches(self, task: OffsetRange) -> Iterator[pa.RecordBatch]:
        place = f"{self.root}/{task.piece.folder}/topic={self.topic}/partition={task.partition}"
        files = ds.dataset(place, filesystem=self.fs, format="parquet")
        offset = ds.field("offset")
        own = (offset >= task.piece.start) & (offset < task.piece.end)
        place_of = ((self.topic, pa.string()), (task.partition, pa.int32()))
        for batch in files.to_batches(columns=["offset", "timestamp", "value"], filter=own):
            if batch.num_rows:
                same = [pa.repeat(pa.scalar(v, kind), batch.num_rows) for v, kind in place_of]
                times = batch.column("timestamp").cast(pa.timestamp("us", tz="UTC"))
                columns = [*same, batch.column("offset"), times, batch.column("value")]
                yield pa.RecordBatch.from_arrays(columns, names=ENVELOPE_COLUMNS)


class SnapshotReader(DataSourceReader):
    def __init__(self, log: TopicLog, starting: str, ending: str):
        self.log, self.starting, self.ending = log, starting, ending

    def partitions(self) -> list[OffsetRange]:
        held = self.log.held()
        return self.log.ranges(self.log.bounds(self.starting, held), self.log.bounds(self.ending, held), held)

    def read(self, partition: OffsetRange | None) -> Iterator[pa.RecordBatch]:
        # Spark plans one task without a range where there is nothing to read.
        return iter(()) if partition is None else self.log.batches(partition)


class TailReader(DataSourceStreamReader):
    """Offsets are ``{partition: offset}``; a partition that the start does not name is read from its earliest offset."""

    def __init__(self, log: TopicLog, starting: str):
        self.log, self.starting = log, starting

    def initialOffset(self) -> dict:
        return self.log.bounds(self.starting, self.log.held())

    def latestOffset(self) -> dict:
        return self.log.bounds("latest", self.log.held())

    def partitions(self, start: dict, end: dict) -> list[OffsetRange]:
        held = self.log.held()
        return self.log.ranges(self.log.bounds("earliest", held) | start, end, held)

    def read(self, partition: OffsetRange) -> Iterator[pa.RecordBatch]:
        return self.log.batches(partition)

    def commit(self, end: dict) -> None:
        """Nothing to release: the rows stay until :func:`expire`."""


class StoredTopic(DataSource):
    """Options ``path``, ``topic``, ``startingOffsets``, ``endingOffsets``, ``failOnDataLoss``, ``rangeRows``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return ENVELOPE

    def log(self) -> TopicLog:
        fail = self.options.get("failOnDataLoss", "true").lower() == "true"
        return TopicLog(self.options["path"], self.options["topic"], int(self.options.get("rangeRows", RANGE_ROWS)), fail)

    def reader(self, schema: StructType) -> SnapshotReader:
        bounds = self.options.get("startingOffsets", "earliest"), self.options.get("endingOffsets", "latest")
        return SnapshotReader(self.log(), *bounds)

    def streamReader(self, schema: StructType) -> TailReader:
        return TailReader(self.log(), self.options.get("startingOffsets", "latest"))


def _source(spark: SparkSession, reader, root: str, topic: str, starting: str, fail_on_loss: bool, range_rows: int):
    spark.dataSource.register(StoredTopic)
    options = {"path": root, "topic": topic, "startingOffsets": starting, "rangeRows": str(range_rows)}
    return reader.format(FORMAT).options(failOnDataLoss=str(fail_on_loss).lower(), **options)


def read_stored_topic(
    spark: SparkSession,
    root: str,
    topic: str,
    starting: str = "earliest",
    ending: str = "latest",
    fail_on_loss: bool = False,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Snapshot between two offset specs, as :func:`schemaflow.sources.topics.read_topic` takes them; the end is exclusive.

    A partition that either spec leaves out is not read. Only appends and partitions with offsets in between are opened, by one
    task for each ``range_rows`` offsets. With ``fail_on_loss`` offsets that are not stored raise instead of being left out.
    An unknown topic or an empty folder gives no rows.
    """
    reader = _source(spark, spark.read, root, topic, starting, fail_on_loss, range_rows)
    return reader.option("endingOffsets", ending).load()


def stream_stored_topic(
    spark: SparkSession,
    root: str,
    topic: str,
    starting: str = "latest",
    fail_on_loss: bool = False,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Live tail of a stored topic from an offset spec; after a restart the checkpoint's offsets hold, not the spec.

    Partitions that the spec leaves out, and those that appear later, are read from their earliest offset. With
    ``fail_on_loss`` a batch whose offsets have expired raises; otherwise it goes on with what is left.
    """
    return _source(spark, spark.readStream, root, topic, starting, fail_on_loss, range_rows).load()
