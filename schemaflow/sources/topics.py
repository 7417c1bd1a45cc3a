"""Order events from a topic, or from stored envelopes with the same columns."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schemaflow.schemas import ENVELOPE

EARLIEST, LATEST = -2, -1


def _kafka(reader, bootstrap: str, topic: str):
    return (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("failOnDataLoss", "false")
    )


def read_topic(
    spark: SparkSession, bootstrap: str, topic: str, starting: str = "earliest", ending: str = "latest"
) -> DataFrame:
    """Snapshot of a Kafka topic between two offset specs. Needs the Kafka package on the session's class path."""
    reader = _kafka(spark.read, bootstrap, topic)
    return reader.option("startingOffsets", starting).option("endingOffsets", ending).load()


def stream_topic(spark: SparkSession, bootstrap: str, topic: str, starting: str = "latest") -> DataFrame:
    """Live tail of a Kafka topic, with the columns of :func:`read_topic`."""
    return _kafka(spark.readStream, bootstrap, topic).option("startingOffsets", starting).load()


def read_envelopes(
    source: DataFrame, topic: str, starting: str = "earliest", ending: str = "latest"
) -> DataFrame:
    """Snapshot of one topic from a frame of stored envelopes, with the offset specs of a Kafka read.

    A spec is ``earliest``, ``latest`` or JSON ``{topic: {partition: offset}}`` where -2 and -1 stand for the two words;
    the end is exclusive and a partition that a JSON spec leaves out is not read.
    """
    kept = source.filter(F.col("topic") == topic)
    for spec, is_start in ((starting, True), (ending, False)):
        if spec in ("earliest", "latest"):
            if (spec == "earliest") != is_start:
                kept = kept.filter(F.lit(False))
            continue
        ranges = [_in_range(int(p), int(o), is_start) for p, o in json.loads(spec)[topic].items()]
        kept = kept.filter(reduce(lambda a, b: a | b, ranges, F.lit(False)))
    return kept


def _in_range(partition: int, offset: int, is_start: bool):
    at = F.col("partition") == partition
    if offset == (EARLIEST if is_start else LATEST):
        return at
    if offset < 0:
        return F.lit(False)
    return at & (F.col("offset") >= offset if is_start else F.col("offset") < offset)


def stream_envelopes(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream over stored envelopes as files arrive."""
    reader = spark.readStream.schema(ENVELOPE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def to_envelopes(df: DataFrame, topic: str, partition, offset, timestamp, value) -> DataFrame:
    """Shape any frame as envelopes."""
    return df.select(
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
        value.alias("value"),
    )
