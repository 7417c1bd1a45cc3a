"""Decode payloads and split them into order rows and dead letters."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemaflow.functions.avro_decode import check_reader, text_kinds
from schemaflow.functions.columns import millis_to_time
from schemaflow.functions.payloads import decode_payload, java_text
from schemaflow.schemas import BAD_ROW, ENVELOPE_COLUMNS, ORDER_ROW
from schemaflow.session import scratch

BAD_REASON = "decode failed"
BAD_ONLY_REASON = "malformed"


class Split(NamedTuple):
    """The two sides of a decode, and the tagged frame both are filters of."""

    valid: DataFrame
    bad: DataFrame
    tagged: DataFrame


def envelope(df: DataFrame) -> DataFrame:
    """The five columns the split needs."""
    return df.select(*ENVELOPE_COLUMNS)


def tag(df: DataFrame, reader: str, writers: list[str] = (), order: str = "oldest_first") -> DataFrame:
    """One wide row per payload: ``valid``, the order fields or the position and payload, and the failure.

    The half that does not apply is null, so a cached tagged frame holds the payload bytes of bad rows only. Where the reader gives
    a text column another type, numbers, booleans, enums, fixed and bytes become the text that Java prints for them; records,
    lists and maps are refused.
    """
    if order not in ("oldest_first", "newest_first"):
        raise ValueError(f"unknown candidate order: {order}")
    check_reader(reader)
    candidates = list(writers) if order == "oldest_first" else list(writers)[::-1]
    decoded = envelope(df).withColumn("_row", decode_payload(F.col("value"), reader, candidates))
    good = F.col("_row.valid")
    return decoded.select(
        good.alias("valid"),
        *[java_text(F.col(f"_row.{n}"), kind).alias(n) for n, kind in text_kinds(reader).items()],
        F.col("_row.total_cents").alias("total_cents"),
        millis_to_time(F.col("_row.event_millis")).alias("event_time"),
        F.col("_row.discount_cents").alias("discount_cents"),
        *[F.when(~good, F.col(n)).alias(n) for n in ("topic", "partition", "offset", "timestamp")],
        F.when(~good, F.col("value")).alias("payload"),
        F.when(~good, F.lit(BAD_REASON)).alias("reason"),
        F.col("_row.failure").alias("failure"),
        F.octet_length("value").alias("payload_bytes"),
    )


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("valid")).select(*ORDER_ROW.fieldNames())


def bad_rows(tagged: DataFrame, with_failure: bool = False) -> DataFrame:
    """Dead letters; ``with_failure`` adds what the reader schema's own attempt ran into."""
    return tagged.filter(~F.col("valid")).select(*BAD_ROW.fieldNames(), *(["failure"] if with_failure else []))


def split_tagged(tagged: DataFrame) -> Split:
    return Split(valid_rows(tagged), bad_rows(tagged), tagged)


def validate(df: DataFrame, reader: str, writers: list[str] = (), order: str = "oldest_first") -> Split:
    """Split a batch or streaming envelope frame.

    The reader schema is tried first, then each writer schema in the given order; the first that decodes wins. Nothing
    is cached here: a batch caller that reads both sides should hold the tagged frame with :func:`hold`.
    """
    return split_tagged(tag(df, reader, writers, order))


def hold(split: Split) -> Split:
    """Cache the tagged frame so that both sides, and every count, share one decode; release with :func:`release`.

    Blocks spill to executor disks and lost ones are decoded again from their source.
    """
    return split_tagged(split.tagged.persist(StorageLevel.MEMORY_AND_DISK))


def release(split: Split) -> None:
    split.tagged.unpersist()


@contextmanager
def settled(split: Split) -> Iterator[Split]:
    """The same split, stored by side below the shared folder for as long as the block runs."""
    spark = split.tagged.sparkSession
    with scratch(spark, "decoded") as path:
        split.tagged.write.partitionBy("valid").parquet(path)
        yield split_tagged(spark.read.schema(split.tagged.schema).parquet(path))


def split_counts(split: Split) -> DataFrame:
    """One row with the size of each side, from one pass over the tagged frame."""
    return split.tagged.agg(
        F.count_if("valid").alias("valid_count"),
        F.count_if(~F.col("valid")).alias("bad_count"),
    )


def bad_only(df: DataFrame) -> DataFrame:
    """Every row as a dead letter, without decoding."""
    position = [c for c in ENVELOPE_COLUMNS if c != "value"]
    return df.select(*position, F.col("value").alias("payload"), F.lit(BAD_ONLY_REASON).alias("reason"))


def replay(bad: DataFrame, reader: str, writers: list[str] = (), order: str = "oldest_first") -> Split:
    """Decode stored dead letters again, normally against newer schemas."""
    return validate(bad.withColumnRenamed("payload", "value"), reader, writers, order)
