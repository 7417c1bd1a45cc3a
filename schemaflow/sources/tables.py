"""Read back what the sinks wrote."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schemaflow.schemas import AGGREGATE_ROW, BAD_ROW
from schemaflow.streaming.ledger import read_batches

WRITTEN_AT = T.StructField("written_at", T.TimestampType())


def read_aggregates(
    spark: SparkSession,
    path: str,
    first_hour: str | None = None,
    last_hour: str | None = None,
    segments: list[str] | None = None,
    stamped: bool = False,
) -> DataFrame:
    """Partitioned output with its partition columns; hour bounds (inclusive) and segments prune directories.

    The schema is given and not inferred: files are listed once, no footer is opened for it, and directory values stay
    text even where they look like numbers. ``stamped`` output has the ``written_at`` column too.
    """
    schema = T.StructType([*AGGREGATE_ROW.fields, *([WRITTEN_AT] if stamped else [])])
    df = spark.read.schema(schema).parquet(path)
    if first_hour is not None:
        df = df.filter(F.col("date_hour") >= first_hour)
    if last_hour is not None:
        df = df.filter(F.col("date_hour") <= last_hour)
    if segments is not None:
        df = df.filter(F.col("customer_segment").isin(segments))
    return df


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_dead_letters(
    spark: SparkSession, path: str, first: datetime.date | None = None, last: datetime.date | None = None
) -> DataFrame:
    """Dead letters stored by day, with their ``dt``; only the days from ``first`` to ``last`` are listed and read.

    Days that were closed into few files are read from there.
    """
    return read_batches(spark, path, BAD_ROW, first, last).drop("query", "batch")
