"""Record counters."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schemaflow.operators.validate import Split
from schemaflow.streaming.ledger import read_batches

COUNTERS = ("records_in", "records_valid", "records_bad", "bytes_in")
COUNTER_ROW = T.StructType([T.StructField(name, T.LongType()) for name in COUNTERS])


def counters() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("records_in"),
        F.count_if("valid").alias("records_valid"),
        F.count_if(~F.col("valid")).alias("records_bad"),
        F.coalesce(F.sum("payload_bytes"), F.lit(0)).alias("bytes_in"),
    ]


def split_metrics(split: Split) -> DataFrame:
    """Exact counters as one row; on a held split this pass also fills the cache."""
    return split.tagged.agg(*counters())


def observed(tagged: DataFrame, observation: Observation | str) -> DataFrame:
    """Count while another action, or a stream, reads the frame; no pass of its own.

    A stage that is run again after a lost executor counts its rows again, so use :func:`split_metrics` where the
    numbers must be exact, and for streams :func:`batch_counters`.
    """
    return tagged.observe(observation, *counters())


def snapshot(split: Split) -> dict[str, int]:
    """The counters as plain numbers."""
    row = split_metrics(split).first()
    return {name: row[name] for name in COUNTERS}


def batch_counters(
    spark: SparkSession, path: str, first: datetime.date | None = None, last: datetime.date | None = None
) -> DataFrame:
    """The counters that a stream stored: dt, query, batch and COUNTERS, one row for each micro-batch however often it was run.

    ``dt`` is the day of a batch's earliest record.
    """
    return read_batches(spark, path, COUNTER_ROW, first, last)


def stream_totals(counted: DataFrame) -> DataFrame:
    """Sums over micro-batches, one row for each query; add the queries up where a job had several."""
    return counted.groupBy("query").agg(*(F.sum(name).alias(name) for name in COUNTERS))
