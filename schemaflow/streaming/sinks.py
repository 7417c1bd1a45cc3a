"""Streaming sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from schemaflow.operators.metrics import counters
from schemaflow.operators.sinks import by_day
from schemaflow.operators.validate import bad_rows
from schemaflow.schemas import PARTITION_COLUMNS
from schemaflow.streaming.ledger import replace_batch

TRIGGER = "30 seconds"


def triggered(writer, interval: str | None, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval or TRIGGER)


def laid_out(df: DataFrame, writers: int | None = None) -> DataFrame:
    """Bring the rows of an output directory together before the write.

    Straight from the aggregate, every state partition would add a file to every directory. Rows are hashed on the
    directory and a salt of the customer, so that a directory which holds most of a batch is still written by
    ``writers`` tasks: by default a sixteenth of the session's shuffle partitions. Only closed windows pass through.
    """
    if writers is None:
        writers = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 16)
    salt = F.pmod(F.xxhash64("customer_id"), F.lit(writers))
    return df.repartition(*PARTITION_COLUMNS, salt)


def write_aggregates(
    df: DataFrame,
    path: str,
    checkpoint: str,
    interval: str = TRIGGER,
    name: str | None = None,
    available_now: bool = False,
    writers: int | None = None,
) -> StreamingQuery:
    """Append closed windows below ``path`` in the batch layout; returns the running query.

    ``checkpoint`` must stay the same across restarts. With ``available_now`` the query drains its source and stops.
    """
    writer = laid_out(df, writers).writeStream.format("parquet").outputMode("append").partitionBy(*PARTITION_COLUMNS)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return triggered(writer, interval, available_now).start()


def write_dead_letters(
    tagged: DataFrame,
    path: str,
    summary_path: str,
    checkpoint: str,
    interval: str = TRIGGER,
    name: str | None = None,
    available_now: bool = False,
    counters_path: str | None = None,
) -> StreamingQuery:
    """Store the bad side of a stream by day, and one summary row for each micro-batch that had any.

    With ``counters_path`` the record counters of every micro-batch are stored too, one row each. Within a day every
    micro-batch owns a directory in each of the three places and overwrites it, so a batch that is run again after a failure
    leaves no duplicates and counts once. :mod:`schemaflow.streaming.ledger` reads them, and closes days into few files. Give the
    stream of :func:`schemaflow.streaming.decoded.stream_decoded`: a batch is read once for its counters and once for its bad
    rows, which must not decode it again.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        place = {"query": F.lit(query), "batch": F.lit(batch_id).cast("long")}
        day = F.to_date(F.coalesce("timestamp", "event_time"))
        if counters_path:
            counted = batch.agg(F.min(day).alias("dt"), *counters())
            replace_batch(counted.withColumns(place), counters_path)
        bad = bad_rows(batch, with_failure=True).persist()
        try:
            found = bad.agg(F.min(F.to_date("timestamp")).alias("dt"), *summary()).persist()
            # One row; taking it also fills the cache that the write below reads.
            if found.first()["bad_count"] > 0:
                replace_batch(by_day(bad.drop("failure")).withColumns(place), path)
                replace_batch(found.withColumns(place), summary_path)
            found.unpersist()
        finally:
            bad.unpersist()

    writer = tagged.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return triggered(writer, interval, available_now).start()


def summary() -> list[Column]:
    return [F.count(F.lit(1)).alias("bad_count"), F.min("failure").alias("sample_reason")]


def summarize(bad: DataFrame) -> DataFrame:
    """Size of a set of dead letters and a sample reason."""
    return bad.agg(*summary())


def drain(query: StreamingQuery, seconds: int = 120) -> bool:
    """Wait for an available-now query; stop it when the time is up. True if it ended by itself."""
    done = query.awaitTermination(seconds)
    if not done:
        query.stop()
    return bool(done)
