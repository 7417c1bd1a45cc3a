"""The streaming job: tail, one decode, window metrics, dead letters, counters."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from schemaflow.operators.metrics import observed
from schemaflow.operators.registration import reader_and_writers
from schemaflow.operators.validate import valid_rows, validate
from schemaflow.streaming.aggregate import LATENESS, aggregate_stream
from schemaflow.streaming.decoded import store_decoded, stream_decoded
from schemaflow.streaming.sinks import TRIGGER, write_aggregates, write_dead_letters


class StreamPaths(NamedTuple):
    """``decoded``, ``bad_summary`` and ``counters`` get names of their own beside the others where they are not given."""

    output: str
    checkpoint: str
    bad: str | None = None
    bad_summary: str | None = None
    decoded: str | None = None
    counters: str | None = None

    @property
    def stored(self) -> str:
        return self.decoded or f"{self.output}-decoded"

    @property
    def summary(self) -> str:
        return self.bad_summary or f"{self.bad}-summary"

    @property
    def counted(self) -> str:
        return self.counters or f"{self.bad}-counters"


def run_stream(
    source: DataFrame,
    registry: DataFrame,
    subject: str,
    paths: StreamPaths,
    duration: str = "1 hour",
    lateness: str = LATENESS,
    interval: str = TRIGGER,
    name: str = "orders",
    available_now: bool = False,
) -> list[StreamingQuery]:
    """Start the job on a streaming envelope frame; returns its queries for the caller to await or stop.

    The first query reads and decodes the source and stores both sides; counters of its micro-batches are observed under
    ``records`` in its progress. The others tail what it stored, each with its own checkpoint: dead letters and exact counters if
    ``paths.bad`` is given (otherwise the bad side is stored and not listed), and, last, the window metrics. So the source is
    read once and no payload is decoded twice, for one more micro-batch of delay. With ``available_now`` the first query is
    drained before the others start.
    """
    spark = source.sparkSession
    reader, writers = reader_and_writers(registry, subject)
    tagged = validate(source, reader, writers).tagged
    checkpoint = f"{paths.checkpoint}/decode"
    decoding = store_decoded(
        observed(tagged, "records"), paths.stored, checkpoint, interval, f"{name}-decode", available_now
    )
    if available_now:
        decoding.awaitTermination()
    queries = [decoding]
    if paths.bad:
        letters = stream_decoded(spark, paths.stored, tagged.schema)
        checkpoint = f"{paths.checkpoint}/dead-letters"
        queries.append(
            write_dead_letters(
                letters, paths.bad, paths.summary, checkpoint, interval, f"{name}-bad", available_now, paths.counted
            )
        )
    orders = valid_rows(stream_decoded(spark, paths.stored, tagged.schema))
    metrics = aggregate_stream(orders, duration, lateness)
    queries.append(
        write_aggregates(metrics, paths.output, f"{paths.checkpoint}/aggregate", interval, name, available_now)
    )
    return queries
