"""The batch job: snapshot, split, window metrics, sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from schemaflow.operators.aggregate import aggregate
from schemaflow.operators.metrics import snapshot
from schemaflow.operators.registration import reader_and_writers
from schemaflow.operators.sinks import write_aggregates, write_bad_rows_if_any, write_table
from schemaflow.operators.validate import settled, validate


def write_both(df: DataFrame, path: str, table: dict | None = None, coalesce_to: int | None = None) -> None:
    """Write one frame as partitioned Parquet and, where ``table`` names one, to a catalog table.

    The frame is computed once for both.
    """
    if table is None:
        write_aggregates(df, path, coalesce_to)
        return
    df = df.persist()
    try:
        write_aggregates(df, path, coalesce_to)
        write_table(df, **table)
    finally:
        df.unpersist()


def run_batch(
    source: DataFrame,
    registry: DataFrame,
    subject: str,
    output: str,
    bad_output: str,
    duration: str = "1 hour",
    table: dict | None = None,
    coalesce_to: int | None = None,
) -> dict[str, int]:
    """Run the whole job on an envelope snapshot and return its counters.

    Every payload is decoded once: the decoded rows are stored by side in the shared folder, and the counters and both writes
    start from there, so a lost executor costs no second decode. What was stored is removed at the end. ``table`` takes the
    arguments of :func:`schemaflow.operators.sinks.write_table`.
    """
    reader, writers = reader_and_writers(registry, subject)
    with settled(validate(source, reader, writers)) as split:
        counters = snapshot(split)
        write_both(aggregate(split.valid, duration), output, table, coalesce_to)
        write_bad_rows_if_any(split.bad, bad_output, counters["records_bad"])
    return counters
