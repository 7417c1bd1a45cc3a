"""Tumbling-window metrics over a stream of orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schemaflow.functions.columns import date_hour, net_cents
from schemaflow.operators.aggregate import GRAIN, finish, window_metrics
from schemaflow.schemas import AGGREGATE_ROW

LATENESS = "1 hour"
# Registers are 2^12, so an estimate's standard error is below two per cent.
SKETCH_BITS = 12
SKETCH_ROW = T.StructType(
    [
        *(f for f in AGGREGATE_ROW.fields if f.name not in ("net_cents_avg", "order_id_distinct")),
        T.StructField("order_id_sketch", T.BinaryType()),
    ]
)
MERGEABLE = ("order_count", "net_cents_sum", "net_cents_max", "order_id_sketch")


def with_watermark(orders: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Event-time watermark; has no effect on a batch frame."""
    return orders.withWatermark("event_time", lateness)


def _grouped(orders: DataFrame, duration: str, lateness: str):
    watermarked = with_watermark(orders, lateness).withColumn("net_cents", net_cents())
    return watermarked.groupBy(*GRAIN, F.window("event_time", duration))


def aggregate_stream(orders: DataFrame, duration: str, lateness: str = LATENESS) -> DataFrame:
    """Window metrics in append mode: each window comes out once, after the watermark passed its end.

    Exact distinct counts are not available on streams, so the order count stands in as the upper bound of
    ``order_id_distinct``.
    """
    grouped = _grouped(orders, duration, lateness).agg(*window_metrics())
    return finish(grouped.withColumn("order_id_distinct", F.col("order_count")))


def aggregate_stream_sketch(
    orders: DataFrame, duration: str, lateness: str = LATENESS, error: float = 0.05
) -> DataFrame:
    """Window metrics with the distinct order ids estimated by a sketch of constant size per group."""
    estimate: Column = F.approx_count_distinct("order_id", error).alias("order_id_distinct")
    return finish(_grouped(orders, duration, lateness).agg(*window_metrics(), estimate))


def aggregate_stream_exact(orders: DataFrame, duration: str, lateness: str = LATENESS) -> DataFrame:
    """Window metrics with exact distinct order ids, from two chained windowed aggregations.

    The first keeps one row of state per order id and window, which also spreads a hot customer over all tasks; the
    second adds those rows up. A window comes out one watermark step later than with the plain aggregate.
    """
    per_order = (
        with_watermark(orders, lateness)
        .withColumn("net_cents", net_cents())
        .groupBy(*GRAIN, "order_id", F.window("event_time", duration))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("net_cents").alias("net_sum"),
            F.max("net_cents").alias("net_max"),
        )
    )
    grouped = per_order.groupBy(*GRAIN, F.window(F.window_time("window"), duration)).agg(
        F.sum("n").alias("order_count"),
        F.sum("net_sum").alias("net_cents_sum"),
        (F.sum("net_sum") / F.sum("n")).alias("net_cents_avg"),
        F.max("net_max").alias("net_cents_max"),
        F.count("order_id").alias("order_id_distinct"),
    )
    return finish(grouped)


def sketch(orders: DataFrame, duration: str, lateness: str = LATENESS, bits: int = SKETCH_BITS) -> DataFrame:
    """Window metrics that can be merged: counts, sums, greatest value, and a sketch of the distinct order ids.

    For batch frames and, in append mode, streams. A group's state is of constant size however many ids it has. Store the rows, merge
    them with :func:`roll_up`, and read them with :func:`estimated`.
    """
    grouped = _grouped(orders, duration, lateness).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("net_cents").alias("net_cents_sum"),
        F.max("net_cents").alias("net_cents_max"),
        F.hll_sketch_agg("order_id", bits).alias("order_id_sketch"),
    )
    return _opened(grouped, GRAIN)


def _opened(grouped: DataFrame, grain: list[str]) -> DataFrame:
    start, end = F.col("window.start"), F.col("window.end")
    return grouped.select(
        *grain,
        start.alias("window_start"),
        end.alias("window_end"),
        date_hour(start).alias("date_hour"),
        *MERGEABLE,
    )


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    """Rows of :func:`sketch` that a sink stored by hour and segment."""
    return spark.read.schema(SKETCH_ROW).parquet(path)


def roll_up(sketched: DataFrame, duration: str, grain: list[str] = GRAIN) -> DataFrame:
    """Rows of :func:`sketch` merged into longer windows, and into a coarser ``grain``, without the orders.

    Partial sketches are merged before the shuffle. ``duration`` must be a multiple of the rows' own.
    """
    grouped = sketched.groupBy(*grain, F.window("window_start", duration)).agg(
        F.sum("order_count").alias("order_count"),
        F.sum("net_cents_sum").alias("net_cents_sum"),
        F.max("net_cents_max").alias("net_cents_max"),
        F.hll_union_agg("order_id_sketch").alias("order_id_sketch"),
    )
    return _opened(grouped, list(grain))


def estimated(sketched: DataFrame) -> DataFrame:
    """Mean and estimated distinct ids in place of the sketch.

    The estimate depends on the registers only: a sketch that saw all ids in one task is read like one that was merged, so a rolled-up
    window has the number that a sketch of its orders would give.
    """
    merged = F.hll_union("order_id_sketch", "order_id_sketch")
    columns = {
        "net_cents_avg": F.col("net_cents_sum") / F.col("order_count"),
        "order_id_distinct": F.hll_sketch_estimate(merged),
    }
    return sketched.withColumns(columns).drop("order_id_sketch")
